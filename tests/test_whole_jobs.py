"""Whole jobs: searches on all training rows, genetic searches of all generations, and what they hold on the way."""

import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import learners as ln
from tessera.operators import tuning


def _labelled(n=51_000, seed=5):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=(n, 2)), np.eye(3)[r.integers(0, 3, n)]]).astype(np.float32)
    y = (r.random(n) < ln.sigmoid(x[:, 0] - x[:, 2] - 1)).astype(float)
    return x, y


@pytest.fixture(scope="module")
def many_rows(spark):
    import pandas as pd
    x, y = _labelled()
    rows = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(len(x)), "label": y, "v": list(x.astype(float))}), "row_id long, label double, v array<double>")
    return rows.select("row_id", "label", F.pmod("row_id", F.lit(5)).cast("int").alias("fold"), array_to_vector("v").alias("features"))


def test_a_search_fits_every_training_row(many_rows):
    x, y = _labelled()
    _, _, models = tuning.search(many_rows, ["logreg"], grids={"logreg": {"c": [1]}})
    assert np.allclose(models["logreg"]["weights"], ln.logistic(x, y, 1)["weights"], atol=1e-8)  # 50,000 of them before


def test_stored_rows_travel_by_name_and_go_after_the_search(spark, many_rows):
    import pickle
    x, y = _labelled()
    sample = tuning.gather(many_rows, 5)
    assert np.array_equal(sample.x, x) and np.array_equal(sample.label, y) and np.array_equal(sample.fold, np.arange(len(x)) % 5)
    assert isinstance(sample.x, np.memmap) and len(pickle.dumps(sample)) < 1000
    assert np.array_equal(pickle.loads(pickle.dumps(sample)).x, x)
    tuning.forget(spark, sample)
    assert not os.path.exists(tuning._local(sample.folder)) and not os.path.exists(sample.folder.removeprefix("file:"))


def test_rows_of_a_side_are_built_where_they_are_asked_for():
    x, y = _labelled(3000)
    r = np.random.default_rng(1)
    own = np.flatnonzero(np.arange(3000) % 5 != 2)
    i, j, gap = r.choice(own, 700), r.choice(own, 700), r.random(700)
    rows = ln.Rows(x, y, own, (i, j, gap))
    want = np.concatenate([x[own], x[i] + gap[:, None].astype(np.float32) * (x[j] - x[i])])
    at = r.permutation(len(want))
    assert np.array_equal(rows.dense(), want) and np.array_equal(rows.take(at), want[at]) and rows.y.sum() == y[own].sum() + 700
    assert all(np.array_equal(rows.column(c), want[:, c]) for c in range(5))
    assert np.array_equal(np.concatenate([rows.span(lo, lo + 499) for lo in range(0, len(rows), 499)]), want)


def test_blocks_and_bundles_change_no_tree(monkeypatch):
    x, y = _labelled(4000)
    codes, members = ln.bundles_of(ln.rows_of(x, y), ln.edges_of(x))
    assert members == [[0], [1], [2, 3, 4]] and set(codes[2]) == {1, 2, 3}  # the one-hot slots count as one column
    trees = [ln.boost(x, y, 12, 4, 0.3, 0.8, 0.8), ln.forest(x, y, 9, None, 1)]
    monkeypatch.setattr(ln, "BLOCK", 700)
    monkeypatch.setattr(ln, "CELLS", 500)
    monkeypatch.setattr(ln, "JOINT", 64)
    again = [ln.boost(x, y, 12, 4, 0.3, 0.8, 0.8), ln.forest(x, y, 9, None, 1)]
    assert np.array_equal(trees[0]["feature"], again[0]["feature"]) and np.allclose(trees[0]["value"], again[0]["value"], atol=1e-6)
    assert all(np.array_equal(a, b) for one, two in zip(trees[1]["grown"], again[1]["grown"]) for a, b in zip(one[1:], two[1:]))


# ------------------------------------------------------------ genetic search
def _problems(spark):
    r = np.random.default_rng(2)
    items = [(p, int(i), int(r.integers(1, 90))) for p in (1, 2) for i in r.permutation(130 + 7 * p)] + [(1, 5, 40), (3, 1, 9)]  # an item twice; no resources
    use = [(p, k, i, int(r.integers(0, 9))) for p in (1, 2) for i in range(130) for k in (0, 1, 2) if r.random() < 0.8]
    res = [(p, k, None if (p, k) == (2, 1) else 150) for p in (1, 2) for k in (0, 1, 2)]
    return (spark.createDataFrame(items, "problem int, item long, profit long"), spark.createDataFrame(use, "problem int, resource int, item long, amount long"),
            spark.createDataFrame(res, "problem int, resource int, capacity long"))


GA_GRID = [{"pop_size": 9, "crossover_rate": 0.7, "mutation_rate": 0.02}, {"pop_size": 6, "crossover_rate": 0.9, "mutation_rate": 0.05}]


def test_hash_draws_are_the_columns_draws(spark):
    from tessera.functions.hashing import TWO_32, hash_draws, hash_uniform
    numbers = [0, 7, 9, 10, 99, 100, 12345, 99999, 100000, 4294967296, 12345678901]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for keys in ((0, "1:0", 3), ("x" * 70, 1)):
        want = [r[0] for r in df.select("n", hash_uniform(7, *[F.lit(k) for k in keys], "n").alias("u")).orderBy("n").select("u").collect()]
        assert np.array_equal(hash_draws(np.array(numbers), 7, *keys) / TWO_32, want)


def test_packed_and_long_populations_evolve_alike(spark):
    from tessera.operators import search as se
    from tessera.session import checkpoint
    items, cons, res = _problems(spark)
    runs, curve, best = se.evolve(items, cons, res, GA_GRID, 3, seed=5)
    loci = checkpoint(se.item_positions(items))
    pop, want, top = checkpoint(se.population_init(runs, loci, seed=5)), {}, {}
    for gen in range(3):
        pop = checkpoint(se.population_repair(pop, cons, res, gen, 6))
        fit = checkpoint(se.population_fitness(pop, items))
        for r in fit.groupBy("run").agg(F.max(F.struct("fitness", (-F.col("chrom")).alias("c"))).alias("b")).collect():
            want[r.run, gen] = r.b.fitness
            if r.b.fitness > top.get(r.run, (-1,))[0]:
                chosen = pop.where((F.col("run") == r.run) & (F.col("chrom") == -r.b.c) & (F.col("bit") == 1))
                top[r.run] = (r.b.fitness, gen, sorted(x.item for x in chosen.select("item").collect()))
        pop = checkpoint(se.mutate(se.crossover(pop, se.tournament(fit, runs, gen, 3, 7), runs, gen, 8), runs, gen, 9))
    assert {(r.run, r.gen): r.gen_best for r in curve.collect()} == want and len(want) == 12
    assert {r.run: (r.fitness, r.gen, r["items"]) for r in best.collect()} == top


def test_a_generation_replaces_the_one_before(spark, monkeypatch):
    from tessera.operators import search as se
    items, cons, res = _problems(spark)
    left, keep = [], se._remove

    def remove(spark, folder):
        at = folder.removeprefix("file:")
        left.append(sorted(x for x in os.listdir(os.path.dirname(at) if "/pop-" in at else at) if x.startswith("pop-")))
        keep(spark, folder)
    monkeypatch.setattr(se, "_remove", remove)
    se.evolve(items, cons, res, GA_GRID, 3, seed=5)
    assert left == [["pop-0", "pop-1"], ["pop-1", "pop-2"], ["pop-2"]]


def test_the_registered_search_runs_the_references_generations():
    from tessera.plans import q_search
    assert q_search._evolve.__defaults__ == (200,)


# ------------------------------------------------- forests and neighbours
def test_a_forest_in_groups_has_all_its_trees(spark, many_rows, monkeypatch, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
    from tessera.operators import ml
    rows = many_rows.where("row_id < 2000")
    monkeypatch.setattr(ml, "BAG_BYTES", 4 * 2000 * 4)  # four trees a fit; all draws at once before
    model = ml.forest(RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=10, maxDepth=3, seed=1), rows)
    assert len(model.trees) == 10 and model.getNumTrees == 10 and len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 5
    model.save(str(tmp_path / "m"))
    again = RandomForestClassificationModel.load(str(tmp_path / "m"))
    assert [r.probability for r in model.transform(rows).collect()] == [r.probability for r in again.transform(rows).collect()]


def test_a_side_is_handed_its_nearest_pairs_only(many_rows, monkeypatch):
    from tessera.operators import neighbors as nb
    rows, seen, keep = many_rows.where("row_id < 3000"), [], nb.smote_draws

    def draws(*args):
        seen.append(args[-1].groupBy("held", "i").count().agg(F.max("count")).first()[0])
        return keep(*args)
    monkeypatch.setattr(nb, "smote_draws", draws)
    assert tuning.oversampled(rows, 5).where("i = j").count() == 0 and seen == [5]  # 25 or more before
