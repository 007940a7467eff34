"""Searches over folds, their learners, oversampling inside folds and scoring of raw records."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import learners as ln
from tessera.operators import ml, tuning
from tessera.plans import classify, scoring

SF = "/root/testdata/sf0.001"
SMALL = {"logreg": {"c": [0.1, 1]}, "rf": {"trees": [9], "depth": [3, None], "leaf": [5]},
         "gbt": {"rounds": [8], "depth": [2], "rate": [0.1, 0.3], "rows": [0.8], "columns": [0.8, 1.0]},
         "mlp": {"layers": [[8]], "penalty": [1e-4, 1e-3], "epochs": [5]}}


def data(n=900, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=(n, 2)), r.integers(0, 4, n), np.eye(3)[r.integers(0, 3, n)]])
    y = (r.random(n) < ln.sigmoid(2 * x[:, 0] - x[:, 2] + 2 * x[:, 4])).astype(float)
    return x, y


def test_grids_are_the_references():
    assert [len(tuning.grid_points(n)) for n in ("logreg", "rf", "gbt", "mlp")] == [3, 6, 24, 4]
    assert tuning.GRIDS["gbt"]["rounds"] == [800] and tuning.GRIDS["rf"]["trees"] == [600] and tuning.GRIDS["mlp"]["epochs"] == [300]


def test_auc_equals_pairs():
    r = np.random.default_rng(0)
    y, s = r.integers(0, 2, 200).astype(float), r.integers(0, 20, 200) / 20
    pos, neg = s[y == 1], s[y == 0]
    assert ln.auc(y, s) == pytest.approx(np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)))


def test_first_boosted_split_is_the_best_of_all():
    x, y = data(300)
    m = ln.boost(x, y, rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0)
    g, h = 0.5 - y, np.full(len(y), 0.25)

    def gain(left):
        return sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)) if min(h[left].sum(), h[~left].sum()) >= 1 else -np.inf
    best = max(gain(x[:, c] <= e) for c, edges in enumerate(m["edges"]) for e in edges)
    c = m["feature"][0, 0]
    left = x[:, c] <= m["edges"][c][m["cut"][0, 0]]
    assert gain(left) == pytest.approx(best)
    want = np.where(left, -g[left].sum() / (h[left].sum() + 1), -g[~left].sum() / (h[~left].sum() + 1))
    assert np.allclose(ln.score(m, x), ln.sigmoid(want), atol=1e-6)


def test_boosting_lowers_the_loss_each_round_and_deeper_trees_fit_closer():
    x, y = data()
    loss = [-np.mean(np.log(np.where(y == 1, p, 1 - p))) for p in (ln.score(ln.boost(x, y, k, 3, 0.1, 1.0, 1.0), x) for k in (1, 5, 20, 60))]
    assert loss == sorted(loss, reverse=True)
    assert ln.auc(y, ln.score(ln.boost(x, y, 40, 6, 0.1, 0.8, 0.8), x)) > ln.auc(y, ln.score(ln.boost(x, y, 40, 1, 0.1, 0.8, 0.8), x))


def test_forest_leaves_keep_their_least_rows_and_depth():
    x, y = data()
    held = data(seed=2)
    for depth, leaf in ((3, 5), (None, 1), (None, 40)):
        m = ln.forest(x, y, 20, depth, leaf)
        assert ln.auc(held[1], ln.score(m, held[0])) > 0.75
        for many, feature, _, left, value in m["grown"]:
            assert ((value >= 0) & (value <= 1)).all() and len(feature) == many + 2 * (feature >= 0).sum()
            level, at = 0, np.arange(many)
            while len(at):
                inner = at[feature[at] >= 0]
                at = np.concatenate([left[inner], left[inner] + 1])
                level += bool(len(inner))
            assert depth is None or level <= depth
    full = ln.forest(x, y, 60, None, 1)
    assert ln.auc(y, ln.score(full, x)) > 0.95


def test_logistic_is_the_minimum_that_spark_finds(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    x, y = data(400)
    m = ln.logistic(x, y, 1.0)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x.tolist(), y, w)], ["features", "label", "weight"])
    fit = LogisticRegression(weightCol="weight", regParam=1 / w.sum(), standardization=False, maxIter=2000, tol=1e-12).fit(df)
    assert np.allclose(m["weights"], [*fit.coefficients, fit.intercept], atol=1e-4)


def test_net_learns_and_its_penalty_shrinks_weights():
    x, y = data()
    a, b = ln.net(x, y, (16,), 1e-4, 120), ln.net(x, y, (16,), 30.0, 120)
    assert ln.auc(y, ln.score(a, x)) > 0.8
    assert sum((w ** 2).sum() for w in b["params"][::2]) < 0.8 * sum((w ** 2).sum() for w in a["params"][::2])


@pytest.fixture(scope="module")
def rows(spark):
    return classify.training_folds(classify.model_data(spark, SF))


def test_synthetic_rows_stand_between_rows_of_their_own_side(rows):
    sample = tuning.gather(rows, 5, oversample=True)
    assert set(sample.drawn) == {-1, 0, 1, 2, 3, 4}
    for held, (i, j, gap) in sample.drawn.items():
        assert (sample.fold[i] != held).all() and (sample.fold[j] != held).all() and (i != j).all()
        assert (sample.label[i] == 1).all() and (sample.label[j] == 1).all() and (0 <= gap).all() and (gap < 1).all()
        x, y = sample.training_side(held)
        own = (sample.fold != held).sum()
        assert y.sum() * 2 == len(y) and len(x) == own + len(i)
        near = sample.x[(sample.fold != held) & (sample.label == 1)]
        for k in range(0, len(i), 97):  # the neighbour is among the five nearest of its side
            d = np.sort(((near - sample.x[i[k]]) ** 2).sum(1))[1:6]
            assert ((sample.x[j[k]] - sample.x[i[k]]) ** 2).sum() <= d[-1] * (1 + 1e-5) + 1e-9
            assert np.allclose(x[own + k], sample.x[i[k]] + gap[k] * (sample.x[j[k]] - sample.x[i[k]]), atol=1e-5)


def test_search_takes_the_best_mean_and_never_the_held_out_rows(spark, rows):
    scores, best, models = tuning.search(rows, list(SMALL), grids=SMALL)
    got = {}
    for r in scores.collect():
        got.setdefault((r.model, r.params), []).append((r.fold, r.auc))
    assert len(got) == sum(len(tuning.grid_points(n, SMALL)) for n in SMALL) and all(sorted(f for f, _ in v) == list(range(5)) for v in got.values())
    for r in best.collect():
        means = {p: np.mean([a for _, a in v]) for (m, p), v in got.items() if m == r.model}
        assert r.mean_auc == pytest.approx(max(means.values())) and means[r.params] == pytest.approx(r.mean_auc)
    assert set(models) == set(SMALL)
    sample = tuning.gather(rows, 5)
    wrong = tuning.Sample(sample.x, np.where(sample.fold == 2, 1 - sample.label, sample.label), sample.fold, {})
    a, b = (tuning._fit("logreg", {"c": 1}, s, 2) for s in (sample, wrong))
    assert np.allclose(a["weights"], b["weights"])


def test_a_sample_bounds_what_is_gathered(rows):
    n = rows.count()
    assert tuning.fitting_rows(rows, n).count() == n
    some = tuning.fitting_rows(rows, n // 4).count()
    assert 0.15 * n < some < 0.35 * n


@pytest.mark.parametrize("oversample", [False, True])
def test_leaderboard_searches_every_model(spark, oversample):
    got = classify.leaderboard(spark, SF, oversample=oversample, grids=SMALL).collect()
    assert {r.model for r in got} == {"logreg", "rf", "gbt", "mlp"} and all(r.oversampled == oversample for r in got)
    assert [r.test_auc for r in got] == sorted((r.test_auc for r in got), reverse=True)
    assert all(0 <= r.val_auc <= 1 and 0 <= r.mean_auc <= 1 and r.params for r in got)


def test_scores_in_place_equal_scores_of_the_sample(spark, rows):
    sample = tuning.gather(rows, 5)
    model = tuning.final_models(spark, sample, [("gbt", tuning.grid_points("gbt", SMALL)[0])])["gbt"]
    got = [r.score for r in tuning.apply(rows.select("row_id", "features"), model).orderBy("row_id").collect()]
    assert np.allclose(got, ln.score(model, sample.x))


def test_a_fitted_raw_pipeline_scores_batch_and_stream_alike(spark):
    """Raw records through a saved logistic pipeline: both ways equal, and equal to the prepared rows' scores."""
    from pyspark.ml.classification import LogisticRegression
    from tessera.sources import io
    from tessera.streaming import jobs
    c = scoring.raw_records(spark, SF).withColumn("label", (F.col("y") == "yes").cast("double"))
    model = scoring.raw_pipeline(c.where("split = 'train'"), LogisticRegression(regParam=0.01, standardization=False))
    landing, folder = jobs.scratch(spark, "records"), jobs.scratch(spark, "pipeline")
    new = c.where("split <> 'train'").drop("split", "y", "label")
    odd = new.limit(3).withColumns({"row_id": -F.col("row_id"), "segment": F.lit("never seen"), "previous": F.lit(-1).cast(new.schema["previous"].dataType)})
    new.unionByName(odd.withColumn("campaign", F.lit(None).cast("long"))).write.parquet(landing)
    io.save_model(model, folder)
    unseen = model.transform(odd).select("segment__oh").first()[0]
    assert unseen.numNonzeros() == 0 and unseen.size == new.select("segment").distinct().count()
    batch = {r.row_id: r.score for r in scoring.score_batch(spark, landing, folder).collect()}
    stream = {r.row_id: r.score for r in scoring.score_arriving(spark, landing, new.schema, folder).collect()}
    assert batch.keys() == stream.keys() and all(batch[k] == stream[k] or batch[k] != batch[k] for k in batch) and len(batch) == new.count() + 3
    prepared = classify.model_data(spark, SF).where("split <> 'train'")
    direct = {r.row_id: r.score for r in ml.score(prepared, model.stages[-1]).select("row_id", "score").collect()}
    assert all(direct[k] == pytest.approx(batch[k], abs=2e-6) for k in direct)
