"""Property tests for operators without an SQL oracle (fits, searches,
streams) and brute-force checks on small fixtures."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def alloc(spark):
    from tessera.plans.q_allocation import _alloc
    items, cons, res = _alloc(spark, SF_SMALL)
    return items.cache(), cons.cache(), res.cache()


def _py_greedy(items, cons, res):
    cap = {r["resource"]: r["capacity"] for r in res.collect()}
    amt = {}
    for r in cons.collect():
        amt.setdefault(r["item"], {})[r["resource"]] = r["amount"]
    order = sorted(((r["profit"], r["item"]) for r in items.collect()), key=lambda t: (-t[0], t[1]))
    chosen = []
    for _p, it in order:
        a = amt.get(it, {})
        if all(a.get(k, 0) <= cap[k] for k in cap):
            chosen.append(it)
            for k in cap:
                cap[k] -= a.get(k, 0)
    return chosen, order


def test_greedy_matches_sequential(alloc):
    from tessera.operators.allocation import greedy_select, prefix_greedy
    items, cons, res = alloc
    expect, order = _py_greedy(items, cons, res)
    got = sorted(r["item"] for r in greedy_select(items, cons, res).collect())
    assert got == sorted(expect)
    pre = [r["item"] for r in prefix_greedy(items, cons, res).collect()]
    ranked = [it for _p, it in order]
    assert sorted(pre) == sorted(ranked[:len(pre)])          # a prefix of the profit order
    assert set(pre) <= set(expect)                            # equal to greedy up to its first rejection


def test_repair_makes_every_chromosome_feasible(spark, alloc):
    from tessera.operators import search as se
    items, cons, res = alloc
    loci = se.item_positions(items)
    runs = se.make_runs(loci, [{"pop_size": 8, "crossover_rate": 0.7, "mutation_rate": 0.01}])
    pop = se.population_repair(se.population_init(runs, loci, seed=3), cons, res, gen=0)
    use = (pop.filter(F.col("bit") == 1).join(cons, ["problem", "item"])
           .groupBy("run", "chrom", "resource").agg(F.sum("amount").alias("u"))
           .join(res.select("problem", "resource", "capacity").drop("problem"), "resource"))
    assert use.filter(F.col("u") > F.col("capacity")).count() == 0


def test_evolve_curve_monotone_and_best_consistent(spark, alloc):
    from tessera.operators import search as se
    items, cons, res = alloc
    grid = [{"pop_size": 10, "crossover_rate": 0.7, "mutation_rate": 0.01},
            {"pop_size": 6, "crossover_rate": 0.9, "mutation_rate": 0.05}]
    runs, curve, best = se.evolve(items, cons, res, grid, generations=3, seed=5)
    rows = curve.orderBy("run", "gen").collect()
    by_run = {}
    for r in rows:
        by_run.setdefault(r["run"], []).append(r["best_so_far"])
    assert len(by_run) == 2 and all(v == sorted(v) for v in by_run.values())
    profit = {r["item"]: r["profit"] for r in items.collect()}
    for b in best.collect():
        assert sum(profit[i] for i in b["items"]) == b["fitness"]
        assert b["fitness"] == by_run[b["run"]][-1]
    t = se.tune(runs, best).collect()
    assert len(t) == 1 and t[0]["best_profit"] == max(b["fitness"] for b in best.collect())


def test_dual_bound_above_feasible_profit(alloc):
    from tessera.operators.allocation import evaluate_selection, greedy_select
    from tessera.operators.search import dual_bound
    items, cons, res = alloc
    ev = evaluate_selection(greedy_select(items, cons, res), items, cons, res).first()
    bound = dual_bound(items, cons, res, iters=5).first()["bound"]
    assert ev["feasible"] and bound >= ev["total_profit"]


def test_stream_scores_equal_batch(spark):
    from tessera.operators import ml
    from tessera.plans import classify
    from tessera.streaming import jobs
    x = classify.model_data(spark, SF_SMALL)
    model = ml.train(x.filter(F.col("split") == "train"), "logreg")
    landing = jobs.scratch(spark, "landing-test")
    x.filter(F.col("split") != "train").select("row_id", "features").write.parquet(landing)
    s = jobs.score_stream(spark, landing, spark.read.parquet(landing).schema, model)
    b = ml.score(x.filter(F.col("split") != "train"), model).select("row_id", "score")
    d = s.join(b.withColumnRenamed("score", "b"), "row_id")
    assert d.count() == b.count() == s.count()
    assert d.filter(F.abs(F.col("score") - F.col("b")) > 1e-12).count() == 0


def test_model_save_load_same_predictions(spark):
    from pyspark.ml import Pipeline
    from tessera.operators import ml
    from tessera.plans import classify
    from tessera.sources import io
    x = classify.model_data(spark, SF_SMALL)
    tr = x.filter(F.col("split") == "train")
    pm = Pipeline(stages=[ml.MODELS["logreg"]()]).fit(tr)
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-model-", dir="/tmp"), "m")
    io.save_model(pm, path)
    again = io.load_model(path)
    a = ml.score(x, pm).select("row_id", "score")
    b = ml.score(x, again).select("row_id", F.col("score").alias("s2"))
    assert a.join(b, "row_id").filter(F.col("score") != F.col("s2")).count() == 0


def test_sampled_shapley_efficiency(spark):
    from pyspark.ml.functions import vector_to_array
    from tessera.operators import explain as xp, ml
    from tessera.plans import classify
    x = classify.model_data(spark, SF_SMALL)
    tr = x.filter(F.col("split") == "train")
    model = ml.train(tr, "logreg")
    rows = x.filter(F.col("split") == "test").orderBy("row_id").limit(3)
    phi = xp.sampled_shapley(rows, model, tr, n_perm=3, seed=1)
    tot = phi.groupBy("row_id").agg(F.sum("phi").alias("s"))
    d = len(rows.first()["features"])
    bg = tr.select(vector_to_array("features").alias("a")).agg(F.array(*[F.avg(F.col("a")[i]) for i in range(d)]).alias("m"))
    from pyspark.ml.functions import array_to_vector
    fb = ml.score(bg.select(array_to_vector("m").alias("features")), model).first()["score"]
    fx_ = {r["row_id"]: r["score"] for r in ml.score(rows, model).collect()}
    for r in tot.collect():
        assert abs(r["s"] - (fx_[r["row_id"]] - fb)) < 1e-9


def test_scan_instances_multi_problem_file(spark, tmp_path):
    from tessera.sources import io
    # two problems, lines wrapped at arbitrary places
    text = "2\n3 2 10\n5 6\n7\n1 2 3 4\n5 6\n8 9\n2 1 0\n4 5\n1\n2\n3\n"
    p = tmp_path / "inst.txt"
    p.write_text(text)
    probs, items, res, cons = io.scan_instances(spark, str(p))
    assert sorted((r["problem"], r["n_items"], r["n_resources"]) for r in probs.collect()) == [("inst.txt#1", 3, 2), ("inst.txt#2", 2, 1)]
    assert sorted((int(r["problem"][-1]), r["item"], r["profit"]) for r in items.collect()) == \
        [(1, 0, 5000), (1, 1, 6000), (1, 2, 7000), (2, 0, 4000), (2, 1, 5000)]
    assert sorted((int(r["problem"][-1]), r["resource"], r["item"], r["amount"]) for r in cons.collect()) == \
        [(1, 0, 0, 1), (1, 0, 1, 2), (1, 0, 2, 3), (1, 1, 0, 4), (1, 1, 1, 5), (1, 1, 2, 6), (2, 0, 0, 1), (2, 0, 1, 2)]
    assert sorted((int(r["problem"][-1]), r["resource"], r["capacity"]) for r in res.collect()) == [(1, 0, 8), (1, 1, 9), (2, 0, 3)]


def test_scan_instances_of_two_files_stay_apart(spark, tmp_path):
    from tessera.sources import io
    for name, profit in (("a.txt", 5), ("b.txt", 9)):
        (tmp_path / name).write_text(f"1\n2 1 0\n{profit} {profit}\n1 2\n3\n")
    probs, items, _, _ = io.scan_instances(spark, str(tmp_path))
    assert sorted(r["problem"] for r in probs.collect()) == ["a.txt#1", "b.txt#1"]
    assert sorted((r["problem"], r["profit"]) for r in items.collect()) == [("a.txt#1", 5000)] * 2 + [("b.txt#1", 9000)] * 2


def test_instances_with_a_thousand_resources_round_trip(spark, tmp_path):
    from tessera.sources import io
    items = spark.createDataFrame([(1, 0, "c", 3000), (1, 1, "c", 4000)], "problem int, item long, category string, profit long")
    res = spark.createDataFrame([(1, k, f"r{k}", 10 + k) for k in range(1000)], "problem int, resource int, name string, capacity long")
    cons = spark.createDataFrame([(1, k, i, 3 + k + i) for k in range(1000) for i in range(2)], "problem int, resource int, item long, amount long")
    io.write_instances_text(items, res, cons, str(tmp_path / "x"))
    _, _, back_res, back = io.scan_instances(spark, str(tmp_path / "x"))
    assert sorted((r["resource"], r["capacity"]) for r in back_res.collect()) == [(k, 10 + k) for k in range(1000)]
    assert all(r["amount"] == 3 + r["resource"] + r["item"] for r in back.collect()) and back.count() == 2000


def test_a_model_that_fails_while_running_leaves_a_row(spark):
    from tessera.plans.forecasting import score_models
    actual = spark.sql("SELECT date_add(date'2024-01-01', CAST(id AS INT)) AS ds, id * 1.0D + 5 AS actual FROM range(40)")

    def bad():
        return actual.select("ds", F.raise_error(F.concat(F.lit("no fit at "), F.col("ds").cast("string"))).cast("double").alias("yhat"))
    got = {r["model"]: r for r in score_models(actual, {"bad": bad, "good": lambda: actual.select("ds", (F.col("actual") + 1).alias("yhat"))}).collect()}
    assert got["good"]["status"] == "ok" and abs(got["good"]["MAE"] - 1) < 1e-9
    assert "no fit" in got["bad"]["status"] and got["bad"]["MAE"] is None


def test_smote_count_and_segments(spark):
    from tessera.operators import neighbors as nb
    from tessera.sources.tables import table
    emb = table(spark, SF_SMALL, "embeddings")
    s = nb.smote(emb, "vec_id", "embedding", "label", 5, k=5, seed=42)
    n_min = emb.filter(F.col("label") == 5).count()
    assert s.count() == emb.count() - 2 * n_min
    assert s.filter((F.col("gap") < 0) | (F.col("gap") >= 1)).count() == 0


def test_approximate_paths_close_to_exact(spark):
    from tessera.operators import profile as pr
    from tessera.sources import fixtures as fx
    c = fx.campaign(spark, SF_SMALL).cache()
    ex = {r["column_name"]: r for r in pr.summary(c, ["total", "campaign"]).collect()}
    ap = {r["column_name"]: r for r in pr.summary(c, ["total", "campaign"], approx=True).collect()}
    for k in ex:
        rng = ex[k]["range"]
        for q in ("q1", "median", "q3"):
            assert abs(ex[k][q] - ap[k][q]) <= 0.01 * rng
    exact = {r["grid_index"]: r["density"] for r in pr.kde(c, "total", grid=200).collect()}
    binned = {r["grid_index"]: r["density"] for r in pr.kde(c, "total", grid=200, bins=2000).collect()}
    peak = max(exact.values())
    assert max(abs(exact[g] - binned[g]) for g in exact) <= 0.01 * peak


def test_skew_safe_ordinal_and_prefix_sums_equal_plain_windows(spark):
    from pyspark.sql import Window
    from tessera.operators.ordering import ordinal, prefix_sums
    from tessera.sources.tables import table
    # make one customer hold a third of the orders (a hot group)
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    o = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))) \
         .withColumn("o_day", F.to_date("o_orderdate"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    plain = o.select("o_orderkey", (F.row_number().over(w) - 1).alias("p"), F.lag("o_orderstatus").over(w).alias("ps"),
                     F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"))
    a = ordinal(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_day"), name="q", prev=["o_orderstatus"])
    b = prefix_sums(o, ["o_orderdate", "o_orderkey"], ["o_totalprice"], F.col("o_day"), by=["o_custkey"])
    j = plain.join(a.select("o_orderkey", "q", "prev_o_orderstatus"), "o_orderkey").join(
        b.select("o_orderkey", "o_totalprice_cum"), "o_orderkey")
    assert j.count() == o.count()
    bad = j.filter((F.col("p") != F.col("q")) | ~F.col("ps").eqNullSafe(F.col("prev_o_orderstatus"))
                   | (F.abs(F.col("cs") - F.col("o_totalprice_cum")) > 1e-6 * F.abs(F.col("cs"))))
    assert bad.count() == 0


def test_exact_quantiles_of_skewed_groups(spark):
    import numpy as np
    from tessera.operators import profile as pr
    rng = np.random.default_rng(0)
    groups = {"a": rng.pareto(1.0, 6000) * 1000, None: np.r_[np.zeros(500), rng.normal(size=7)], "c": np.array([3.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in pr.exact_quantiles(df, ["x"], (0.25, 0.9), ["g"]).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert np.allclose(got[k], np.quantile(vs, [0.25, 0.9]))
    assert {r["g"] for r in pr.summary(df, ["x"], ["g"]).collect()} == {"a", None, "c", "d"}


@pytest.mark.parametrize("name, rows", [("x03_linear_importance", None), ("x06_explain_saved_logreg", None),
                                        ("x02_sampled_shapley_importance", 200), ("x06_explain_saved_gbt", 200)])
def test_importance_ranks_all_rows_or_the_references_sample(spark, monkeypatch, name, rows):
    from tessera.operators import explain, ml
    from tessera.plans import classify
    from tessera.plans.registry import load_all
    ranked, whole = [], explain.global_importance
    tiny = spark.createDataFrame([(i, i, float(i)) for i in range(5)], "row_id int, feature_index int, phi double")
    monkeypatch.setitem(ml.MODELS, "rf", lambda: ml.RandomForestClassifier(numTrees=2, maxDepth=2, seed=1))
    monkeypatch.setitem(ml.MODELS, "gbt", lambda: ml.GBTClassifier(maxIter=2, maxDepth=2, seed=1))
    monkeypatch.setattr(explain, "sampled_shapley", lambda df, *a, **k: ranked.append(df) or tiny)
    monkeypatch.setattr(explain, "global_importance", lambda phi, k=5: ranked.append(phi) or whole(phi, k))
    assert load_all()[name][0](spark, SF_SMALL).count() == 5
    test = classify.model_data(spark, SF_SMALL).filter(F.col("split") == "test").count()
    assert test > 200 and ranked[0].select("row_id").distinct().count() == (rows or test)


def test_models_have_the_references_sizes():
    from tessera.operators import ml
    sizes = {n: m() for n, m in ml.MODELS.items()}
    assert [sizes["rf"].getNumTrees(), *(sizes[n].getMaxIter() for n in ("gbt", "mlp", "logreg"))] == [600, 800, 300, 2000]
