"""Operators rewritten to scale: equal to brute force, in tasks of bounded size."""

import numpy as np
import pytest

from tessera.operators import allocation as al
from tessera.operators import neighbors as nb


@pytest.mark.parametrize("kind", ["normal", "ties", "equal", "odd"])
def test_nearest_equals_brute_force(kind):
    r, n, k = np.random.default_rng(0), 900, 5
    x = {"normal": r.normal(size=(n, 6)), "ties": r.integers(0, 3, (n, 5)).astype(float), "equal": np.zeros((n, 3)),
         "odd": np.where(r.random((n, 4)) < 0.002, np.nan, r.normal(size=(n, 4)) + 1e4)}[kind]
    ids, d2, got = r.permutation(n), np.zeros((n, n)), {}
    for t in range(x.shape[1]):
        d2 += (x[:, t][:, None] - x[:, t]) ** 2
    for i, j, d in zip(*nb.nearest(x, ids, x, ids, k)):
        got.setdefault(i, []).append((np.nan_to_num(d, nan=np.inf), ids[j]))
    for i in range(n):
        assert sorted(got[i]) == sorted((np.nan_to_num(d2[i, j], nan=np.inf), ids[j]) for j in range(n) if j != i)[:k]


def test_chunks_of_a_neighbour_search_agree_with_one(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, r.integers(0, 5, 3).astype(float).tolist(), i % 3) for i in range(300)], "id long, v array<double>, fold int")
    whole = sorted(map(tuple, nb.knn_join(rows, "id", "v", 4).collect()))
    monkeypatch.setattr(nb, "CHUNK_BYTES", 1500)
    assert sorted(map(tuple, nb.knn_join(rows, "id", "v", 4).collect())) == whole and len(whole) == 1200
    parts = nb.near_pairs(rows, "id", "v", 4, part=["fold"])
    assert sorted(map(tuple, nb._topk(parts, 4).select("i", "j", "rank", "d2").collect())) == whole
    own = nb._topk(parts.where("fold <> 1"), 4).select("i", "j", "rank", "d2").where("i % 3 <> 1").collect()
    assert sorted(map(tuple, own)) == sorted(map(tuple, nb.knn_join(rows.where("fold <> 1"), "id", "v", 4).collect()))


def test_dominated_counts_equal_all_pairs(monkeypatch):
    r = np.random.default_rng(2)
    monkeypatch.setattr(al, "DOMINANCE_BOX", 60)
    for n in (0, 1, 40, 700):
        a, b, strict = r.integers(0, 8, (n, 4)), r.integers(0, 8, (n // 2 + 1, 4)), [False, False, True, True]
        assert al.count_dominated(a, b, strict) == sum(int(((x[:2] <= b[:, :2]).all(1) & (x[2:] < b[:, 2:]).all(1)).sum()) for x in a)


def test_dominated_pairs_of_many_sides_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(al, "DOMINANCE_ROWS", 30)
    r = np.random.default_rng(3)
    rows = [(p, i, int(r.integers(0, 20))) for p in (1, 2) for i in range(150)]
    rows += rows[:40] + [(1, 900, None)]
    use = [(p, i, k, int(r.integers(0, 9))) for p in (1, 2) for i in range(150) for k in (0, 1) if r.random() < 0.8]
    items = spark.createDataFrame(rows, "problem int, item long, profit long")
    cons = spark.createDataFrame(use, "problem int, item long, resource int, amount long")
    res = spark.createDataFrame([(p, k, f"r{k}", 100) for p in (1, 2) for k in (0, 1)], "problem int, resource int, name string, capacity long")
    amount = {(p, i, k): a for p, i, k, a in use}
    got = {x.problem: x.dominated_pairs for x in al.dominated_pairs(items, cons, res).collect()}
    for p in (1, 2):
        own = [(i, v, [amount.get((p, i, k), 0) for k in (0, 1)]) for q, i, v in rows if q == p and v is not None]
        assert got[p] == sum(x[0] < y[0] and x[1] > y[1] and all(s <= t for s, t in zip(x[2], y[2])) for x in own for y in own)


def test_sampled_attributions_draw_their_orders_once_and_spread(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from tessera.operators import explain as xp
    r = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, Vectors.dense(r.normal(size=3)), float(i % 2)) for i in range(60)], ["row_id", "features", "label"])
    model, cut = LogisticRegression(maxIter=5).fit(rows), []
    keep = xp.checkpoint
    monkeypatch.setattr(xp, "checkpoint", lambda df: cut.append(df.rdd.getNumPartitions()) or keep(df))
    phi = xp.sampled_shapley(rows.coalesce(1).limit(20), model, rows, n_perm=3, seed=1)
    assert phi.count() == 60 and len(cut) == 1 and cut[0] > 1
