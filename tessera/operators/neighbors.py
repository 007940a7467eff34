"""Exact k-nearest-neighbour join and SMOTE oversampling.

kNN (J9) compares chunks: every chunk of queries meets every chunk of points in a task of its own, so
the memory of a task is bounded by ``CHUNK_BYTES`` whatever the input's size.  Inside a task both sides are
cut into boxes by medians; a box of queries visits the boxes of points in the order of their least distance
and stops when that exceeds the k-th distance found.  Matrix products only choose the candidates (with
a margin for their rounding); the distances of these are sums of squares.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform
from tessera.operators.ordering import ordinal
from tessera.session import ship_package


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length double arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def _topk(pairs: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*by, "i").orderBy("d2", "j")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


CHUNK_BYTES = 64 * 1024 * 1024  # of vectors in a chunk
CHUNKS, FEW = 6, 4096  # chunks at least, so that the work spreads over tasks, unless the rows are few
QUERY_BOX, POINT_BOX = 128, 512


def _boxes(x: np.ndarray, most: int) -> list[np.ndarray]:
    """The rows of ``x`` in groups of at most ``most``, halved at the median of the widest column."""
    todo, out = [np.arange(len(x))], []
    while todo:
        own = todo.pop()
        if len(own) <= most:
            out.append(own)
            continue
        v = x[own]
        with np.errstate(invalid="ignore"):
            wide = np.nan_to_num(v.max(0) - v.min(0), nan=0.0)
        cut = np.argpartition(v[:, wide.argmax()], len(own) // 2)
        todo += [own[cut[:len(own) // 2]], own[cut[len(own) // 2:]]]
    return out


def _first_of(i: np.ndarray, j: np.ndarray, d2: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest of every i, ties by j."""
    order = np.lexsort((j, d2, i))
    own = i[order]
    start = np.searchsorted(own, own)
    return order[np.arange(len(own)) - start < k]


def nearest(xi: np.ndarray, ids: np.ndarray, xj: np.ndarray, jds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of xi, row of xj and squared distance of the k nearest points of every query, ties by id; a row with the
    query's own id is no neighbour."""
    points = _boxes(xj, POINT_BOX)
    low, high = (np.nan_to_num(np.array([f(xj[p], axis=0) for p in points]), nan=x) for f, x in ((np.min, -np.inf), (np.max, np.inf)))
    norm, own_norm = (xj * xj).sum(1), (xi * xi).sum(1)
    # |q|^2 + |p|^2 - 2 qp as one product
    left, right = np.column_stack([xi, own_norm, np.ones(len(xi))]), np.column_stack([-2 * xj, np.ones(len(xj)), norm])
    odd = not (np.isfinite(norm).all() and np.isfinite(own_norm).all())
    slack = 1e-12 * (np.nan_to_num(norm).max() + np.nan_to_num(own_norm).max()) + 1e-300
    own_rows = np.unique(jds, return_counts=True)[1].max()  # so many of the k smallest may be the query itself
    found = []
    for box in _boxes(xi, QUERY_BOX):
        q = xi[box]
        with np.errstate(invalid="ignore"):
            gap = np.nan_to_num(np.maximum(0, np.maximum(low - q.max(0), q.min(0) - high)), nan=0.0)
        least = (gap * gap).sum(1)
        reach = np.full(len(box), np.inf)
        i, j, d2 = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(least, kind="stable"):
            if least[b] * (1 - 1e-9) > reach.max():
                break
            p = points[b]
            about = left[box] @ right[p].T
            if odd:
                about = np.where(np.isfinite(about), about, np.inf)
            bound = reach
            if np.isinf(reach).any() and len(p) >= k + own_rows:
                bound = np.fmin(reach, np.partition(about, k + own_rows - 1, axis=1)[:, k + own_rows - 1] + slack)
            r, c = np.nonzero(about <= (bound + slack)[:, None])
            other = ids[box[r]] != jds[p[c]]
            r, c = r[other], c[other]
            if not len(r):
                continue
            new, a, z = np.zeros(len(r)), q[r], xj[p[c]]
            for t in range(a.shape[1]):  # in the vectors' order, as sq_dist adds
                new += (a[:, t] - z[:, t]) ** 2
            i, j, d2 = np.concatenate([i, r]), np.concatenate([j, p[c]]), np.concatenate([d2, new])
            keep = _first_of(i, jds[j], d2, k)
            i, j, d2 = i[keep], j[keep], d2[keep]
            full = np.flatnonzero(np.bincount(i, minlength=len(box)) >= k)
            last = np.searchsorted(i, full, side="right") - 1
            reach[full] = np.where(np.isnan(d2[last]), np.inf, d2[last])
        found.append((box[i], j, d2))
    return tuple(np.concatenate([f[t] for f in found]) if found else np.zeros(0, np.int64 if t < 2 else float) for t in range(3))


def near_pairs(df: DataFrame, id_col: str, vec: str, k: int, by: Sequence[str] = (), part: Sequence[str] = ()) -> DataFrame:
    """by, i, j, d2, the ``part`` of j and (``own_``) of i: among them the k nearest of every row, in each part of its
    group for itself."""
    by, part = list(by), list(part)
    pts = df.select(*by, *part, F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull()))
    for c in [*by, *part]:
        pts = pts.where(F.col(c).isNotNull())
    pts = pts.withColumn("__n", F.size("v"))  # vectors of other lengths have no distance
    group = [*by, "__n"]
    count = pts.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows")).withColumn(
        "__chunks", F.greatest(F.ceil(F.col("__rows") * F.greatest("__n", F.lit(1)) * 8 / F.lit(CHUNK_BYTES)),
                               F.when(F.col("__rows") > FEW, CHUNKS).otherwise(1)).cast("int"))
    pts = pts.join(count.drop("__rows"), group).withColumn("__own", F.pmod(F.hash("id"), F.col("__chunks")))
    every = F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    # side 0: a chunk's rows as queries of every chunk; side 1: as points for every chunk
    met = pts.withColumnRenamed("__own", "__i").withColumns({"__j": every, "__side": F.lit(0)}).unionByName(
        pts.withColumnRenamed("__own", "__j").withColumns({"__i": every, "__side": F.lit(1)}))
    key = [*group, "__i", "__j"]
    out = pts.select(*by, F.col("id").alias("i"), F.col("id").alias("j"), *part, *[F.col(c).alias(f"own_{c}") for c in part], F.lit(0.0).alias("d2")).schema
    names = out.names

    ship_package(df.sparkSession)

    def matrix(t: pa.Table) -> np.ndarray:
        v = t.column("v").combine_chunks()
        return v.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) if t.num_rows else np.zeros((0, 0))

    def meet(both: pa.Table) -> pa.Table:
        side = both.column("__side").to_numpy()
        left, right = both.filter(pa.array(side == 0)), both.filter(pa.array(side == 1))
        xi, xj = matrix(left), matrix(right)
        ids, jds = (t.column("id").to_numpy() for t in (left, right))
        sides = np.unique(np.array([str(x) for x in zip(*(right.column(c).to_pylist() for c in part))]), return_inverse=True)[1] if part else np.zeros(len(jds), int)
        got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for s in range(int(sides.max()) + 1 if len(xi) and len(xj) else 0):
            own = np.flatnonzero(sides == s)
            i, j, d2 = nearest(xi, ids, xj[own], jds[own], k)
            got = [np.concatenate(z) for z in zip(got, (i, own[j], d2))]
        i, j = pa.array(got[0]), pa.array(got[1])
        cols = {c: left.column(c).take(i) for c in by} | {c: right.column(c).take(j) for c in part} | {f"own_{c}": left.column(c).take(i) for c in part}
        cols |= {"i": left.column("id").take(i), "j": right.column("id").take(j), "d2": pa.array(got[2])}
        return pa.table([cols[c] for c in names], names=names)
    # few bytes but much work: tasks are not to be merged by their size
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return met.repartition(tasks, *key).groupBy(*key).applyInArrow(meet, out)


def knn_join(df: DataFrame, id_col: str, vec: str, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """Exact kNN of every row among the rows of ``df`` (itself excluded):
    (i, j, rank 1..k, d2 squared distance); ties broken by j.  With ``by`` columns
    neighbours come from the same group only."""
    return _topk(near_pairs(df, id_col, vec, k, by), k, by).select(*by, "i", "j", "rank", "d2")


def smote(df: DataFrame, id_col: str, vec: str, label: str, minority, k: int = 5, seed: int = 42,
          n_new: int | None = None) -> DataFrame:
    """M8: synthesize minority rows to class parity: for synthetic row s, base
    row = minority row at position floor(u1 * n_min), neighbour = its
    (floor(u2 * k) + 1)-th nearest minority neighbour, x + u3 * (nn - x).
    Draws are hash_uniform(seed, s, 1..3), so the output is deterministic.
    Returns (synthetic_id, label, vector) rows; the count is n_maj - n_min."""
    mino = df.filter(F.col(label) == F.lit(minority)).select(F.col(id_col).alias("id"),
                                                               F.col(vec).cast("array<double>").alias("v"))
    counts = df.agg(F.sum((F.col(label) == F.lit(minority)).cast("long")).alias("n_min"),
                    F.sum((F.col(label) != F.lit(minority)).cast("long")).alias("n_maj"))
    mino_pos = ordinal(mino, by=[], order=["id"], bucket=F.floor(F.col("id") / 65536), name="pos")
    nn = knn_join(mino, "id", "v", k)
    spark = df.sparkSession
    c = counts.first()  # two numbers
    n_syn = n_new if n_new is not None else max(int(c["n_maj"]) - int(c["n_min"]), 0)
    n_min = int(c["n_min"])
    s = spark.range(n_syn).withColumnRenamed("id", "s")
    s = s.select("s",
                 F.floor(hash_uniform(seed, "s", F.lit(1)) * n_min).cast("long").alias("pos"),
                 (F.floor(hash_uniform(seed, "s", F.lit(2)) * k) + 1).cast("int").alias("rank"),
                 hash_uniform(seed, "s", F.lit(3)).alias("gap"))
    base = s.join(mino_pos.select("pos", F.col("id").alias("i"), F.col("v").alias("x")), "pos")
    base = base.join(nn.select("i", "rank", "j"), ["i", "rank"])
    base = base.join(mino.select(F.col("id").alias("j"), F.col("v").alias("xn")), "j")
    syn = F.zip_with("x", "xn", lambda a, b: a + F.col("gap") * (b - a))
    return base.select("s", F.lit(minority).alias(label), syn.alias(vec), "i", "j", "gap")


def smote_draws(df: DataFrame, id_col: str, vec: str, label: str, minority, by: str, k: int = 5, seed: int = 42,
                near: DataFrame | None = None) -> DataFrame:
    """M8 for several training sets at once, told apart by the column ``by``: per set and synthetic row ``s``
    the base row i, its drawn neighbour j and the step ``gap`` from i towards j.  Positions, neighbours and
    the number of synthetic rows (up to class parity) are those of the set, so no row of another set is used.
    ``near`` holds pairs (by, i, j, d2) with the k nearest of every minority row, if the caller has them.
    A set with fewer than two minority rows gets none; with fewer than k neighbours the draw is among these."""
    hit = F.col(label) == F.lit(minority)
    mino = df.filter(hit).select(by, F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    counts = df.groupBy(by).agg(F.sum(hit.cast("long")).alias("n_min"), F.sum((~hit).cast("long")).alias("n_maj"))
    placed = ordinal(mino.select(by, "id"), by=[by], order=["id"], bucket=F.floor(F.col("id") / 65536), name="pos")
    near = _topk(near, k, [by]) if near is not None else knn_join(mino, "id", "v", k, by=[by])
    block = 65536  # synthetic rows are listed in blocks, so no array grows with the set
    todo = (counts.where("n_min > 1 AND n_maj > n_min").withColumn("n", F.col("n_maj") - F.col("n_min"))
            .select(by, "n_min", "n", F.explode(F.expr(f"sequence(0, (n - 1) div {block})")).alias("b"))
            .select(by, "n_min", F.explode(F.expr(f"sequence(b * {block}, least(n, (b + 1) * {block}) - 1)")).alias("s")))
    drawn = todo.select(by, "s", F.floor(hash_uniform(seed, by, "s", F.lit(1)) * F.col("n_min")).cast("long").alias("pos"),
                        (F.floor(hash_uniform(seed, by, "s", F.lit(2)) * F.least(F.lit(k), F.col("n_min") - 1)) + 1).cast("int").alias("rank"),
                        hash_uniform(seed, by, "s", F.lit(3)).alias("gap"))
    return (drawn.join(placed.select(by, "pos", F.col("id").alias("i")), [by, "pos"])
            .join(near.select(by, "i", "rank", "j"), [by, "i", "rank"]).select(by, "s", "i", "j", "gap"))
