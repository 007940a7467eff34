"""Embedding near-duplicates by a forest of random-projection trees with spill overlap.

Equal vectors collapse to one row with a count first, so a group of copies costs nothing afterwards.
In every tree a node is split by a random direction at the median; rows within ``spill`` of the cut go
to both sides.  Cuts of up to five levels at a time are fitted on a bounded sample of each node
(``sample`` rows) by the tasks themselves, and every row is routed; a node that holds at most
``leaf_rows`` rows, or that no direction divides (a dense cluster), is a leaf.  Leaves larger than one
block are compared block pair by block pair in separate tasks.  A pair that meets in several leaves
counts in the first leaf that both share, so pairs are never listed: a task returns per row how many
links it found and one edge to the smallest member of its linked set.  Edges are united into components.

Cosines are taken in double precision on every pair that shares a leaf; no pair below the threshold
links.  Recall follows from the overlap and the number of trees (tests/llm measures it).

Defined cases: null vectors, vectors with null or non-finite components, zero and empty vectors and
rows without vec_id link with nothing; vectors of different lengths are never compared; rows that share
a vec_id are one node of the graph; a row without vec_id has no component and is not kept; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, drawn_share, staged

LEVELS = 5
SLOTS = 2 ** LEVELS - 1
TRIES = 3


def _direction(tree: int, node: int, slot: int, pick: int, dims: int) -> np.ndarray:
    v = np.random.default_rng([tree, node, slot, pick]).standard_normal(dims)
    return v / np.linalg.norm(v)


def _unit(vectors) -> np.ndarray:
    x = np.vstack(vectors).astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_node(x: np.ndarray, tree: int, node: int, rows: int, leaf_rows: int, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of one node from a sample of its unit vectors, in heap order: (threshold or NaN, which of the
    tried directions).  ``rows`` is how many rows the sample stands for."""
    cut, pick = np.full(SLOTS, np.nan), np.zeros(SLOTS, dtype=np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        slot, own = todo.pop()
        if slot >= SLOTS or len(own) < 8 or len(own) / len(x) * rows <= leaf_rows:
            continue
        best = None
        for k in range(TRIES):
            p = x[own] @ _direction(tree, node, slot, k, x.shape[1])
            at = float(np.median(p))
            larger = max((p < at + spill).sum(), (p >= at - spill).sum())
            if best is None or larger < best[0]:
                best = (larger, k, at, p)
        if best[0] > 0.85 * len(own):
            continue
        _, pick[slot], cut[slot], p = best
        todo += [(2 * slot + 1, own[p < cut[slot] + spill]), (2 * slot + 2, own[p >= cut[slot] - spill])]
    return cut, pick


def route(x: np.ndarray, tree: int, node: int, cut: np.ndarray, pick: np.ndarray, spill: float):
    """(row, slot) of every leaf of the fitted cuts that a row belongs to."""
    rows, slots = [], []
    todo = [(0, np.arange(len(x)))]
    while todo:
        slot, own = todo.pop()
        if slot >= SLOTS or np.isnan(cut[slot]):
            rows.append(own)
            slots.append(np.full(len(own), slot))
            continue
        p = x[own] @ _direction(tree, node, slot, int(pick[slot]), x.shape[1])
        todo += [(2 * slot + 1, own[p < cut[slot] + spill]), (2 * slot + 2, own[p >= cut[slot] - spill])]
    return np.concatenate(rows), np.concatenate(slots)


def _forest(vectors: DataFrame, trees: int, leaf_rows: int, sample: int, spill_share: float) -> DataFrame:
    """tree, node, rid, mult, vec: every vector in its leaves of all trees."""
    # vectors of another length have trees of their own
    rows = staged(vectors.select(F.explode(F.array(*[F.lit(t) + trees * F.size("vec") for t in range(trees)])).alias("tree"),
                                 F.lit(1).cast("long").alias("node"), "rid", "mult", "vec"), "forest-0")
    leaves, columns = None, ["tree", "node", "rid", "mult", "vec"]

    def reach(dims: int) -> float:
        return spill_share * np.sqrt(0.1 / dims)  # a pair at cosine 0.95 is sqrt(0.1) apart

    def fit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = _unit(pdf["vec"])
        cut, pick = fit_node(x, int(key[0]), int(key[1]), int(pdf["n"].iloc[0]), leaf_rows, reach(x.shape[1]))
        return pd.DataFrame({"tree": [key[0]], "node": [key[1]], "cut": [cut], "pick": [pick]})

    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.select(["tree", "node"]).to_pandas()
            for (tree, node), own in keys.groupby(["tree", "node"]).indices.items():
                part = b.take(pa.array(own))
                x = _unit(part.column("vec").to_numpy(zero_copy_only=False))
                at, slot = route(x, int(tree), int(node), np.asarray(part.column("cut")[0].as_py(), dtype=float),
                                 np.asarray(part.column("pick")[0].as_py()), reach(x.shape[1]))
                part = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column("tree"), pa.array(node * 64 + slot + 1), part.column("rid"), part.column("mult"), part.column("vec")],
                    names=columns)

    for _ in range(7):  # 32 ** 7 leaves of a tree
        counts = rows.groupBy("tree", "node").agg(F.count("*").alias("n"))
        sized = rows.join(counts, ["tree", "node"])
        drawn = drawn_share(F.lit(float(sample)) / F.col("n"), "rid", "tree", "node")
        cuts = staged(sized.where((F.col("n") > leaf_rows) & drawn).select("tree", "node", "n", "vec")
                      .groupBy("tree", "node").applyInPandas(fit, "tree int, node long, cut array<double>, pick array<int>")
                      .where(~F.isnan(F.col("cut")[0])), "forest-cuts")
        still = rows.join(cuts.select("tree", "node"), ["tree", "node"], "left_anti").select(*columns)
        leaves = still if leaves is None else leaves.unionByName(still)
        if cuts.isEmpty():
            return leaves
        rows = staged(rows.join(cuts, ["tree", "node"]).select(*columns, "cut", "pick").mapInArrow(place, rows.schema), "forest")
    return leaves.unionByName(rows)


def _linked(hits: np.ndarray, n: int) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches over the pairs ``hits``."""
    label = np.arange(n)
    while len(hits):
        low = np.minimum(label[hits[:, 0]], label[hits[:, 1]])
        new = label.copy()
        np.minimum.at(new, hits[:, 0], low)
        np.minimum.at(new, hits[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links and edges that belong to one pair of blocks of one leaf."""
    pdf = pdf.sort_values("rid", kind="stable").reset_index(drop=True)
    x = _unit(pdf["vec"])
    rid, mult, block = (pdf[c].to_numpy() for c in ("rid", "mult", "block"))
    leaf, low, high = pdf["leaf"].iloc[0], pdf["low"].iloc[0], pdf["high"].iloc[0]
    # one bit per leaf that comes before this one: a pair that shares such a leaf was counted there
    earlier = [np.asarray(v)[np.asarray(v) < leaf] for v in pdf["leaves"]]
    known = np.unique(np.concatenate(earlier)) if len(earlier) else np.zeros(0, np.int64)
    member = np.zeros((len(pdf), len(known) + 1), dtype=bool)
    for i, v in enumerate(earlier):
        member[i, np.searchsorted(known, v)] = True
    member = np.packbits(member, axis=1)
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found = []
    for lo in range(0, len(a), 512):
        rows = a[lo:lo + 512]
        i, j = np.nonzero(x[rows] @ x[b].T >= threshold)
        i, j = rows[i], b[j]
        keep = (i < j) if low == high else np.ones(len(i), dtype=bool)
        keep &= rid[i] != rid[j]
        i, j = i[keep], j[keep]
        step = max(1, 8_000_000 // member.shape[1])
        for k in range(0, len(i), step):
            p, q = i[k:k + step], j[k:k + step]
            found.append(np.column_stack([p, q])[~(member[p] & member[q]).any(1)])
    pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    n = len(pdf)
    links = np.bincount(pairs[:, 0], weights=mult[pairs[:, 1]], minlength=n) + np.bincount(pairs[:, 1], weights=mult[pairs[:, 0]], minlength=n)
    to = rid[_linked(pairs, n)]
    out = pd.DataFrame({"rid": rid, "links": links.astype(np.int64), "to": to})
    return out[(out.links > 0) | (out.to != out.rid)]


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                 trees: int = 4, leaf_rows: int = 512, block_rows: int = 2048, sample: int = 2048,
                 spill_share: float = 0.5) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vec = F.col(vec_col)
    norm = F.aggregate(vec, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    plain = ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col(id_col).isNotNull() & vec.isNotNull() & plain & (norm > 0)
    base = staged(embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                                    F.when(F.coalesce(good, F.lit(False)), vec).alias("vec")), "vectors")
    distinct = staged(base.where("vec IS NOT NULL").groupBy("vec").agg(F.min("vec_id").alias("rid"), F.count("*").alias("mult")), "distinct")

    # the leaf's number orders leaves by tree first, and it is the same for every row of the leaf
    placed = staged(_forest(distinct, trees, leaf_rows, sample, spill_share)
                    .withColumn("leaf", F.col("tree") * F.lit(1 << 44) + F.col("node")), "leaves")
    member = placed.groupBy("rid").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))  # trees x overlap entries
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n"))
    rows = (placed.select("leaf", "rid", "mult", "vec").join(sizes, "leaf").where("n > 1").join(member, "rid")
            .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "rid", "mult", "vec", "leaves"))
    met = staged(rows.groupBy("leaf", "low", "high").applyInPandas(
        lambda pdf: _compare(pdf, threshold), "rid long, links long, to long"), "met")

    links = met.groupBy("rid").agg(F.sum("links").alias("links"))
    parts = connected_components(met.where("rid <> to").select(F.col("rid").alias("a"), F.col("to").alias("b")))
    nodes = (distinct.groupBy("rid").agg(F.sum("mult").alias("mult")).join(links, "rid", "left")
             .join(parts.withColumnRenamed("id", "rid"), "rid", "left")
             .select("rid", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                     F.coalesce("component", "rid").alias("component_id")))
    named = base.join(distinct.select("vec", "rid"), "vec", "left")
    out = named.join(nodes, "rid", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
