"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words and word beginnings of a text learns from confirmed toxic
documents and from unlabelled ones, with the class prior correcting the risk: the positives' share is
subtracted from the unlabelled documents' negative risk, and where that difference would fall below
zero the step goes the other way.  Documents marked 0 serve only in the estimate of the class prior.

The classifier is fitted on a bounded sample: at most ``max_positives`` labelled toxic rows and about
``max_unlabelled`` other rows, both picked by a hash of the id, held-out rows never.  Features are the
ones frequent among the positives whose share differs clearly from the unlabelled share; both shares
are counted by Spark over the sample, and only the chosen features of the sample reach the driver.
Scoring reads every whole text once and moves nothing.

Defined cases: null and empty texts score by the bias alone; without labelled positives every score
is the class prior (0 without labels); a null doc_id is never labelled, held out or sampled; repeated
labels of one id count as shares; empty tables give empty results; other columns are not read (by the
filter: returned unchanged).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx
from tessera.llm.common import drawn_share, fold, label_shares, staged

THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
BEGINNINGS = (4, 5, 6)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text of each hash) of all lower-cased words and their first 4, 5 and 6 bytes."""
    data, offsets = tx.utf8(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, first = tx.runs(tx.WORD[data], offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    found, owner = [tx.hash_runs(data, starts, ends)], [doc]
    for k in BEGINNINGS:
        long = ends - starts > k
        found.append(tx.hash_runs(data, starts[long], starts[long] + k) ^ np.uint64(k))
        owner.append(doc[long])
    return np.concatenate(found), np.concatenate(owner)


def present(column: pa.Array, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place in the sorted ``chosen``) pairs of a text column."""
    if not len(chosen):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, doc = features(column)
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[chosen & np.uint64(0xFFFFF)] = True
    keep = maybe[hashes & np.uint64(0xFFFFF)]
    hashes, doc = hashes[keep], doc[keep]
    at = np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)
    hit = chosen[at] == hashes
    pair = np.unique(doc[hit] * len(chosen) + at[hit])
    return pair // len(chosen), pair % len(chosen)


@dataclass(frozen=True)
class Linear:
    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> pa.Array:
        out = []
        for part in tx.steps(pa.RecordBatch.from_arrays([column], names=["text"]), "text"):
            doc, at = present(part.column(0), self.chosen)
            z = self.bias + np.bincount(doc, weights=self.weights[at], minlength=part.num_rows)
            out.append(pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700)))))
        return pa.concat_arrays(out) if out else pa.array([], pa.float64())

    def column(self, text: Column) -> Column:
        @F.arrow_udf(T.DoubleType())
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for part in parts:
                yield self.score(part)
            tx.release()
        return run(text.cast("string"))


def fit_nnpu(doc: np.ndarray, at: np.ndarray, positive: np.ndarray, width: int, prior: float,
             steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk of the logistic loss, by Adam on the full
    sample.  (doc, at): the features present; positive: which sample rows are confirmed."""
    rows = len(positive)
    n_pos, n_unl = max(int(positive.sum()), 1), max(int((~positive).sum()), 1)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = np.bincount(doc, weights=theta[at], minlength=rows) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        as_negative = np.logaddexp(0, z)
        slack = as_negative[~positive].sum() / n_unl - prior * as_negative[positive].sum() / n_pos
        negative = np.where(positive, -prior * p / n_pos, p / n_unl)  # d(negative risk) / dz
        slope = negative + np.where(positive, prior * (p - 1) / n_pos, 0) if slack >= 0 else -negative
        grad = np.append(np.bincount(at, weights=slope[doc], minlength=width), slope.sum())
        grad[:-1] += decay * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad ** 2
        theta -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    # the bias that makes the mean score of the unlabelled rows the class prior
    z = (np.bincount(doc, weights=theta[at], minlength=rows))[~positive]
    low, high = -50.0, 50.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.mean(1 / (1 + np.exp(-np.clip(z + mid, -700, 700)))) < prior else (low, mid)
    return theta[:-1], low


def _frequent(sample: DataFrame, least: float) -> np.ndarray:
    """Sorted hashes of the features in at least ``least`` confirmed rows.  Their number is at most the
    features of one sample over ``least``, whatever the corpus."""
    def count(batches):
        for whole in batches:
            for part in tx.steps(whole, "text"):
                hashes, doc = features(part.column(0))
                order = np.lexsort((doc, hashes))
                h, d = hashes[order], doc[order]
                new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[:len(h)]
                kinds, n = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], names=["h", "n"])
    counts = sample.where("positive").select("text").mapInArrow(count, "h long, n long")
    rows = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().view(np.uint64))


def _shares(sample: DataFrame, chosen: np.ndarray) -> np.ndarray:
    """How many confirmed and how many other rows hold each chosen feature."""
    def count(batches):
        total = np.zeros((2, len(chosen)), dtype=np.int64)
        for whole in batches:
            for part in tx.steps(whole, "text"):
                doc, at = present(part.column(0), chosen)
                kind = part.column(1).to_numpy(zero_copy_only=False).astype(int)
                total += np.bincount(kind[doc] * len(chosen) + at, minlength=total.size).reshape(total.shape)
        some = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], names=["at", "unl", "pos"])
    out = np.zeros((2, len(chosen)))
    rows = (sample.select("text", "positive").mapInArrow(count, "at long, unl long, pos long")
            .groupBy("at").agg(F.sum("unl").alias("unl"), F.sum("pos").alias("pos")).toArrow())
    at = rows.column("at").to_numpy()
    out[0, at], out[1, at] = rows.column("unl").to_numpy(), rows.column("pos").to_numpy()
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_positives: int = 10_000, max_unlabelled: int = 20_000, least_share: float = 0.008,
          least_z: float = 5.0, least_precision: float = 0.5, least_weight: float = 0.15) -> Linear:
    """Fit on rows outside the held-out fold.

    A feature is chosen if the shares differ by ``least_z`` standard errors and, by the class prior, at
    least ``least_precision`` of the documents that hold it are toxic."""
    shares = label_shares(labels, "toxic").where(fold(F.col("label_id"), FOLDS) != HELD_OUT)
    total = shares.agg(F.sum("ones"), F.sum("zeros")).first()
    ones, zeros = (total[0] or 0), (total[1] or 0)
    prior = ones / (ones + zeros) if ones + zeros else 0.0
    if not ones:
        return Linear(np.zeros(0, np.uint64), np.zeros(0), -700.0)
    confirmed = (shares.where("ones >= zeros").orderBy(F.xxhash64("label_id"), "label_id").limit(max_positives)
                 .select("label_id", F.lit(True).alias("marked")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    share = min(1.0, max_unlabelled / max(rows.count(), 1))
    drawn = drawn_share(share, "doc_id", F.lit("unlabelled"))
    # the broadcast side has at most ``max_positives`` rows; a confirmed row that is also drawn counts as both
    both = (rows.join(F.broadcast(confirmed), F.col("doc_id") == F.col("label_id"), "left")
            .select("text", F.array_compact(F.array(F.when(F.col("marked"), F.lit(True)), F.when(drawn, F.lit(False)))).alias("as")))
    sample = staged(both.where(F.size("as") > 0).select(F.coalesce("text", F.lit("")).alias("text"), F.explode("as").alias("positive"))
                    .dropDuplicates(), "toxicity-sample")  # one copy of a text, so that copies don't vote
    n = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = n.get(True, 0), n.get(False, 0)
    if not n_pos or not n_unl:
        return Linear(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / max(1 - prior, 1e-9))))
    prior = min(prior, 0.99)
    known = _frequent(sample, max(3.0, least_share * n_pos))
    unl, pos = _shares(sample, known)
    mixed = (pos + unl) / (n_pos + n_unl)
    z = (pos / n_pos - unl / n_unl) / np.sqrt(np.maximum(mixed * (1 - mixed), 1e-12) * (1 / n_pos + 1 / n_unl))
    precision = prior * (pos / n_pos) / np.maximum(unl / n_unl, prior * pos / n_pos)
    chosen = known[(z >= least_z) & (precision >= least_precision)]

    def listed(batches):
        for whole in batches:
            for part in tx.steps(whole, "text"):
                doc, at = present(part.column(0), chosen)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))], names=["positive", "at"])
    rows = sample.select("text", "positive").mapInArrow(listed, "positive boolean, at array<int>").toArrow()
    lists = rows.column("at").combine_chunks()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    at = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    positive = rows.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    doc = np.repeat(np.arange(len(size)), size)
    weights, _ = fit_nnpu(doc, at, positive, len(chosen), prior)
    # features that carry little are dropped and the rest fitted again: many small weights add up in long texts
    strong = weights >= least_weight * weights.max(initial=0)
    place = np.cumsum(strong) - 1
    own = strong[at]
    weights, bias = fit_nnpu(doc[own], place[at[own]], positive, int(strong.sum()), prior)
    return Linear(chosen[strong], weights, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (toxic likelier when higher), predicted of every document."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), model.column(F.col(text_col)).alias("score"))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not call toxic."""
    return docs.where(train(docs, labels, id_col, text_col).column(F.col(text_col)) < threshold)
