"""Quality by regularised quadratic discriminant analysis of document statistics.

Every whole text becomes a short vector of transformed statistics (shares of character classes under
an arcsine-root transform, logarithms of lengths, repetition of words and lines); ratios of short texts
shrink to the ratios of the whole corpus.  Class means and
covariances are exact sums over all labelled documents outside the held-out fold, gathered as one
(k + 1) x (k + 1) matrix per class.  Covariances shrink towards the pooled covariance and its
diagonal; their Cholesky factors are computed once and sent with the tasks, where the score is the
logistic function of the Mahalanobis log-density difference plus the log prior ratio.

Defined cases: null and empty texts have the statistics of an empty text and get a score; texts are
used whole; a null doc_id is never labelled and never held out; repeated labels of one id count as
shares; with fewer than two classes the score is the share of label 1 (0.5 without labels); empty
tables give empty results; other columns are not read (by the filter: returned unchanged).
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
from tessera.llm.common import batch_bytes, fold, label_shares, staged

THRESHOLD = 0.3
FOLDS = 5
TEXT_BYTES = 4 << 20  # texts in one Arrow batch

# character classes: code of each byte
_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
            "space": b" \t\r", "line": b"\n", "stop": b".,;:", "bar": b"|", "bang": b"!?", "quote": b"'\"()-"}
_NAMES = [*_CLASSES, "symbol", "high"]
_CODE = np.full(256, _NAMES.index("symbol"), dtype=np.uint8)
for _i, _chars in enumerate(_CLASSES.values()):
    _CODE[list(_chars)] = _i
_CODE[128:] = _NAMES.index("high")
_SPACE = tx.ASCII_SPACE
_LINE = tx.byte_table(b"\n")


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the runs of each text."""
    return np.diff(np.append(0, np.cumsum(values))[first])


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct hashes, and occurrences of the most frequent one."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))) if len(d) else np.zeros(0, np.int64)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, d[new], np.diff(np.append(new, len(d))))
    return np.bincount(d[new], minlength=n), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of counts per text: the parts of all ratios, then their wholes."""
    data, offsets = tx.utf8(column)
    n, size = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    counts = np.bincount(doc * len(_NAMES) + _CODE[data], minlength=n * len(_NAMES)).reshape(n, -1).astype(float)
    shown = np.maximum(size - counts[:, _NAMES.index("space")] - counts[:, _NAMES.index("line")], 0.0)

    starts, ends, first = tx.runs(~_SPACE[data], offsets)
    words, length = np.diff(first).astype(float), (ends - starts).astype(float)
    mean = _per_text(length, first) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(_per_text(length ** 2, first) / np.maximum(words, 1) - mean ** 2, 0))
    hashes = tx.hash_runs(data, starts, ends)
    kinds, top = _distinct(hashes, first)
    same = np.zeros(len(hashes))
    if len(hashes):
        same[1:] = hashes[1:] == hashes[:-1]
        same[first[:-1][first[:-1] < len(hashes)]] = 0
    lstarts, lends, lfirst = tx.runs(~_LINE[data], offsets)
    lines = np.diff(lfirst).astype(float)
    line_kinds, _ = _distinct(tx.hash_runs(data, lstarts, lends), lfirst)
    short = _per_text((length <= 3).astype(float), first)
    # a word whose last character is a symbol, a bang or a bar on its own
    tail = _CODE[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    odd = _per_text(np.isin(tail, [_NAMES.index(x) for x in ("symbol", "bang", "bar")]).astype(float), first)

    shown_parts = [counts[:, _NAMES.index(x)] for x in ("digit", "stop", "bar", "bang", "quote", "symbol", "high")]
    parts = [counts[:, 1], *shown_parts, odd, short, kinds, top, _per_text(same, first), line_kinds,
             _per_text(length, first), _per_text(length ** 2, first), words]
    wholes = [counts[:, 0] + counts[:, 1], *[shown] * len(shown_parts), *[words] * 5, lines, words, words, lines]
    return np.column_stack([*parts, *wholes]).astype(float)


#: Shares of the parts in the wholes, then mean and mean square of the word lengths and words per line.
RATIOS, SHARES = 17, 14
WIDTH = RATIOS + 1
#: Weight, in units of the whole, of the corpus ratio that every ratio shrinks to: a very short text
#: says little about its shares.
_WEIGHT = np.array([60.0, *[60.0] * 7, *[15.0] * 5, 2.0, 15.0, 15.0, 2.0])


def transformed(raw: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The vector that the discriminant sees: ratios shrunk to ``prior``, arcsine roots of shares and
    logarithms of lengths."""
    ratio = (raw[:, :RATIOS] + _WEIGHT * prior) / (raw[:, RATIOS:] + _WEIGHT)
    shares = np.arcsin(np.sqrt(np.clip(ratio[:, :SHARES], 0, 1)))
    mean, square, per_line = ratio[:, SHARES:].T
    spread = np.sqrt(np.maximum(square - mean ** 2, 0))
    return np.column_stack([shares, np.log1p(mean), np.log1p(spread), np.log1p(per_line), np.log1p(raw[:, RATIOS + 10])])


def statistics_column(text: Column) -> Column:
    """:func:`statistics` of a text column as an array<double> column."""
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tx.release()  # what earlier stages left in this worker
        for part in parts:
            yield _by_steps(part, lambda c: pa.FixedSizeListArray.from_arrays(
                pa.array(statistics(c).ravel()), 2 * RATIOS).cast(pa.list_(pa.float64())), pa.list_(pa.float64()))
    return run(text)


def _by_steps(column: pa.Array, fn, kind: pa.DataType) -> pa.Array:
    """``fn`` over bounded parts of a text column."""
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    parts = [fn(b.column(0)) for b in tx.steps(batch, "text")]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@dataclass(frozen=True)
class Discriminant:
    """Shrunken class densities: means, inverse Cholesky factors, log determinants, log prior ratio."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    log_dets: tuple[float, float]
    log_prior: float
    ratios: np.ndarray

    def score(self, raw: np.ndarray) -> np.ndarray:
        x = transformed(raw, self.ratios)
        if self.means is None:
            z = np.full(len(x), self.log_prior)
        else:
            d0, d1 = (((x - m) @ f.T) ** 2 for m, f in zip(self.means, self.factors))
            z = 0.5 * (d0.sum(1) - d1.sum(1) + self.log_dets[0] - self.log_dets[1]) + self.log_prior
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def corpus_ratios(rows: DataFrame) -> np.ndarray:
    """Every part over its whole, summed over all documents."""
    sums = rows.select(*[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(2 * RATIOS)]).first()
    total = np.array([v or 0.0 for v in sums])
    return total[:RATIOS] / np.maximum(total[RATIOS:], 1.0)


def _sums(rows: DataFrame, prior: np.ndarray) -> list[np.ndarray]:
    """Per class the weighted sum of outer products of (1, statistics): exact, over all rows."""
    width = WIDTH + 1

    def partial(batches):
        total = np.zeros((2, width * width))
        for b in batches:
            x = np.vstack(b.column("x").to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, 2 * RATIOS))
            x = np.column_stack([np.ones(len(x)), transformed(x, prior)])
            for c, name in enumerate(("zeros", "ones")):
                w = b.column(name).to_numpy(zero_copy_only=False).astype(float)
                total[c] += ((x * w[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], width * width), type=pa.int32()), pa.array(np.tile(np.arange(width * width), 2), type=pa.int32()),
             pa.array(total.ravel())], names=["label", "cell", "value"])

    out = [np.zeros((width, width)) for _ in range(2)]
    parts = rows.select("x", "zeros", "ones").mapInArrow(partial, "label int, cell int, value double")
    for r in parts.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():  # 2 (k + 1)^2 rows
        out[r["label"]].flat[r["cell"]] = r["value"]
    return out


def fit_discriminant(sums: list[np.ndarray], ratios: np.ndarray, to_pooled: float = 0.2, to_diagonal: float = 0.05,
                     ridge: float = 1e-4) -> Discriminant:
    n = [s[0, 0] for s in sums]
    if min(n) < 2:
        prior = n[1] / sum(n) if sum(n) else 0.5
        return Discriminant(None, None, (0.0, 0.0), float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))), ratios)
    means = [s[0, 1:] / c for s, c in zip(sums, n)]
    scatter = [s[1:, 1:] - c * np.outer(m, m) for s, c, m in zip(sums, n, means)]
    pooled = sum(scatter) / sum(n)
    factors, dets = [], []
    for s, c in zip(scatter, n):
        cov = (1 - to_pooled) * s / c + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + ridge * np.eye(len(cov))
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        dets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(dets), float(np.log(n[1] / n[0])), ratios)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and statistics of every whole text, staged."""
    with batch_bytes(docs.sparkSession, TEXT_BYTES):
        return staged(docs.select(F.col(id_col).alias("doc_id"), statistics_column(F.col(text_col).cast("string")).alias("x")), "statistics")


def train(rows: DataFrame, labels: DataFrame, folds: int = FOLDS) -> Discriminant:
    """Fit on the labelled rows of :func:`measured` whose fold is not 0."""
    shares = label_shares(labels, "quality")
    own = rows.where(fold(F.col("doc_id"), folds) != 0).join(shares, F.col("doc_id") == F.col("label_id"))
    ratios = corpus_ratios(rows)
    return fit_discriminant(_sums(own, ratios), ratios)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (label 1 likelier when higher), predicted of every document."""
    rows = measured(docs, id_col, text_col)
    model = train(rows, labels)

    @F.arrow_udf(T.DoubleType())
    def score(x: pa.Array) -> pa.Array:
        flat = pc.list_flatten(x).to_numpy(zero_copy_only=False)
        return pa.array(model.score(flat.reshape(-1, 2 * RATIOS)))

    return (rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
                        score("x").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the discriminant fitted on them accepts."""
    model = train(measured(docs, id_col, text_col), labels)

    @F.arrow_udf(T.DoubleType())
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield _by_steps(part, lambda c: pa.array(model.score(statistics(c))), pa.float64())
        tx.release()

    return docs.where(score(F.col(text_col).cast("string")) >= threshold)
