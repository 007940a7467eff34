"""Language-model scores of documents: masked pseudo-likelihood of a bidirectional window network.

Words of the whole corpus are counted; the ``FREQUENT`` most frequent have ids of their own and every
other word falls into a hashed id, of which there are as many as the square root of the distinct words (at
least ``RARE``).  Within its id a word has its share of the id's count in the corpus: the distinct words of
every chunk of documents are joined with the counts of the whole corpus by hash range.  The network sees the two words on either side of a masked position: a table per position
sums into a tanh layer, and a two-level softmax (class, id within the class) gives the conditional
probability.  Its output starts from the corpus counts.

Training runs in numpy inside the tasks over all words of all documents: a sub-pass masks one position in
``MASK_EVERY`` of a document, and the rounds share out the sub-passes, so that every word is predicted once.
In a round, every task starts from the same weights and returns its own with the number of examples; Spark
averages them.  A document's score is the sum over all its words of the log-probability given both sides.

Defined cases: null, empty and wordless texts have no words, score 0.0 and no mean; texts are read whole;
repeated rows each get their score; a null doc_id is carried along; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx
from tessera.llm.common import staged

FREQUENT, RARE, SIDE = 1400, 200, 40  # SIDE classes of SIDE ids, more for more distinct words
EDGE = FREQUENT + RARE  # the id beyond a text's ends: the number of ids
HIDDEN, REACH, MASK_EVERY, ROUNDS = 16, 2, 8, 2
CELLS = 2048  # weights per row while they are averaged
CHUNK_BYTES, RANGE_WORDS = 8 << 20, 2_000_000  # text per chunk, words of the corpus per hash range


@dataclass
class Network:
    """Position tables, hidden bias, class and word output layers, in one flat vector."""

    flat: np.ndarray
    side: int = SIDE

    def __post_init__(self):
        n = self.side
        shapes = [(2 * REACH, n * n + 1, HIDDEN), (HIDDEN,), (HIDDEN, n), (n,), (n, HIDDEN, n), (n, n)]
        at, parts = 0, []
        for s in shapes:
            n = int(np.prod(s))
            parts.append(self.flat[at:at + n].reshape(s))
            at += n
        self.tables, self.bias, self.to_class, self.class_bias, self.to_word, self.word_bias = parts

    def parts(self) -> list[np.ndarray]:
        return [self.bias, self.to_class, self.class_bias, self.to_word, self.word_bias]

    @staticmethod
    def size(n: int = SIDE) -> int:
        return 2 * REACH * (n * n + 1) * HIDDEN + HIDDEN + HIDDEN * n + n + n * HIDDEN * n + n * n

    @staticmethod
    def start(counts: np.ndarray, seed: int = 11) -> Network:
        """Small random weights whose output is the unigram distribution of ``counts``."""
        side = math.isqrt(len(counts))
        net = Network(np.random.default_rng(seed).normal(0, 0.1, Network.size(side)).astype(np.float32), side)
        share = (counts + 0.5).reshape(side, side)
        net.bias[:] = 0
        net.to_word[:] *= 0.1
        net.class_bias[:] = np.log(share.sum(1) / share.sum())
        net.word_bias[:] = np.log(share / share.sum(1, keepdims=True))
        return net

    def hidden(self, around: np.ndarray) -> np.ndarray:
        z = self.tables[0][around[0]]
        for p in range(1, 2 * REACH):
            z += self.tables[p][around[p]]
        z += self.bias
        return np.tanh(z, out=z)

    def log_probs(self, around: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log p(id | both sides) of every position."""
        h = self.hidden(around)
        cls, word = np.divmod(ids, self.side)
        out = _log_softmax_at(h @ self.to_class + self.class_bias, cls, _bounded_by(self.to_class, self.class_bias))
        order, ends = _by_class(cls, self.side)
        h, word, safe = h[order], word[order], _bounded_by(self.to_word, self.word_bias)
        more = np.empty(len(ids))
        for c in np.flatnonzero(np.diff(ends)).tolist():
            lo, hi = ends[c], ends[c + 1]
            more[lo:hi] = _log_softmax_at(h[lo:hi] @ self.to_word[c] + self.word_bias[c], word[lo:hi], safe)
        out[order] += more
        return out

    def gradient(self, around: np.ndarray, ids: np.ndarray) -> tuple[float, list[tuple[np.ndarray, object, np.ndarray]]]:
        """The mean negative log-probability, and its gradient as (weights, rows of them, values): of the position
        tables only the rows that the batch reads, of the output layer only the classes in it."""
        n = len(ids)
        h = self.hidden(around)
        cls, word = np.divmod(ids, self.side)
        loss, d = _softmax_slope(h @ self.to_class + self.class_bias, cls, n, _bounded_by(self.to_class, self.class_bias))
        ones = np.ones(n, h.dtype)
        everything = slice(None)
        grads = [(self.to_class, everything, h.T @ d), (self.class_bias, everything, ones @ d)]
        back = d @ self.to_class.T
        # the classes' softmaxes side by side, in chunks of as many rows each
        row, place, of_chunk, first = _chunks(cls, self.side)
        own, layer = h[row], self.to_word[of_chunk]
        logits = (own @ layer + self.word_bias[of_chunk][:, None]).reshape(-1, self.side)
        drawn = np.zeros(len(logits), dtype=bool)
        drawn[place] = True
        more, d = _softmax_slope(logits, word[row].ravel(), n, _bounded_by(self.to_word, self.word_bias), drawn)
        loss += more
        d = d.reshape(len(of_chunk), -1, self.side)
        back += (d @ layer.transpose(0, 2, 1)).reshape(-1, HIDDEN)[place]
        grads += [(self.to_word, of_chunk[first], np.add.reduceat(own.transpose(0, 2, 1) @ d, first, axis=0)),
                  (self.word_bias, of_chunk[first], np.add.reduceat(d.sum(1), first, axis=0))]
        back *= 1 - h * h
        grads.append((self.bias, everything, ones @ back))
        # one sort for all positions: the tables stand one below the other
        rows = self.tables.shape[1]
        key = (around + np.arange(2 * REACH)[:, None] * rows).ravel()
        order = np.argsort(key.astype(np.uint16) if 2 * REACH * rows <= 1 << 16 else key, kind="stable")  # 16 bits: a radix sort
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        grads.append((self.tables.reshape(-1, HIDDEN), key[first], np.add.reduceat(back[order % n], first, axis=0)))
        return loss, grads


CHUNK_ROWS = 32


def _by_class(cls: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows ordered by class, and where each class begins."""
    small = cls.astype(np.uint16) if side <= 1 << 16 else cls  # 16 bits: a radix sort
    return np.argsort(small, kind="stable"), np.append(0, np.cumsum(np.bincount(cls, minlength=side)))


def _chunks(cls: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows dealt into chunks of ``CHUNK_ROWS`` rows of one class: (row of every place, filled up with
    the chunk's last; the place of every row; the class of every chunk, ascending; the first chunk of each class)."""
    order, ends = _by_class(cls, side)
    count, ends = np.diff(ends), ends[1:]
    chunks = -(-count // CHUNK_ROWS)
    begin = np.cumsum(chunks) - chunks
    of_chunk = np.repeat(np.arange(side), chunks)
    nth = np.arange(len(of_chunk)) - begin[of_chunk]
    at = (ends - count)[of_chunk] + nth * CHUNK_ROWS
    row = order[np.minimum(at[:, None] + np.arange(CHUNK_ROWS), (ends[of_chunk] - 1)[:, None])]
    place = np.empty(len(cls), dtype=np.int64)
    ordered = cls[order]
    place[order] = begin[ordered] * CHUNK_ROWS + np.arange(len(cls)) - (ends - count)[ordered]
    return row, place, of_chunk, np.flatnonzero(np.append(True, of_chunk[1:] != of_chunk[:-1]))[:len(of_chunk)]


SAFE = 60.0  # no logit beyond this: its exponential neither overflows nor vanishes in 32 bits


def _bounded_by(to: np.ndarray, bias: np.ndarray) -> bool:
    """Whether all logits of a layer stay within ``SAFE``, as hidden values stay within 1."""
    return bool((np.abs(to).sum(axis=-2) + np.abs(bias)).max() < SAFE)


def _log_softmax_at(logits: np.ndarray, at: np.ndarray, safe: bool) -> np.ndarray:
    if not safe:
        logits = logits - logits.max(1, keepdims=True)
    picked = logits[np.arange(len(at)), at].astype(np.float64)
    np.exp(logits, out=logits)
    return picked - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def _softmax_slope(logits: np.ndarray, at: np.ndarray, n: int, safe: bool, drawn: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Sum of -log p over ``n``, and its slope by the logits; rows that are not ``drawn`` count for nothing."""
    if not safe:
        logits -= logits.max(1, keepdims=True)
    p = np.exp(logits, out=logits)
    total = p @ np.ones(p.shape[1], p.dtype)
    rows = np.arange(len(at))
    weight = np.full(len(at), 1 / n, p.dtype) if drawn is None else (drawn / n).astype(p.dtype)
    loss = float(((np.log(total) - np.log(np.maximum(p[rows, at], 1e-30))) * weight).sum())
    p *= (weight / total)[:, None]
    p[rows, at] -= weight
    return loss, p


def windows(ids: np.ndarray, begin: np.ndarray, edge: int = EDGE) -> tuple[np.ndarray, np.ndarray]:
    """(all ids with edges between the texts, place of every id in it)."""
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    place = np.arange(len(ids)) + REACH * (doc + 1)
    padded = np.full(len(ids) + REACH * len(begin), edge, dtype=np.int64)
    padded[place] = ids
    return padded, place


def around(padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.stack([padded[place + k] for k in range(-REACH, REACH + 1) if k])


def masked(begin: np.ndarray, turn: int, rounds: int) -> Iterator[np.ndarray]:
    """The words that round ``turn`` of ``rounds`` predicts, one sub-pass after another.

    All rounds together take every word once; further rounds than ``MASK_EVERY`` begin anew.  What a round
    takes depends on a word's place in its document only, not on how Spark deals out the rows."""
    residue = (np.arange(begin[-1]) - np.repeat(begin[:-1], np.diff(begin))) * 5 % MASK_EVERY
    rounds = min(rounds, MASK_EVERY)
    for r in range(turn % rounds, MASK_EVERY, rounds):
        yield np.flatnonzero(residue == r)


def train_on(net: Network, padded: np.ndarray, place: np.ndarray, squares: Network, rate: float = 0.08, size: int = 2048) -> None:
    """Adagrad steps over the masked places; weights without a gradient stay, so only the others are touched."""
    sums = {id(w): s for w, s in zip(net.parts(), squares.parts())}
    for lo in range(0, len(place), size):
        own = place[lo:lo + size]
        for weights, rows, grad in net.gradient(around(padded, own), padded[own])[1]:
            total = sums[id(weights)] if id(weights) in sums else squares.tables.reshape(-1, HIDDEN)
            new = total[rows] + grad * grad
            total[rows] = new
            weights[rows] -= rate * grad / (np.sqrt(new) + 1e-6)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (64-bit hash), n: how often each lower-cased word occurs in all documents."""
    def count(batches):
        for whole in batches:
            for batch in tx.steps(whole, "text", 8 << 20):
                words, _ = tx.lower_words(batch.column(0).cast(pa.large_string()))
                kinds, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], names=["word", "n"])
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word long, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def id_type(ids: int) -> str:
    """How ids are stored: 16 bits each while that holds them."""
    return "<u2" if ids <= 1 << 16 else "<u4"


@dataclass
class Vocabulary:
    words: np.ndarray  # sorted hashes of the frequent words
    ids: np.ndarray  # their ids, by frequency
    counts: np.ndarray  # of every id
    within: np.ndarray  # log-probability of a word within its id if all words of the id were alike

    @property
    def id_type(self) -> str:
        return id_type(len(self.counts))

    def look_up(self, words: np.ndarray) -> np.ndarray:
        out = FREQUENT + (words >> np.uint64(40)) % np.uint64(len(self.counts) - FREQUENT)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            hit = self.words[at] == words
            out[hit] = self.ids[at[hit]]
        return out.astype(np.int64)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The frequent words (at most ``FREQUENT`` rows reach the driver) and what the rare ids hold."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT)
    rows = top.collect()
    words = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    side = max(SIDE, math.ceil(math.sqrt(FREQUENT + max(RARE, math.sqrt(counts.count())))))
    n = np.zeros(side * side)
    n[:len(rows)] = [r["n"] for r in rows]
    kinds = np.ones(side * side)
    rare = (counts.join(F.broadcast(counts.sparkSession.createDataFrame([(r["word"],) for r in rows], "word long")), "word", "left_anti")
            .groupBy(F.pmod(F.shiftrightunsigned("word", 40), F.lit(side * side - FREQUENT)).alias("id")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")))
    for r in rare.collect():  # one row per hashed id
        n[FREQUENT + r["id"]], kinds[FREQUENT + r["id"]] = r["n"], r["kinds"]
    return Vocabulary(words[order], np.arange(len(rows))[order], n, -np.log(kinds))


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [
        None, pa.py_buffer((first * values.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def encoded(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ids (``id_type`` each), the summed log-probability of the words within their ids if all were alike,
    the chunk, the places of the document's rare words (32 bits each) among the chunk's distinct ones, and
    these (64 bits each, ascending) on the chunk's first row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("ids", T.BinaryType()), T.StructField("within", T.DoubleType()),
                           T.StructField("chunk", T.LongType()), T.StructField("rare", T.BinaryType()), T.StructField("words", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        for part in (part for whole in batches for part in tx.steps(whole, "text", CHUNK_BYTES)):
            held, others = [], []
            for batch in tx.steps(part, "text"):
                words, first = tx.lower_words(batch.column(1).cast(pa.large_string()))
                ids = vocab.look_up(words)
                rare = ids >= FREQUENT
                within = np.diff(np.append(0, np.cumsum(vocab.within[ids]))[first])
                held.append((batch.column(0), ids.astype(vocab.id_type), first, within, np.append(0, np.cumsum(rare))[first]))
                others.append(words[rare])
            kinds, at = np.unique(np.concatenate(others), return_inverse=True)
            words, lo = kinds.astype("<u8").tobytes(), 0
            for names, ids, first, within, rare in held:
                places = at[lo:lo + rare[-1]].astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [names, _packed(ids, first), pa.array(within), pa.array(np.full(len(names), chunk)), _packed(places, rare),
                     pa.array([words] + [None] * (len(names) - 1), pa.binary())], names=schema.names)
                words, lo = None, lo + rare[-1]
            chunk += 1
    return narrow.mapInArrow(run, schema)


def _joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def word_shares(rows: DataFrame, counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """chunk, part, shares: for the chunk's distinct rare words of a hash range, in order, the log of the word's
    share of its id's count in the corpus over 1 / (distinct words of the id).

    A word comes once per chunk, however often the chunk has it, and a range holds about ``RANGE_WORDS``
    words of the corpus, so neither a frequent word nor a large corpus makes a large group."""
    bits = max(9, math.ceil(math.log2(max(1, vocab.counts.sum()) / RANGE_WORDS)))
    shift = 64 - bits

    def dealt(batches):
        cuts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(shift)
        for batch in batches:
            for chunk, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.frombuffer(words, dtype="<u8")
                ends = np.append(np.searchsorted(words, cuts), len(words))
                parts = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), chunk)), pa.array(parts, pa.int32()),
                                                  _packed(words, np.append(ends[parts], len(words)))], names=["chunk", "part", "words"])

    def looked_up(asked: pa.Table, table: pa.Table) -> pa.Table:
        words = table["word"].to_numpy().view(np.uint64)
        order = np.argsort(words)
        words, ids = words[order], vocab.look_up(words[order])
        shares = np.log(table["n"].to_numpy()[order]) - np.log(vocab.counts[ids]) - vocab.within[ids]
        own = _joined(asked["words"], "<u8")
        first = np.append(0, np.cumsum(pc.binary_length(asked["words"]).to_numpy())) // 8
        return pa.table([asked["chunk"], asked["part"], _packed(shares[np.searchsorted(words, own)], first)], names=["chunk", "part", "shares"])

    asked = rows.where("words IS NOT NULL").select("chunk", "words").mapInArrow(dealt, "chunk long, part int, words binary")
    table = counts.select(F.shiftrightunsigned("word", shift).cast("int").alias("part"), "word", "n")
    return asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(looked_up, "chunk long, part int, shares binary")


def with_shares(scored: DataFrame, shares: DataFrame) -> DataFrame:
    """The scores of ``score(..., also=("chunk", "rare"))`` with every word's own share of its id."""
    schema = T.StructType([f for f in scored.schema if f.name not in ("chunk", "rare")])

    def add(docs: pa.Table, parts: pa.Table) -> pa.Table:
        of_words = _joined(parts.sort_by("part")["shares"], "<f8")
        first = np.append(0, np.cumsum(pc.binary_length(docs["rare"]).to_numpy())) // 4
        more = np.diff(np.append(0, np.cumsum(of_words[_joined(docs["rare"], "<u4")]))[first])
        n, total = docs["n_tokens"].to_numpy(), docs["log_likelihood"].to_numpy() + more
        mean = np.divide(total, n, out=np.full(len(n), np.nan), where=n > 0)
        return pa.table([docs["doc_id"], docs["n_tokens"], pa.array(total), pa.array(mean, from_pandas=True)], names=schema.names)
    return scored.groupBy("chunk").cogroup(shares.groupBy("chunk")).applyInArrow(add, schema)


def _ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    own = data[offsets[0]:offsets[-1]].view(kind)
    return own.astype(np.int64), (offsets - offsets[0]) // own.itemsize


def _bounded(batch: pa.RecordBatch, column: str, size: int = 400_000):
    """The batch cut between rows into parts of about ``size`` bytes of ids."""
    lengths = np.append(0, np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(lengths, lengths[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def train(rows: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> Network:
    """Average, round by round, the networks that the tasks train on their own documents."""
    net = Network.start(counts)
    side, weights = net.side, len(net.flat)
    cells = -(-weights // CELLS)

    def local(start: np.ndarray, turn: int):
        def run(batches):
            own, squares, examples = Network(start.copy(), side), Network(np.full(weights, 1e-4, dtype=np.float32), side), 0
            for batch in batches:
                for part in _bounded(batch, "ids"):
                    ids, begin = _ids(part.column(0), id_type(side * side))
                    padded, place = windows(ids, begin, side * side)
                    for at in masked(begin, turn, rounds):
                        train_on(own, padded, place[at], squares)
                        examples += len(at)
            if examples:
                padded = np.zeros(cells * CELLS)
                padded[:weights] = own.flat
                values = (padded * examples).reshape(cells, CELLS)
                from pyspark import TaskContext
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(cells), pa.int32()), pa.array(np.full(cells, TaskContext.get().partitionId() % 64), pa.int32()),
                     pa.array(np.full(cells, examples), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(cells + 1) * CELLS, pa.int32()), pa.array(values.ravel()))],
                    names=["cell", "salt", "examples", "weights"])
        return run

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "salt": pdf["salt"].iloc[:1], "examples": [pdf["examples"].sum()],
                             "weights": [np.sum(np.vstack(pdf["weights"]), axis=0)]})

    schema = "cell int, salt int, examples long, weights array<double>"
    for turn in range(rounds):
        parts = rows.select("ids").mapInArrow(local(net.flat, turn), schema)
        # two levels, so that no task adds up the weights of all tasks
        some = parts.groupBy("cell", "salt").applyInPandas(added, schema)
        total = some.withColumn("salt", F.lit(0)).groupBy("cell", "salt").applyInPandas(added, schema).collect()  # one network
        if not total:
            break
        flat = np.zeros(cells * CELLS, dtype=np.float32)
        for r in total:
            flat[r["cell"] * CELLS:(r["cell"] + 1) * CELLS] = np.asarray(r["weights"]) / r["examples"]
        net = Network(flat[:weights].copy(), side)
    return net


def score(rows: DataFrame, net: Network, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_prob of encoded documents and the columns ``also`` of them;
    within an id all words are alike."""
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()),
                           T.StructField("mean_log_prob", T.DoubleType()), *[rows.schema[c] for c in also]])
    flat, side = net.flat, net.side

    def run(batches):
        own = Network(flat, side)
        for batch in batches:
            for part in _bounded(batch, "ids"):
                ids, begin = _ids(part.column(1), id_type(side * side))
                padded, place = windows(ids, begin, side * side)
                logs = np.concatenate([np.zeros(1), *[own.log_probs(around(padded, place[lo:lo + 32768]), ids[lo:lo + 32768])
                                                      for lo in range(0, len(ids), 32768)]])
                total = np.diff(np.cumsum(logs)[begin]) + part.column(2).to_numpy()
                n = np.diff(begin)
                mean = np.divide(total, n, out=np.full(len(n), np.nan), where=n > 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(total), pa.array(mean, from_pandas=True),
                                                  *[part.column(c) for c in also]], names=schema.names)
    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on all documents and score each of them."""
    counts = staged(word_counts(docs, text_col), "word-counts")
    vocab = vocabulary(counts)
    rows = staged(encoded(docs, vocab, id_col, text_col), "encoded")
    scored = score(rows, train(rows, vocab.counts, rounds), ("chunk", "rare"))
    return with_shares(scored, word_shares(rows, counts, vocab))
