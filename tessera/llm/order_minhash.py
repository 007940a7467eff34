"""Near-duplicate documents by order MinHash and banded alignment.

A document is the sequence of its five-word shingles (lower-cased words).  Every shingle is labelled
with its occurrence number, so repeats count; each of ``sketches`` random orders picks the ``minima``
smallest labelled shingles and keeps them in text order, which makes a sketch agree with a probability
that follows the edit similarity.  Documents with the same words collapse first.  Two documents are
candidates if a sketch agrees, their lengths allow the threshold, and ``BITS`` one-bit MinHash values put
the overlap of their shingles at ``LEAST_OVERLAP`` or more (an edit similarity of 0.8 means an overlap of
two thirds or more, over 4 standard errors above, so about one such pair in 100,000 is lost here); a candidate links if the edit similarity of the shingle sequences, 1 - distance / longer length, computed by an alignment
inside the band that the threshold leaves, is ``threshold`` or more.

Pairs are not listed per bucket.  Every member of a bucket meets the bucket's smallest member and, while
they are apart, ``TURNS`` more drawn by a hash; the links give components.  Members that did not join their
bucket's smallest member may still be like others of it outside their own component.  They meet these over
a rare shingle: two texts that can link share at least four fifths of the longer one's labelled shingles,
so in any one order of the shingles the first fifth plus one of each have one in common.  The order puts
shingles that the bucket's smallest member lacks first, the rarest among the bucket's members leading, and
is exact for both sides; members that share no more than the bucket's common text never meet, and
no link is lost.  The smallest member is found by a map-side combined aggregate and joined back, so a hot
bucket is split by the skew-join rule.  Shingles move once, one row per different text, into a table
bucketed by document, from which all rounds of alignments read without another shuffle.

Defined cases: a null text is empty; texts without words are equal only if their bytes are; texts of one
to four words are a single shingle; rows with the same words (repeated rows too) share a class; the
class id is the smallest doc_id of the class, null if all are null; exactly one row of a class is kept,
one with that id; an empty table gives an empty result; other columns are not read (by the filter:
returned unchanged).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import batch_bytes, connected_components, new_folder, staged

WORDS = 5
SKETCHES, MINIMA = 24, 4
THRESHOLD = 0.8
_RNG = np.random.default_rng(7)
_SEED = _RNG.integers(0, 2 ** 63, SKETCHES, dtype=np.uint64)[:, None]
_ODD = _RNG.integers(0, 2 ** 63, SKETCHES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
BITS, LEAST_OVERLAP = 512, 0.53
TURNS = 1
_BIT_SEED = _RNG.integers(0, 2 ** 63, BITS, dtype=np.uint64)[:, None]
_BIT_ODD = _RNG.integers(0, 2 ** 63, BITS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def _fold(hashes: np.ndarray) -> np.ndarray:
    """Order-dependent hash of the rows of a matrix."""
    out = np.full(len(hashes), hashes.shape[1], dtype=np.uint64)
    for j in range(hashes.shape[1]):
        out = tx.mix(out * _STEP + hashes[:, j])
    return out


def shingles(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first shingle per text + total)."""
    n = np.diff(first)
    many = np.maximum(n - WORDS + 1, 0)
    starts = tx.gather(np.arange(len(words)), first[:-1], many)
    long = _fold(words[starts[:, None] + np.arange(WORDS)]) if len(starts) else np.zeros(0, np.uint64)
    count = np.where(n >= WORDS, many, (n > 0).astype(np.int64))
    out = np.zeros(int(count.sum()), dtype=np.uint64)
    begin = np.append(0, np.cumsum(count))
    is_long = np.repeat(n >= WORDS, count)
    out[is_long] = long
    for d in np.flatnonzero((n > 0) & (n < WORDS)):
        out[begin[d]] = _fold(words[None, first[d]:first[d + 1]])[0]
    return out, begin


def labelled(kmers: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Shingles mixed with their occurrence number in the text."""
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((kmers, doc))
    k, d = kmers[order], doc[order]
    new = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]))[:len(k)]
    start = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    nth = np.empty(len(k), dtype=np.uint64)
    nth[order] = (np.arange(len(k)) - start).astype(np.uint64)
    return np.where(nth == 0, kmers, tx.mix(kmers + nth * _STEP))


def sketch(own: np.ndarray) -> np.ndarray:
    """The order MinHash sketches of one text's labelled shingles."""
    if len(own) > MINIMA:
        at = np.sort(np.argpartition((own[None, :] ^ _SEED) * _ODD, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
        picked = own[at]
    else:
        picked = np.broadcast_to(own, (SKETCHES, len(own)))
    return _fold(np.column_stack([np.arange(SKETCHES, dtype=np.uint64), picked]))


def overlap_bits(own: np.ndarray) -> np.ndarray:
    """One bit of each of ``BITS`` MinHash values, as 64-bit words."""
    least = np.concatenate([((own[None, :] ^ _BIT_SEED[k:k + 32]) * _BIT_ODD[k:k + 32]).min(axis=1) for k in range(0, BITS, 32)])
    return np.packbits((tx.mix(least) & np.uint64(1)).astype(bool)).view(np.uint64)


def _whole_distance(a: list[int], b: list[int]) -> int:
    """Edit distance by bit vectors over the whole of ``a`` (Myers 1999, Hyyrö 2003)."""
    where: dict[int, int] = {}
    for j, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << j)
    mask, last, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = mask, 0
    for x in b:
        match = where.get(x, 0)
        diag = ((((match & up) + up) ^ up) | match | down) & mask
        plus = down | (mask & ~(diag | up))
        minus = diag & up
        score += 1 if plus & last else -1 if minus & last else 0
        plus, minus = (plus << 1 | 1) & mask, (minus << 1) & mask
        up, down = minus | (mask & ~(diag | plus)), diag & plus
    return score


def edit_distance_within(a: list[int], b: list[int], limit: int) -> int | None:
    """Edit distance of two sequences if it is at most ``limit``, else None.

    Equal ends are cut off; the rest is aligned by bit vectors that hold only the 2 * limit + 1
    diagonals on which a distance up to ``limit`` can run."""
    if abs(len(a) - len(b)) > limit:
        return None
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(a) - lo and hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    if not a or not b:
        return max(len(a), len(b))
    if len(a) <= limit:
        score = _whole_distance(a, b)
        return score if score <= limit else None
    where: dict[int, int] = {}
    for j, x in enumerate(a):  # in row i the vectors' bit t is the place i + t - limit of a
        where[x] = where.get(x, 0) | (1 << (j + limit))
    width = 2 * limit + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)
    up, down, score = mask & ~((1 << limit) - 1), 0, limit
    slack = limit + len(b)  # the score may still fall by one per row once a has ended
    last = top
    for i, x in enumerate(b):
        match = (where.get(x, 0) >> i) & mask
        diag = ((((match & up) + up) ^ up) | match | down) & mask
        plus = down | (mask & ~(diag | up))
        minus = diag & up
        if i < len(a) - limit:
            score += not diag & top
        else:  # a has ended: its last place moves down one diagonal per row
            last >>= 1
            score += 1 if plus & last else -1 if minus & last else 0
        if score > slack - max(i + 1, len(a) - limit):
            return None
        half = diag >> 1
        up, down = minus | (mask & ~(half | plus)), half & plus
    return score if score <= limit else None


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the edit similarity of two shingle sequences is at least ``threshold``."""
    longer = max(len(a), len(b))
    limit = int(np.floor((1 - threshold) * longer + 1e-9))
    # every shingle of the longer text without a partner costs one edit
    kinds, n = np.unique(np.concatenate([a, b]), return_counts=True)
    x, y = np.sort(a), np.sort(b)
    common = np.minimum(np.searchsorted(x, kinds, "right") - np.searchsorted(x, kinds),
                        np.searchsorted(y, kinds, "right") - np.searchsorted(y, kinds)).sum()
    return longer - common <= limit and edit_distance_within(a.tolist(), b.tolist(), limit) is not None


def _node(words: np.ndarray, first: np.ndarray, raw: pa.Array) -> np.ndarray:
    """A 64-bit name of every text's words, or of its bytes if it has none."""
    data, offsets = tx.utf8(raw)
    weight, _ = tx._powers(int(np.diff(first).max(initial=0)) + 1)
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    total = np.append(np.uint64(0), np.cumsum(tx.mix(words) * weight[place], dtype=np.uint64))
    name = tx.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64) * _STEP)
    for d in np.flatnonzero(np.diff(first) == 0):
        end = np.array([offsets[d + 1] - offsets[d]])
        own = data[offsets[d]:offsets[d + 1]]
        name[d] = tx.hash_runs(own, np.zeros(1, np.int64), end)[0] ^ _STEP if len(own) else _STEP
    return name


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node (name of the words), n (shingles), sketch, bits, shingles (32 bits each) of every text."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        tx.release()  # what earlier stages left in this worker
        for whole in batches:
            for batch in tx.steps(whole, "text"):
                words, first = tx.lower_words(batch.column(1).cast(pa.large_string()))
                kmers, begin = shingles(words, first)
                own = labelled(kmers, begin)
                marks = np.zeros((batch.num_rows, SKETCHES), dtype=np.uint64)
                bits = np.zeros((batch.num_rows, BITS // 64), dtype=np.uint64)
                n = np.diff(begin)
                for d in np.flatnonzero(n):
                    marks[d] = sketch(own[begin[d]:begin[d + 1]])
                    bits[d] = overlap_bits(own[begin[d]:begin[d + 1]])
                name = _node(words, first, batch.column(1))
                packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [
                    None, pa.py_buffer((begin * 4).astype(np.int64)), pa.py_buffer((kmers >> np.uint64(32)).astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(name.view(np.int64)), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * SKETCHES),
                                              pa.array(marks.view(np.int64).ravel())),
                     *[pa.array(bits[:, k].view(np.int64)) for k in range(BITS // 64)],
                     packed.cast(pa.binary())], names=["doc_id", "node", "n", "sketch", *WORDS_OF_BITS, "shingles"])
            tx.release()
    words = ", ".join(f"{c} long" for c in WORDS_OF_BITS)
    return narrow.mapInArrow(run, f"doc_id long, node long, n long, sketch array<long>, {words}, shingles binary")


WORDS_OF_BITS = [f"bits{k}" for k in range(BITS // 64)]


def _side(mark: str) -> list:
    """What a candidate test needs of one side, under names that end in ``mark``."""
    return [F.col(c).alias(f"{c}_{mark}") for c in ("n", *WORDS_OF_BITS)]


def _alike(threshold: float) -> F.Column:
    """Whether lengths and overlap of the sides ``a`` and ``b`` allow a link."""
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in WORDS_OF_BITS), F.lit(0))
    return ((F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9)
            & (differ <= F.lit(int(BITS * (1 - LEAST_OVERLAP) / 2))))


def bucketed(rows: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``rows``, grouped by ``key``, as a table bucketed by it in the shared folder, and the table's name."""
    spark = rows.sparkSession
    name = f"tessera_{uuid.uuid4().hex}"
    (rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
     .option("path", new_folder(spark, "bucketed")).saveAsTable(name))
    return spark.table(name), name


ALIGN_BYTES = 4 << 20  # texts, or shingles of pairs, in one batch


def _with_shingles(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """Pairs (a, b and other columns) with the shingles x of a and y of b."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    own = staged(shingled.join(wanted, "node", "left_semi"), "shingles")
    return (pairs.join(own.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(own.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))


def _packed_pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    x, y = batch.column("x"), batch.column("y")
    for i in range(batch.num_rows):
        yield np.frombuffer(x[i].as_buffer(), "<u4"), np.frombuffer(y[i].as_buffer(), "<u4")


def _verified(pairs: DataFrame, shingled: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the alignment links."""
    both = _with_shingles(pairs.select("a", "b"), shingled).select("a", "b", "x", "y")

    def check(batches):
        for batch in batches:
            hit = [similar(x, y, threshold) for x, y in _packed_pairs(batch)]
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
        tx.release()
    with batch_bytes(pairs.sparkSession, ALIGN_BYTES):
        return staged(both.mapInArrow(check, "a long, b long"), "links")


def _occurrences(x: np.ndarray) -> np.ndarray:
    """Shingles (32 bits) below the number of their occurrence in the text: distinct 64-bit tokens."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    new = np.append(True, s[1:] != s[:-1])[:len(s)]
    nth = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    return (nth << 32) | s.astype(np.int64)


def _prefix_size(n, threshold: float):
    """The first tokens of a text of ``n`` in which it must meet any text that it can link with: one more than
    the edits that a link allows it."""
    return np.floor((1 - threshold) * n + 1e-9).astype(np.int64) + 1


PARITIES = 1024
PARITY_WORDS = [f"odd{k}" for k in range(PARITIES // 64)]


def parities(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of the distinct ``tokens`` falls into each of ``PARITIES`` bins, as 64-bit words.

    Common tokens of two texts cancel out, so the words differ in at most as many bits as there are tokens
    that only one of the two has."""
    bins = tx.mix(tokens.astype(np.uint64)) % np.uint64(PARITIES)
    return np.packbits((np.bincount(bins.astype(np.int64), minlength=PARITIES) & 1).astype(bool)).view(np.int64)


def _may_link(threshold: float) -> F.Column:
    """Whether the sides ``a`` and ``b`` can share all tokens but the edits that a link allows the longer one;
    exact, as the parities never count more than what they differ in."""
    longer = F.greatest("n_a", "n_b")
    limit = F.floor(F.lit(1 - threshold) * longer + F.lit(1e-9))
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in PARITY_WORDS), F.lit(0))
    return (longer - F.least("n_a", "n_b") <= limit) & (differ <= F.col("n_a") + F.col("n_b") - 2 * (longer - limit))


def rare_meetings(members: DataFrame, shingled: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of members of one lead's buckets that share a token among their first ones and as many
    tokens as a link needs, by their parities; ``members`` has lead, node, part (component) and apart (not in
    the lead's)."""
    both = _with_shingles(members.select(F.col("node").alias("a"), F.col("lead").alias("b"), "part", "apart"), shingled)

    def own_tokens(batches):
        for batch in batches:
            tokens, common, size, long, odd = [], [], [], [], []
            for x, y in _packed_pairs(batch):
                mine, lead = _occurrences(x), _occurrences(y)
                own = mine[~np.isin(mine, lead, assume_unique=True)]
                k = int(_prefix_size(len(mine), threshold))
                short = max(0, k - len(own))
                if short:  # the rest of its first tokens stands in the lead, in the order of a hash
                    rest = np.setdiff1d(mine, own, assume_unique=True)
                    rest = rest[np.argsort(tx.mix(rest.astype(np.uint64)), kind="stable")[:short]]
                else:
                    rest = own[:0]
                tokens.append(own), common.append(rest), size.append(k), long.append(len(mine)), odd.append(parities(mine))
            words = np.array(odd, dtype=np.int64).reshape(-1, len(PARITY_WORDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), batch.column("a"), batch.column("part"), batch.column("apart"), pa.array(size, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(common, pa.list_(pa.int64())), pa.array(long, pa.int64()),
                 *[pa.array(words[:, k].copy()) for k in range(len(PARITY_WORDS))]],
                names=["lead", "node", "part", "apart", "size", "own", "common", "n", *PARITY_WORDS])
        tx.release()
    schema = ("lead long, node long, part long, apart boolean, size long, own array<long>, common array<long>, n long, "
              + ", ".join(f"{c} long" for c in PARITY_WORDS))
    with batch_bytes(members.sparkSession, ALIGN_BYTES):
        rows = staged(both.select("a", "b", "part", "apart", "x", "y").mapInArrow(own_tokens, schema), "own-tokens")
    narrow = ["lead", "node", "part", "apart"]
    each = rows.select(*narrow, "size", F.explode("own").alias("token"))
    often = each.groupBy("lead", "token").agg(F.count("*").alias("n"))
    # a token of one member only brings nobody together, but it fills its place among the first ones
    placed = (each.join(often, ["lead", "token"])
              .select(*narrow, "size", "token", "n", F.row_number().over(Window.partitionBy("lead", "node").orderBy("n", F.xxhash64("token"), "token")).alias("nth"))
              .where("nth <= size AND n > 1").select(*narrow, "token"))
    # tokens of the lead matter only where a member that is apart has some among its first ones
    short = rows.where("apart AND size(common) > 0").select("lead").distinct()
    placed = placed.unionByName(rows.join(short, "lead", "left_semi").select(*narrow, F.explode("common").alias("token")))
    placed = staged(placed, "first-tokens")
    met = placed.groupBy("lead", "token").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max("apart").alias("some"))
    placed = placed.join(met.where("lo < hi AND some").select("lead", "token"), ["lead", "token"], "left_semi")
    # a pair is weighed where it meets: one that cannot link never becomes a row
    placed = placed.join(rows.select("lead", "node", "n", *PARITY_WORDS), ["lead", "node"])

    def side(mark: str) -> list:
        return [F.col(c).alias(f"{c}_{mark}") for c in ("part", "apart", "n", *PARITY_WORDS)]
    one = placed.where("apart").select("lead", "token", F.col("node").alias("a"), *side("a"))
    two = placed.select("lead", "token", F.col("node").alias("b"), *side("b"))
    hit = (F.col("part_a") != F.col("part_b")) & (~F.col("apart_b") | (F.col("a") < F.col("b"))) & _may_link(threshold)
    return one.join(two, ["lead", "token"]).where(hit).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node and class_node of every row: rows of one class are near copies of each other."""
    spark = docs.sparkSession
    with batch_bytes(spark, ALIGN_BYTES):
        rows = staged(signed(docs, id_col, text_col), "signed")
    # one row per different text; copies go before their shingles move, so a group of them sends a row per task
    texts, name = bucketed(rows.where("n > 0").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "sketch", *WORDS_OF_BITS, "shingles")]), "node")
    try:
        nodes = texts.drop("shingles")
        keyed = nodes.select("node", F.explode("sketch").alias("key"))
        lead = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("lead")).where("size > 1").drop("size")
        links = _links(nodes, staged(keyed.join(lead, "key"), "buckets"), texts.select("node", "shingles"), threshold)
    finally:
        spark.sql(f"DROP TABLE {name}")
    parts = connected_components(links).withColumnRenamed("id", "node")
    return (rows.select("doc_id", "node").join(parts, "node", "left")
            .select("doc_id", "node", F.coalesce("component", "node").alias("class_node")))


def _links(nodes: DataFrame, buckets: DataFrame, once: DataFrame, threshold: float) -> DataFrame:
    """The verified pairs of ``buckets`` (key, node, lead), enough of them to join every class."""
    def alike(pairs: DataFrame, name: str) -> DataFrame:
        return staged(pairs.join(nodes.select(F.col("node").alias("a"), *_side("a")), "a")
                      .join(nodes.select(F.col("node").alias("b"), *_side("b")), "b").where(_alike(threshold)).select("a", "b"), name)

    stars = alike(buckets.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), "stars")
    links = _verified(stars, once, threshold)
    for turn in range(TURNS):  # members that are still apart meet another member, drawn by a hash
        parts = staged(connected_components(links).withColumnRenamed("id", "node"), "parts")
        placed = staged(buckets.select("key", "node").join(parts, "node", "left")
                        .select("key", "node", F.coalesce("component", "node").alias("part")), "placed")
        drawn = placed.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)).alias("draw"), "node", "part")).alias("d"))
        apart = placed.join(drawn.select("key", F.col("d.node").alias("other"), F.col("d.part").alias("other_part")), "key")
        apart = apart.where("part <> other_part").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
        links = staged(links.unionByName(_verified(alike(apart.distinct(), "drawn"), once, threshold)), "links")
    parts = staged(connected_components(links).withColumnRenamed("id", "node"), "parts")

    # members that did not join their bucket's smallest member meet the rest of its buckets over a rare shingle
    named = (buckets.select("lead", "node").where("node <> lead").distinct().join(parts, "node", "left")
             .withColumn("part", F.coalesce("component", "node")).drop("component")
             .join(parts.select(F.col("node").alias("lead"), F.col("component").alias("lead_part")), "lead", "left")
             .withColumn("apart", F.col("part") != F.coalesce("lead_part", "lead")))
    named = staged(named.select("lead", "node", "part", "apart"), "named")
    # somebody to meet outside one's own component, and not the lead's alone
    mixed = named.groupBy("lead").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max("apart").alias("some")).where("some AND lo < hi")
    rest = rare_meetings(named.join(mixed.select("lead"), "lead", "left_semi"), once, threshold)
    return staged(links.unionByName(_verified(alike(rest, "rest"), once, threshold)), "links")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, kept, node."""
    rows = staged(classes(docs, id_col, text_col, threshold), "classes")
    best = rows.groupBy("class_node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    all_rows = rows.join(best, "class_node")
    at_top = F.col("doc_id").eqNullSafe(F.col("class_id"))
    nth = F.row_number().over(Window.partitionBy("class_node").orderBy("doc_id", "node"))
    out = all_rows.where(~at_top).withColumn("kept", F.lit(False)).unionByName(all_rows.where(at_top).withColumn("kept", nth == 1))
    return out.select("doc_id", "class_id", "class_size", "kept", "node")


def node_column(text: F.Column) -> F.Column:
    """The name of a text's words that :func:`near_copies` returns as ``node``."""
    @F.arrow_udf("long")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = [pa.array([], pa.int64())]
            for b in tx.steps(pa.RecordBatch.from_arrays([part], names=["text"]), "text"):
                words, first = tx.lower_words(b.column(0).cast(pa.large_string()))
                out.append(pa.array(_node(words, first, b.column(0)).view(np.int64)))
            yield pa.concat_arrays(out)
    return run(text.cast("string"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`near_copies` keeps: one row per class.

    The kept rows are found again by doc_id and words; only where several rows share both does a window
    choose one of them."""
    found = staged(near_copies(docs, id_col, text_col, threshold), "near-copies")
    copies = found.groupBy("doc_id", "node").agg(F.count("*").alias("copies"), F.max("kept").alias("kept"))
    kept = copies.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"), "copies")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("key"),
                        node_column(F.col(text_col)).alias("node"))
    met = whole.join(kept, F.col("key").eqNullSafe(F.col("kept_id")) & (F.col("node") == F.col("kept_node")))
    met = staged(met.select("row", "copies", "key", "node"), "kept-rows")
    nth = F.row_number().over(Window.partitionBy("key", "node").orderBy("key"))
    several = met.where("copies > 1").withColumn("nth", nth).where("nth = 1")
    return met.where("copies = 1").select("row").unionByName(several.select("row")).select("row.*")
