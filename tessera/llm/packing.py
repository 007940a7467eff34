"""Packing documents into sequences: shortest-pack-first over the length histogram.

Documents are tokenized where they are read and cut every ``seq_len`` tokens, so only narrow rows
(document, start, length, checksum) move afterwards.  The histogram of piece lengths has at most
``seq_len`` rows and is packed on the driver: lengths go longest first into the emptiest open pattern
that takes them, and only the counts of patterns are updated, so the work depends on ``seq_len`` and
not on the rows.  Patterns meet the pieces again by rank: the n-th piece of a length takes the n-th
place that the patterns offer to that length.  Ranks come from counts per (length, hash block) and a
position inside the block; the number of blocks grows with the rows, so a very common length is
spread over many tasks.

Defined cases: a null or empty text has just the end token; a text of any length is used whole;
repeated rows and repeated or null ids are packed like other rows; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx
from tessera.llm.common import batch_bytes, staged

SEQ_LEN = 2048
END_ID = 1
TEXT_BYTES = 4 << 20  # texts in one Arrow batch


def word_encoder(path: str):
    """A function from word pieces to id lists, equal to the tokenizer at ``path`` on each piece.

    A piece that is one lower-case word in normal form C passes the normaliser and the word splitter
    unchanged, so such words go straight to the byte-pair model, a thousand to a call; the model ends
    every word with a token that carries the word-end suffix, which tells them apart again.  Any other
    piece takes the whole tokenizer."""
    import unicodedata

    from tokenizers import Tokenizer, pre_tokenizers
    whole = Tokenizer.from_file(path)
    suffix = whole.model.end_of_word_suffix
    words = Tokenizer(whole.model)  # the same model in memory, without a normaliser
    words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(),
                                                   pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocab = whole.get_vocab(with_added_tokens=False)
    last = np.zeros(max(vocab.values()) + 1, dtype=bool)
    last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
    del vocab

    def encode(pieces: list[str]) -> list[list[int]]:
        plain = [p.isalpha() and (p.isascii() and p.islower() or p == p.lower() and unicodedata.is_normalized("NFC", p))
                 for p in pieces]
        easy = [p for p, ok in zip(pieces, plain) if ok]
        rest = iter([e.ids for e in whole.encode_batch_fast([p for p, ok in zip(pieces, plain) if not ok],
                                                            add_special_tokens=False)])
        joined = [" ".join(easy[i:i + 1000]) for i in range(0, len(easy), 1000)]
        ids = np.fromiter((t for e in words.encode_batch_fast(joined, add_special_tokens=False) for t in e.ids), dtype=np.int64)
        ends = np.append(0, np.flatnonzero(last[ids]) + 1) if len(ids) else np.zeros(1, np.int64)
        if len(ends) != len(easy) + 1:
            raise ValueError("the tokenizer's words do not end with its word-end suffix")
        flat, ends = ids.tolist(), ends.tolist()
        own = iter([flat[a:b] for a, b in zip(ends, ends[1:])])
        return [next(own) if ok else next(rest) for ok in plain]

    return whole, encode


def word_cache(path: str):
    """(tokenizer, cache of its pieces) for ``path``, kept in the worker until another operator's tasks run there."""
    if path not in tx.HELD:
        whole, encode = word_encoder(path)
        tx.HELD[path] = whole, tx.PieceCache(encode, limit=150_000)
    return tx.HELD[path]


_LETTER = tx.byte_table(bytes(range(65, 91)) + bytes(range(97, 123)))
_OTHER = tx.byte_table(bytes(x for x in range(128) if not chr(x).isalpha() and chr(x) not in "'"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def token_ids(column: pa.Array, tokenizer, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end_id``, and the place where each text begins (+ total).

    The tokenizer lower-cases, drops white space and never joins characters across it, nor a letter
    and another ASCII character (but for the apostrophe); so the texts are cut there and every
    distinct piece is encoded once.  Texts that spell out a special token are encoded whole."""
    whole, cache = tokenizer
    data, offsets = tx.utf8(column)
    if b"<|" in data.tobytes():
        listed = [e.ids + [end_id] for e in whole.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)]
        return (np.fromiter((t for x in listed for t in x), dtype="<u4"),
                np.append(0, np.cumsum([len(x) for x in listed])))
    blank, letter, other = tx.ASCII_SPACE[data], _LETTER[data], _OTHER[data]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = blank[:-1] | (letter[1:] & other[:-1]) | (other[1:] & letter[:-1])
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    shown = ~blank
    # a text's first shown byte begins a piece: what stands before it is white space or another text
    at = np.flatnonzero(cut & shown)
    kept = np.cumsum(shown) - 1
    pieces = tx.pieces_between(_LOWER[data[shown]], kept[at]) if len(at) else pa.array([], pa.large_string())
    ids, length = cache(pieces)
    ends = np.append(0, np.cumsum(length))[np.searchsorted(at, offsets)]
    ids = np.insert(ids, ends[1:], end_id).astype("<u4", copy=False)
    return ids, ends + np.arange(len(offsets))


def tokenized_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``seq_len`` tokens: doc_id, start, length, doc_tokens, ids_crc32
    and, if asked for, the ids."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = [T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches):
        tx.release(tokenizer)  # what earlier stages left in this worker
        words = word_cache(tokenizer)
        for whole in batches:
            for batch in tx.steps(whole, "text"):
                ids, begin = token_ids(batch.column(1), words, end_id)
                tokens = np.diff(begin)
                n = -(-tokens // seq_len)
                row = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * seq_len
                length = np.minimum(tokens[row] - start, seq_len)
                lo = begin[row] + start
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist())]
                cols = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(tokens[row]),
                        pa.array(crc, type=pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(ids)), type=pa.int32()),
                                                         pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])
            tx.release(tokenizer)

    return narrow.mapInArrow(cut, T.StructType(fields))


def pack_histogram(counts: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first: [(lengths of one pattern, how many sequences have it)].

    Longest lengths first; a length goes to the open pattern with the most room, one piece per
    sequence of that pattern, splitting the pattern's count when fewer pieces are left.  Without a
    pattern that has room, new sequences take as many pieces of the length as fit."""
    rooms: list[int] = []  # sorted, one entry per room that has open patterns
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        room = seq_len - sum(pattern)
        if n and room == 0:
            done.append((pattern, n))
        elif n:
            if room not in open_at:
                insort(rooms, room)
                open_at[room] = []
            open_at[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if rooms and rooms[-1] >= length:
                room = rooms[-1]
                pattern, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
                    rooms.pop()
                used = min(n, left)
                put(pattern, n - used)
                put((*pattern, length), used)
                left -= used
            else:
                each = seq_len // length
                put((length,) * each, left // each)
                put((length,) * (left % each), int(left % each > 0))
                left = 0
    return done + [x for room in rooms for x in open_at[room]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) of every run of places."""
    out, taken, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            out.append((length, rank, rank + n - 1, sequence, offset))
            taken[length] = rank + n
            offset += length
        sequence += n
    return out


def ranked(pieces: DataFrame, keys: list[str], rows_per_block: int = 100_000) -> DataFrame:
    """``pieces`` with a gapless ``rank`` from 0 within each ``length``, without one task per length."""
    blocks = max(256, pieces.count() // rows_per_block)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "block").orderBy(*keys)) - 1
    return (dealt.withColumn("nth", nth).join(starts, ["length", "block"])
            .withColumn("rank", F.col("base") + F.col("nth")).drop("block", "nth", "base"))


def pack(pieces: DataFrame, seq_len: int = SEQ_LEN, keys: tuple[str, ...] = ("doc_id", "start", "ids_crc32")) -> DataFrame:
    """``pieces`` (a staged table with a ``length`` of 1 to ``seq_len``) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = places(pack_histogram(counts, seq_len))
    schema = "p_length long, p_first long, p_last long, p_sequence long, p_offset long"
    # every packing step uses up a length or a pattern, so the runs are bounded by seq_len alone
    table = F.broadcast(spark.createDataFrame(runs, schema))
    hit = (F.col("length") == F.col("p_length")) & F.col("rank").between(F.col("p_first"), F.col("p_last"))
    return (ranked(pieces, list(keys)).join(table, hit)
            .withColumn("sequence_id", F.col("p_sequence") + F.col("rank") - F.col("p_first"))
            .withColumn("offset", F.col("p_offset"))
            .drop("rank", "p_length", "p_first", "p_last", "p_sequence", "p_offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset (and ids)."""
    with batch_bytes(docs.sparkSession, TEXT_BYTES):
        pieces = staged(tokenized_pieces(docs, tokenizer, id_col, text_col, seq_len, end_id, with_ids), "pieces")
    return pack(pieces, seq_len)


def sequences(packed: DataFrame, seq_len: int = SEQ_LEN, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens and the ids of each sequence, padded to ``seq_len`` unless their number is
    a power of two.  A group has at most ``seq_len`` tokens."""
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
    n = F.size("ids")
    padded = F.when(n.bitwiseAND(n - 1) == 0, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(seq_len) - n)))
    return packed.groupBy("sequence_id").agg(whole.alias("ids")).select("sequence_id", n.alias("n_tokens"), padded.alias("ids"))
