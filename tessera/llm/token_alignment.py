"""Cross-tokenizer alignment: merge-path partitioning of the token ends of two tokenizers.

Every text, with a space before it, is encoded by a byte-level tokenizer A and a SentencePiece model B.
Both cut the same bytes, so the ends of their tokens are two sorted lists up to the same last end.
Merging them, A before B where they are equal, is a path through a grid; a binary search on every
``work``-th diagonal of it finds the path there without walking it, so that a document's merge falls apart
into pieces of equal work, which know nothing of each other but the tokens that reach over their
borders.  Each piece is a row for Spark: its ids of A and B (one more than it consumes, where one reaches
beyond), packed, and the offsets where its first tokens begin.

A piece emits an overlap for every different end (the A and the B token that cover the bytes before it)
and closes a group wherever both lists end.  Groups open at a border are stitched document by document.
Overlaps of an id pair are summed per chunk of about ``CHUNK_BYTES`` of text and then over the corpus; a
chunk gets back the corpus counts of its own pairs only, so no task holds all pairs, and a pair that stands
in every text comes once per chunk.

Neither tokenizer joins anything across a space that follows a character other than white space, so texts
are cut there, every distinct word is encoded once while a bounded cache lasts, and texts longer than
``SEGMENT`` characters are handled in segments.  (That holds for a byte-level A with the usual splitter and is
checked on B's vocabulary; other models take whole texts.)

Defined cases: texts that are null or empty, or whose joined tokens differ from the text's bytes under A or B
(a written-out marker of B, say), have no tokens: zeros, and '' for the groups; strings of special tokens are
plain text; repeated rows count again; repeated or null ids give a row each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx
from tessera.llm.common import staged
from tessera.llm.sentencepieces import MARK, Model

WORK = 1 << 16              # merged ends of a piece
SEGMENT = 1 << 18           # characters of a text encoded at once
CHUNK_BYTES = 16 << 20      # text of a chunk
LINKS_AT_ONCE = 1 << 19
ID_BITS = 16
CACHED_WORDS = 200_000      # distinct words whose ids a worker keeps
JOINED = 500                # new words encoded by one call
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable characters of Latin-1 stand for themselves, the others for the
    characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """The bytes of every id of one tokenizer."""

    def __init__(self, parts: list[bytes]):
        if len(parts) > 1 << ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        self.flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.at = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray) -> np.ndarray:
        return tx.gather(self.flat, self.at[ids], self.size[ids])


class Pair:
    """Both tokenizers in one worker process."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            read = json.load(f)
        chars, parts = byte_of_character(), {}
        for token, i in read["model"]["vocab"].items():
            parts[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        for t in read.get("added_tokens", []):
            parts.setdefault(t["id"], t["content"].encode())
        self.a_side = Side([parts.get(i, b"") for i in range(max(parts) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(b_path, "rb") as f:
            model = Model.parse(f.read())
        self.b_side = Side(model.bytes_of())
        before = read.get("pre_tokenizer") or {}
        self.separable = (model.separable() and model.dummy_prefix and before.get("type") == "ByteLevel"
                          and bool(before.get("use_regex")) and not read.get("normalizer"))
        self.words = _Words(self)

    def segments(self, text: str, size: int) -> list[str]:
        """A space and the text, cut so that every part begins with a space."""
        led = " " + text
        if len(led) <= size or not self.separable:
            return [led]  # any other pair of models takes whole texts
        cuts, at = [0], size
        while at < len(led):
            m = _SAFE.search(led, at)
            if m is None:
                break
            cuts.append(m.start())
            at = m.start() + size
        return [led[a:b] for a, b in zip(cuts, [*cuts[1:], len(led)])]

    def plain(self, parts: list[str]):
        """ids of A and of B, both with the tokens per part, from the libraries; parts begin with a space."""
        a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in parts], num_threads=1)
        out = []
        for ids in (a, b):
            out += [np.concatenate([np.zeros(0, np.int64), *[np.array(x, dtype=np.int64) for x in ids]]),
                    np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))]
        return out

    def of_words(self, words: list[str]):
        """As :meth:`plain` for words cut as in :meth:`encode`: ``JOINED`` of them go to a call, and the
        bytes of the tokens tell them apart again.  Words that end with white space or hold a marker go alone."""
        alone = np.array([w[-1].isspace() or MARK in w for w in words], dtype=bool)
        easy = [w for w, x in zip(words, alone) if not x]
        joined = ["".join(easy[i:i + JOINED]) for i in range(0, len(easy), JOINED)]
        rest = self.plain([w for w, x in zip(words, alone) if x])
        together = self.plain(joined)
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in easy), dtype=np.int64, count=len(easy)))
        out = []
        for k, side in ((0, self.a_side), (2, self.b_side)):
            ids = together[k]
            token_ends = np.cumsum(side.size[ids])
            last = np.searchsorted(token_ends, ends)
            if len(easy) and (last[-1] + 1 != len(ids) or (token_ends[last] != ends).any()):
                return self.plain(words)
            n = np.zeros(len(words), dtype=np.int64)
            n[~alone], n[alone] = np.diff(np.append(-1, last)), rest[k + 1]
            of = np.repeat(alone, n)
            both = np.zeros(int(n.sum()), dtype=np.int64)
            both[~of], both[of] = ids, rest[k]
            out += [both, n]
        return out

    def encode(self, parts: list[str]):
        """As :meth:`plain`, but every distinct word is encoded once while the cache lasts.

        A space behind a character that is no white space begins a word of A's splitter, whatever follows,
        and no piece of B runs across it, so the ids of the words are those of the whole."""
        if not self.separable:
            return self.plain(parts)
        data, offsets = tx.utf8(pa.array(parts, pa.large_string()))
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (data[1:] == 32) & ~_white_end(data)[:-1]
        cut[offsets[1:] - 1] = False  # a space alone is no word: B would take it for an empty text
        cut[offsets[:-1]] = True
        at = np.flatnonzero(cut)
        a, n_a, b, n_b = self.words(tx.pieces_between(data, at))
        first = np.searchsorted(at, offsets)
        ends_a, ends_b = np.append(0, np.cumsum(n_a))[first], np.append(0, np.cumsum(n_b))[first]
        return a, np.diff(ends_a), b, np.diff(ends_b)

    def same(self, parts: list[str], a, n_a, b, n_b) -> np.ndarray:
        """Parts whose joined tokens are their bytes under A and B."""
        raw = [p.encode() for p in parts]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        good = np.ones(len(raw), dtype=bool)
        for side, ids, n in ((self.a_side, a, n_a), (self.b_side, b, n_b)):
            good &= _sums(side.size[ids], n) == size
        data = np.frombuffer(b"".join(r for r, ok in zip(raw, good) if ok), dtype=np.uint8)
        ends = np.cumsum(size[good])
        for side, ids, n in ((self.a_side, a, n_a), (self.b_side, b, n_b)):
            wrong = np.flatnonzero(side.join(ids[np.repeat(good, n)]) != data)
            if len(wrong):
                at = np.flatnonzero(good)
                good[at[np.unique(np.searchsorted(ends, wrong, side="right"))]] = False
                data = np.frombuffer(b"".join(r for r, ok in zip(raw, good) if ok), dtype=np.uint8)
                ends = np.cumsum(size[good])
        return good


_ASCII_WHITE = tx.byte_table(bytes([9, 10, 11, 12, 13, 32]))


def _white_end(data: np.ndarray) -> np.ndarray:
    """Bytes that end a white-space character."""
    white = _ASCII_WHITE[data]
    if (data >= 128).any():
        one, two = np.zeros_like(data), np.zeros_like(data)
        one[1:], two[2:] = data[:-1], data[:-2]
        white |= (one == 0xC2) & ((data == 0x85) | (data == 0xA0))
        white |= (two == 0xE1) & (one == 0x9A) & (data == 0x80) | (two == 0xE3) & (one == 0x80) & (data == 0x80)
        white |= (two == 0xE2) & (one == 0x80) & ((data >= 0x80) & (data <= 0x8A) | (data == 0xA8) | (data == 0xA9) | (data == 0xAF))
        white |= (two == 0xE2) & (one == 0x81) & (data == 0x9F)
    return white


class _Words:
    """The ids of A and B of every distinct word, kept until there are more than ``CACHED_WORDS``."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = [np.zeros(0, np.uint16)] * 2
        self.start, self.length = [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2

    def __call__(self, words: pa.Array):
        if len(self.index) > CACHED_WORDS:
            self.clear()
        coded = words.dictionary_encode()
        known = coded.dictionary.to_pylist()
        place = self.index.get
        at = np.fromiter((place(w, -1) for w in known), dtype=np.int64, count=len(known))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [known[i] for i in new.tolist()]
            found = self.pair.of_words(fresh)
            base = len(self.index)
            self.index.update(zip(fresh, range(base, base + len(fresh))))
            at[new] = np.arange(base, base + len(fresh))
            for k, (ids, n) in enumerate((found[:2], found[2:])):
                self.start[k] = np.append(self.start[k], len(self.flat[k]) + np.cumsum(n) - n)
                self.length[k] = np.append(self.length[k], n)
                self.flat[k] = np.append(self.flat[k], ids.astype(np.uint16))
        row = at[coded.indices.to_numpy(zero_copy_only=False)]
        out = []
        for k in (0, 1):
            n = self.length[k][row]
            out += [tx.gather(self.flat[k], self.start[k][row], n).astype(np.int64), n]
        return out


_PAIRS: dict[tuple, Pair] = {}


def pair_of(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n`` values."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


# --- merge path ------------------------------------------------------------------------------------

def path_at(a: np.ndarray, b: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """How many of the first ``diagonal`` merged ends are A's, by binary search on each diagonal; equal
    ends come A first."""
    lo, hi = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (lo < hi).any():
        mid = (lo + hi) // 2
        going = lo < hi
        at = np.where(going, mid, 0)
        before = a[np.minimum(at, len(a) - 1)] <= b[np.clip(diagonal - 1 - at, 0, len(b) - 1)]
        lo = np.where(going & before, mid + 1, lo)
        hi = np.where(going & ~before, mid, hi)
    return lo


def cut_path(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first A token, first B token) of every piece; ``a`` and ``b`` are the ends of all parts, one
    after another, and a part of n ends has a piece for every ``work`` of them."""
    pieces = np.maximum(1, -(-(n_a + n_b) // work))
    part = np.repeat(np.arange(len(n_a)), pieces)
    nth = np.arange(len(part)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    diagonal = (np.cumsum(n_a + n_b) - n_a - n_b)[part] + nth * work
    first_a = (np.cumsum(n_a) - n_a)[part]
    inner = nth > 0
    if inner.any():
        first_a[inner] = path_at(a, b, diagonal[inner])
    return part, first_a, diagonal - first_a


def _packed(a: np.ndarray, b: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(a.astype("<u2").tobytes() + b.astype("<u2").tobytes())


PIECE = ("node long, piece int, last boolean, chunk long, a_n int, b_n int, a_more int, b_more int, a_begin long, b_begin long, at long, ids binary")


class _Writer:
    """Pieces of one task, numbered by document and dealt to chunks."""

    def __init__(self, task: int, chunk_bytes: int):
        self.task, self.chunk_bytes = task, chunk_bytes
        self.node = self.chunk = self.filled = 0

    def documents(self, own: Pair, texts: list[str], work: int, segment: int):
        """For every text the rows of its pieces, without the id."""
        parts, doc = [], []
        for i, t in enumerate(texts):
            some = own.segments(t, segment) if t else []
            parts += some
            doc += [i] * len(some)
        doc = np.array(doc, dtype=np.int64)
        rows: list[list] = [[] for _ in texts]
        bad = np.zeros(len(texts), dtype=bool)
        lo = 0
        begin = np.zeros(len(texts), dtype=np.int64)  # bytes of a text before its next segment
        while lo < len(parts):
            hi, size = lo, 0
            while hi < len(parts) and (hi == lo or size + len(parts[hi]) <= tx.STEP_BYTES):
                size += len(parts[hi])
                hi += 1
            self._step(own, parts[lo:hi], doc[lo:hi], rows, bad, begin, work)
            lo = hi
        for i in range(len(texts)):
            if bad[i] or not rows[i]:
                rows[i] = [(0, 0, 0, 0, 0, 0, 0, b"", 0)]
            yield i, rows[i]

    @staticmethod
    def _step(own: Pair, parts, doc, rows, bad, begin, work):
        a, n_a, b, n_b = own.encode(parts)
        good = own.same(parts, a, n_a, b, n_b)
        bad[doc[~good]] = True
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b, doc = n_a[good], n_b[good], doc[good]
        if not len(doc):
            return
        a_end, b_end = np.cumsum(own.a_side.size[a]), np.cumsum(own.b_side.size[b])
        part, i0, j0 = cut_path(a_end, b_end, n_a, n_b, work)
        i1, j1 = np.append(i0[1:], len(a)), np.append(j0[1:], len(b))
        stop_a, stop_b = np.cumsum(n_a)[part], np.cumsum(n_b)[part]
        a_from, b_from = np.append(0, a_end)[i0], np.append(0, b_end)[j0]
        at = np.maximum(a_from, b_from)
        first = np.append(0, a_end)[stop_a - n_a[part]]  # byte where the part begins
        more_a, more_b = (i1 < stop_a).astype(np.int64), (j1 < stop_b).astype(np.int64)
        size = np.append(at[1:], a_end[-1]) - at
        for k, d in enumerate(doc[part].tolist()):
            rows[d].append((int(i1[k] - i0[k]), int(j1[k] - j0[k]), int(more_a[k]), int(more_b[k]), int(a_from[k] - at[k]), int(b_from[k] - at[k]),
                            int(at[k] - first[k] + begin[d]), _packed(a[i0[k]:i1[k] + more_a[k]], b[j0[k]:j1[k] + more_b[k]]), int(size[k])))
            if k + 1 == len(part) or part[k + 1] != part[k]:
                begin[d] += int(a_end[stop_a[k] - 1] - first[k])

    def number(self, pieces: list) -> list[tuple]:
        out = []
        for k, (a_n, b_n, a_more, b_more, a_begin, b_begin, at, ids, size) in enumerate(pieces):
            out.append((self.task << 33 | self.node, k, k + 1 == len(pieces), self.task << 33 | self.chunk, a_n, b_n, a_more, b_more, a_begin, b_begin, at, ids))
            self.filled += size
            if self.filled >= self.chunk_bytes:
                self.chunk, self.filled = self.chunk + 1, 0
        self.node += 1
        return out


def piece_table(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", work: int = WORK,
                segment: int = SEGMENT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per piece of every document, written to the shared folder."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType), *T.StructType.fromDDL(PIECE).fields])

    def run(batches):
        from pyspark import TaskContext
        own = pair_of(a_path, b_path)
        writer = _Writer(TaskContext.get().partitionId(), chunk_bytes)
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), *[pa.int32()] * 4, *[pa.int64()] * 3, pa.binary()]
        for whole in batches:
            for batch in tx.steps(whole, "text"):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows, doc = [], []
                for i, pieces in writer.documents(own, texts, work, segment):
                    numbered = writer.number(pieces)
                    rows += numbered
                    doc += [i] * len(numbered)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]],
                                                 names=schema.names)
    return staged(narrow.mapInArrow(run, schema), "align-pieces")


# --- pieces -----------------------------------------------------------------------------------------

class Merged:
    """The overlaps and closed groups of some pieces, merged each on its own but all at once.

    ``a_i``/``a_j`` are the tokens of overlaps that end with an A token, ``b_i``/``b_j`` of those that end
    with a B token alone; ``tie`` marks the B tokens that close a group."""

    def __init__(self, table, a_side: Side, b_side: Side):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        number = {n: table.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("a_n", "b_n", "a_more", "b_more", "a_begin", "b_begin")}
        self.n_a, self.n_b = number["a_n"], number["b_n"]
        all_a, all_b = self.n_a + number["a_more"], self.n_b + number["b_more"]
        raw = [np.frombuffer(unpack.decompress(x), dtype="<u2") if x else np.zeros(0, "<u2") for x in table.column("ids").to_pylist()]
        flat = np.concatenate(raw) if raw else np.zeros(0, "<u2")
        n = len(raw)
        of = np.repeat(np.tile([True, False], n), np.stack([all_a, all_b], axis=1).reshape(-1))
        self.a, self.b = flat[of].astype(np.int64), flat[~of].astype(np.int64)
        self.a_piece, self.b_piece = np.repeat(np.arange(n), all_a), np.repeat(np.arange(n), all_b)
        a_size, b_size = a_side.size[self.a], b_side.size[self.b]
        # places of one piece lie behind those of the piece before
        extent = np.maximum(_sums(a_size, all_a), _sums(b_size, all_b)) + 2
        self.base = np.cumsum(extent) - extent
        a_first, b_first = np.cumsum(all_a) - all_a, np.cumsum(all_b) - all_b

        def ends(size, per_piece, begin, piece):
            total = np.append(0, np.cumsum(size))
            start = np.cumsum(per_piece) - per_piece
            return total[1:] - total[start][piece] + (self.base + begin)[piece]
        self.a_end, self.b_end = ends(a_size, all_a, number["a_begin"], self.a_piece), ends(b_size, all_b, number["b_begin"], self.b_piece)
        self.a_own = np.arange(len(self.a)) - a_first[self.a_piece] < self.n_a[self.a_piece]
        self.b_own = np.arange(len(self.b)) - b_first[self.b_piece] < self.n_b[self.b_piece]
        self.a_i = np.flatnonzero(self.a_own)
        self.a_j = np.searchsorted(self.b_end, self.a_end[self.a_i])
        own_b = np.flatnonzero(self.b_own)
        with_a = np.searchsorted(self.a_end, self.b_end[own_b])
        end = self.b_end[own_b]
        here = self.base[self.b_piece[own_b]]
        tie = end == here  # the A token with this end stands in the piece before
        inside = with_a < len(self.a_end)
        tie[inside] |= self.a_end[with_a[inside]] == end[inside]
        self.closing = own_b[tie]
        self.b_i, self.b_j = with_a[~tie], own_b[~tie]
        self.count = n

    def groups(self) -> np.ndarray:
        return np.bincount(self.b_piece[self.closing], minlength=self.count)

    def links(self) -> np.ndarray:
        return self.n_a + np.bincount(self.b_piece[self.b_j], minlength=self.count)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs of the overlaps (A's id above B's) and their pieces."""
        pair = np.concatenate([self.a[self.a_i] << ID_BITS | self.b[self.a_j], self.a[self.b_i] << ID_BITS | self.b[self.b_j]])
        return pair, np.concatenate([self.a_piece[self.a_i], self.b_piece[self.b_j]])

    def closed(self) -> np.ndarray:
        """Pieces that end where a group does, or are empty."""
        ends = np.append(0, self.b_end)
        last = (np.cumsum(np.bincount(self.b_piece, minlength=self.count)) - np.bincount(self.b_piece, minlength=self.count) + self.n_b)
        shut = np.zeros(len(self.b) + 1, dtype=bool)
        shut[self.closing + 1] = True
        own_a = np.cumsum(np.bincount(self.a_piece, minlength=self.count)) - np.bincount(self.a_piece, minlength=self.count) + self.n_a
        a_last = np.where(self.n_a > 0, np.append(0, self.a_end)[own_a], -1)
        return (self.n_a + self.n_b == 0) | ((self.n_b > 0) & shut[last] & (a_last <= ends[last]))

    def written(self) -> tuple[bytes, np.ndarray]:
        """The groups of all pieces as ``a1,a2|b1;...`` one after another, and where each piece's text begins.
        A part of a group that has no A tokens here lacks the bar, one without B tokens the semicolon."""
        close_end = self.b_end[self.closing]
        i, j = self.a_i, np.flatnonzero(self.b_own)
        g_a = np.searchsorted(close_end, self.a_end[i]) + self.a_piece[i]
        g_b = np.searchsorted(close_end, self.b_end[j]) + self.b_piece[j]
        a_stop = np.append(g_a[1:] != g_a[:-1], True)[:len(g_a)]
        b_stop = np.append(g_b[1:] != g_b[:-1], True)[:len(g_b)]
        key = np.concatenate([2 * g_a, 2 * g_b + 1])
        order = np.argsort(key, kind="stable")
        ids = np.concatenate([self.a[i], self.b[j]])[order]
        sep = np.concatenate([np.where(a_stop, 1, 0), np.where(b_stop, 2, 0)])[order]
        flat, at, size = _decimal()
        row = ids * 3 + sep
        piece = np.concatenate([self.a_piece[i], self.b_piece[j]])[order]
        per = np.append(0, np.cumsum(size[row]))
        begin = per[np.searchsorted(piece, np.arange(self.count + 1))]
        return tx.gather(flat, at[row], size[row]).tobytes(), begin


_DECIMAL: list = []


def _decimal():
    """Bytes of every id in decimal with each of the separators ``,``, ``|`` and ``;``: row id * 3 + separator."""
    if not _DECIMAL:
        names = [f"{i}{s}".encode() for i in range(1 << ID_BITS) for s in ",|;"]
        size = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
        _DECIMAL.extend([np.frombuffer(b"".join(names), dtype=np.uint8), np.cumsum(size) - size, size])
    return _DECIMAL


def _slices(table):
    """The table cut so that a part has about ``LINKS_AT_ONCE`` tokens."""
    ends = np.cumsum(table.column("a_n").to_numpy(zero_copy_only=False).astype(np.int64) + table.column("b_n").to_numpy(zero_copy_only=False) + 8)
    lo = 0
    while lo < table.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + LINKS_AT_ONCE, side="right")))
        yield table.slice(lo, hi - lo)
        lo = hi


def pair_counts(pieces: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """chunk, pair (A's id times 65536 plus B's) and the overlaps that hold it there; a chunk's pair may
    come more than once."""
    schema = "chunk long, pair long, n long"

    def run(batches):
        own = pair_of(a_path, b_path)

        def out(chunk, held):
            pair, n = _merge_counts(held)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk, np.int64)), pa.array(pair), pa.array(n)], names=["chunk", "pair", "n"])
        now, held = None, []
        for whole in batches:
            for part in _slices(whole):
                merged = Merged(part, own.a_side, own.b_side)
                pair, piece = merged.codes()
                chunk = part.column("chunk").to_numpy(zero_copy_only=False)
                for c in dict.fromkeys(chunk.tolist()):
                    if c != now and held:
                        yield out(now, held)
                        held = []
                    now = c
                    # held counts are merged when there are many, so they stay near the chunk's distinct pairs
                    held.append(np.unique(pair[(chunk == c)[piece]], return_counts=True))
                    if len(held) > 16:
                        held = [_merge_counts(held)]
        if held:
            yield out(now, held)
    return pieces.select("chunk", "a_n", "b_n", "a_more", "b_more", "a_begin", "b_begin", "ids").where("a_n > 0 or b_n > 0").mapInArrow(run, schema)


def _merge_counts(held: list) -> tuple[np.ndarray, np.ndarray]:
    if len(held) == 1:
        return held[0]
    pair, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    n = np.zeros(len(pair), dtype=np.int64)
    np.add.at(n, at, np.concatenate([c for _, c in held]))
    return pair, n


def corpus_counts(partial: DataFrame) -> DataFrame:
    """pair, n over the corpus and whether no pair of the same B id has more; a B id has at most as many
    rows as A has ids."""
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    b = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    counts = staged(counts.withColumn("b", b), "align-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


SUMMED = "node long, piece int, last boolean, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, closed boolean, groups_sha256 string, groups binary"


def summed(pieces: DataFrame, known: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Sums of every piece; the groups as text only of pieces that are not a whole document."""
    schema = T.StructType([pieces.schema["doc_id"], *T.StructType.fromDDL(SUMMED).fields])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = pair_of(a_path, b_path)
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, n, best = pair[order], right.column("n").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order]
        out = []
        for part in _slices(left.combine_chunks()):
            merged = Merged(part, own.a_side, own.b_side)
            code, piece = merged.codes()
            at = np.searchsorted(pair, code)
            totals = []
            half = len(merged.a_i)
            for values in (best, n):
                x = values[at] if len(at) else np.zeros(0, np.int64)
                totals.append(_sums(x[:half], np.bincount(piece[:half], minlength=merged.count))
                              + _sums(x[half:], np.bincount(piece[half:], minlength=merged.count)))
            text, begin = merged.written()
            sha, groups = [], []
            for k, (nth, last, a, b) in enumerate(zip(part.column("piece").to_pylist(), part.column("last").to_pylist(), begin.tolist(), begin[1:].tolist())):
                single = nth == 0 and last
                sha.append(("" if a == b else hashlib.sha256(text[a:b - 1]).hexdigest()) if single else None)
                groups.append(None if single else text[a:b])
            out.append(pa.table([part.column("doc_id"), part.column("node"), part.column("piece"), part.column("last"), pa.array(merged.n_a), pa.array(merged.n_b),
                                 pa.array(merged.groups()), pa.array(merged.links()), pa.array(totals[0]), pa.array(totals[1]),
                                 pa.array(merged.closed()), pa.array(sha, pa.string()), pa.array(groups, pa.binary())], names=schema.names))
        return pa.concat_tables(out) if out else pa.Table.from_batches([], schema=_arrow(schema))
    return staged(pieces.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema), "align-sums")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


class Stitch:
    """The hash of a document's groups from the texts of its pieces in order; a group that is open at a
    border goes on in the next piece."""

    def __init__(self):
        self.sha, self.any, self.a, self.b = hashlib.sha256(), False, b"", b""

    def _emit(self, text: bytes) -> None:
        if text:
            self.sha.update(b";" + text if self.any else text)
            self.any = True

    def add(self, text: bytes, closed: bool) -> None:
        if not text:
            return
        groups = text.split(b";")
        if groups[-1] == b"":
            groups.pop()
        elif not groups[-1].endswith(b"|"):
            raise ValueError("a piece ends inside a group's text")
        for k in ([0] if len(groups) == 1 else [0, len(groups) - 1]):
            a, bar, b = groups[k].partition(b"|")
            if not bar:
                a, b = b"", a
            if k == 0:
                a, b = b",".join(x for x in (self.a, a) if x), b",".join(x for x in (self.b, b) if x)
                self.a = self.b = b""
            if k == len(groups) - 1 and not closed:
                self.a, self.b = a, b
            else:
                self._emit(a + b"|" + b)
            if k == 0 and len(groups) > 2:
                self._emit(b";".join(groups[1:-1]))

    def digest(self) -> str:
        if self.a or self.b:
            raise ValueError("a group is left open")
        return self.sha.hexdigest()


RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def stitched(sums: DataFrame) -> DataFrame:
    """One row per document from its pieces; a long document's pieces stream through one task in order."""
    single = sums.where("piece = 0 and last").select("doc_id", *RESULT, "groups_sha256")
    several = (sums.where("not (piece = 0 and last)").select("doc_id", "node", "piece", *RESULT, "closed", "groups")
               .repartition("node").sortWithinPartitions("node", "piece"))

    names = single.columns

    def run(batches):
        held = None

        def rows(done, id_type):
            types = [id_type, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        for b in batches:
            done = []
            for i in range(b.num_rows):
                row = {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}
                if held is None or row["node"] != held[0]:
                    if held:
                        done.append((held[1], *held[2], held[3].digest()))
                    held = [row["node"], row["doc_id"], [0] * len(RESULT), Stitch()]
                held[2] = [x + row[n] for x, n in zip(held[2], RESULT)]
                held[3].add(row["groups"], row["closed"])
            if done:
                yield rows(done, b.schema.field("doc_id").type)
        if held:
            yield rows([(held[1], *held[2], held[3].digest())], b.schema.field("doc_id").type)
    return single.unionByName(several.mapInArrow(run, single.schema))


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", work: int = WORK,
                    segment: int = SEGMENT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    pieces = piece_table(docs, a_path, b_path, id_col, text_col, work, segment, chunk_bytes)
    partial = staged(pair_counts(pieces, a_path, b_path), "align-pairs")
    known = partial.select("chunk", "pair").distinct().join(corpus_counts(partial), "pair")
    return stitched(summed(pieces, known, a_path, b_path)).withColumnRenamed("doc_id", id_col)


def overlaps(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", work: int = WORK,
             segment: int = SEGMENT) -> DataFrame:
    """Every overlap: doc_id, node (a number of the row), start and end (bytes of a space and the text), a_id, b_id."""
    pieces = piece_table(docs, a_path, b_path, id_col, text_col, work, segment)
    schema = T.StructType([pieces.schema["doc_id"], *T.StructType.fromDDL("node long, start long, end long, a_id int, b_id int").fields])

    def run(batches):
        own = pair_of(a_path, b_path)
        for whole in batches:
            for part in _slices(whole):
                m = Merged(part, own.a_side, own.b_side)
                piece = np.concatenate([m.a_piece[m.a_i], m.b_piece[m.b_j]])
                i, j = np.concatenate([m.a_i, m.b_i]), np.concatenate([m.a_j, m.b_j])
                end = np.concatenate([m.a_end[m.a_i], m.b_end[m.b_j]])
                start = np.maximum(m.a_end[i] - own.a_side.size[m.a[i]], m.b_end[j] - own.b_side.size[m.b[j]])
                shift = (part.column("at").to_numpy() - m.base)[piece]
                rows = pa.array(piece)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("node").take(rows), pa.array(start + shift), pa.array(end + shift),
                                                  pa.array(m.a[i].astype(np.int32)), pa.array(m.b[j].astype(np.int32))], names=schema.names)
    return pieces.where("a_n > 0 or b_n > 0").mapInArrow(run, schema)
