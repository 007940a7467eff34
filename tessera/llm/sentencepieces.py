"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here (only the fields needed), and a tokenizer is rebuilt from it: the
normaliser (its compiled character map, extra white space), the metaspace marker with the dummy prefix,
the unigram scores or, for a byte-pair model, the merges that its scores order, and byte fallback.

Texts are encoded in the tasks, many at a time and in threads.  If the model leaves characters alone and
no piece runs across the marker or a line end (checked on the vocabulary), texts are cut there and every
distinct piece of text is encoded once while a bounded cache lasts; each new one is compared with the
SentencePiece library when parity is asked for.  Other models take the whole texts.

Defined cases: a null text is empty and has no ids; texts of any length are encoded whole; control
pieces in a text are ordinary text; a null or repeated doc_id is carried along; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # piece types of the format


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: ints, 4- and 8-byte strings, or byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = buf[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7
    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, buf[at:at + n]
        at += n


@dataclass
class Model:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True

    @staticmethod
    def parse(data: bytes) -> Model:
        m = Model()
        for no, value in _fields(data):
            if no == 1:
                own = dict(_fields(value))
                m.pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, NORMAL)))
            elif no == 2:
                own = dict(_fields(value))
                m.kind, m.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif no == 3:
                own = dict(_fields(value))
                m.charsmap, m.dummy_prefix, m.trim = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1))
        return m

    @property
    def unknown(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)

    def merges(self) -> list[tuple[str, str]]:
        """All ways to join two pieces into a third, best-scored result first."""
        score = {p: s for p, s, kind in self.pieces if kind in (NORMAL, USER)}
        found = [(-s, p[:k], p[k:]) for p, s in score.items() for k in range(1, len(p)) if p[:k] in score and p[k:] in score]
        return [(a, b) for _, a, b in sorted(found, key=lambda x: x[0])]

    def separable(self) -> bool:
        """No normalising, and no piece holds a line end or a marker behind another character."""
        plain = not self.charsmap and not self.trim and not any(p[2] == USER for p in self.pieces)
        return plain and not any("\n" in p or MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind == NORMAL)

    def tokenizer(self, prefix: bool = True, split: bool = False):
        """The model as a tokenizer; ``prefix``: with the dummy prefix; ``split``: words apart."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers
        if self.kind == BPE:
            core = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(self.pieces)}, merges=self.merges(),
                              unk_token=self.pieces[self.unknown][0], fuse_unk=True, byte_fallback=self.byte_fallback, cache_capacity=0)
        elif self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            raise ValueError("only unigram and byte-pair models have a backend")
        tok = Tokenizer(core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if prefix and self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        tok.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        if split:
            tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="never", split=True)
        tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                         *([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else [])])
        tok.add_tokens([AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER])
        return tok

    def bytes_of(self) -> list[bytes]:
        """The bytes that each id stands for in a decoded text."""
        return [b"" if kind == CONTROL else bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode()
                for p, _, kind in self.pieces]


class Backend:
    """Encoder and decoder of one model in one worker process."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            self.model = Model.parse(f.read())
        self.whole = self.model.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.separable = self.model.separable() and self.model.dummy_prefix
        parts = self.model.bytes_of()
        self.flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.at = np.cumsum(self.size) - self.size
        if self.separable:
            self.words = self.model.tokenizer(prefix=False, split=True)
            self.loose = self.model.tokenizer(prefix=False)
            self.opens = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
            self.different: set[str] = set()
            self.cache = tx.PieceCache(self._encode, limit=450_000)

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces cut at markers and line ends; plain words go a thousand to a call."""
        plain = [p[0] == " " and len(p) > 1 and p[1] != " " and MARK not in p and "\n" not in p for p in pieces]
        easy = [p for p, ok in zip(pieces, plain) if ok]
        rest = iter([e.ids for e in self.loose.encode_batch_fast([p for p, ok in zip(pieces, plain) if not ok], add_special_tokens=False)])
        joined = ["".join(easy[i:i + 1000]) for i in range(0, len(easy), 1000)]
        ids = np.fromiter((t for e in self.words.encode_batch_fast(joined, add_special_tokens=False) for t in e.ids), dtype=np.int64)
        begins = np.append(np.flatnonzero(self.opens[ids]), len(ids)).tolist()
        flat = ids.tolist()
        own = iter([flat[a:b] for a, b in zip(begins, begins[1:])])
        out = [next(own) if ok else next(rest) for ok in plain]
        if len(begins) != len(easy) + 1:
            raise ValueError("a word does not begin with the marker")
        # the library itself adds the prefix; a piece behind a line end is compared behind one
        expected = self.reference.encode([p[1:] if p[0] == " " else "\n" + p for p in pieces])
        for p, a, b in zip(pieces, out, expected):
            if a != ([self.reference.piece_to_id(MARK)] if p == " " else b if p[0] == " " else b[2:]):
                self.different.add(p)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, place where each text begins + total, parity per text)."""
        column = column.cast(pa.large_string()).fill_null("")
        if not self.separable:
            texts = column.to_pylist()
            listed = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            same = np.array([a == b for a, b in zip(listed, self.reference.encode(texts))], dtype=bool)
            return (np.fromiter((t for x in listed for t in x), dtype=np.uint32), np.append(0, np.cumsum([len(x) for x in listed])).astype(np.int64), same)
        led = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
        data, offsets = tx.utf8(led)
        blank, line = data == 32, data == 10
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        # a marker written out in the text joins the blanks before it, so it is no place to cut at
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
        if len(mark):
            behind = mark + 3
            inner = behind[behind < len(data)]
            starts = np.zeros(len(data) + 1, dtype=bool)
            starts[offsets] = True
            cut[inner[~starts[inner] & ~line[inner] & ~line[inner - 1]]] = False
        at = np.flatnonzero(cut)
        pieces = tx.pieces_between(data, at) if len(at) else pa.array([], pa.large_string())
        ids, length = self.cache(pieces)
        first = np.searchsorted(at, offsets)
        begin = np.append(0, np.cumsum(length))[first]
        same = np.ones(len(offsets) - 1, dtype=bool)
        if self.different:
            odd = pc.is_in(pieces, value_set=pa.array(sorted(self.different), pa.large_string())).to_numpy(zero_copy_only=False)
            same = np.diff(np.append(0, np.cumsum(odd))[first]) == 0
        return ids, begin, same

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets) of the ids, without the dummy prefix."""
        size = self.size[ids]
        data = tx.gather(self.flat, self.at[ids], size)
        offsets = np.append(0, np.cumsum(size))[begin]
        if self.model.dummy_prefix:
            lead = np.zeros(len(data), dtype=bool)
            some = offsets[:-1] < offsets[1:]
            lead[offsets[:-1][some]] = data[offsets[:-1][some]] == 32
            offsets = offsets - np.append(0, np.cumsum(lead))[offsets]
            data = data[~lead]
        return data, offsets


_BACKENDS: dict[str, Backend] = {}


def backend(path: str) -> Backend:
    if path not in _BACKENDS:
        _BACKENDS[path] = Backend(path)
    return _BACKENDS[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, parity (the ids are the SentencePiece library's), round_trip (decoding the
    ids gives the text's bytes)."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.IntegerType()), T.StructField("parity", T.BooleanType()),
                           T.StructField("round_trip", T.BooleanType())])

    def run(batches):
        own = backend(model)
        for whole in batches:
            for batch in tx.steps(whole, "text"):
                ids, begin, same = own.encode(batch.column(1))
                back, offsets = own.decode(ids, begin)
                data, wanted = tx.utf8(batch.column(1))
                size = np.diff(wanted) == np.diff(offsets)
                back, data = back.tobytes(), data.tobytes()
                again = [bool(ok) and back[a:b] == data[c:d] for ok, a, b, c, d in
                         zip(size, offsets.tolist(), offsets[1:].tolist(), wanted.tolist(), wanted[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids.astype(np.int32))),
                     pa.array(np.diff(begin), pa.int32()), pa.array(same), pa.array(again, pa.bool_())], names=schema.names)
    return narrow.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text that the ids stand for; null ids give a null text."""
    narrow = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches):
        own = backend(model)
        for b in batches:
            texts = own.whole.decode_batch([x or [] for x in b.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pc.if_else(pc.is_valid(b.column(1)), pa.array(texts, pa.string()), pa.scalar(None, pa.string()))],
                                             names=["doc_id", "text"])
    return narrow.mapInArrow(run, schema)
