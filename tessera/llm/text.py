"""Whole texts as byte arrays: splitting, hashing and cached tokenizing for Arrow batches.

Everything works on the UTF-8 bytes of many documents at once with numpy; a batch is cut between
documents so that one step handles about ``STEP_BYTES``, and a longer single document is one step of
its own.  Texts are never cut."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

STEP_BYTES = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets per text); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows into parts of about ``size`` bytes of text."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


ASCII_SPACE = byte_table(b" \t\n\r")
#: Letters and digits of ASCII and every byte of a longer character.
WORD = byte_table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross a text: (starts, ends, first run per text + total)."""
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    else:
        starts = ends = np.zeros(0, dtype=np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse; only a step's worth of them is kept."""
    def run(base: int, size: int) -> np.ndarray:
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        return np.multiply.accumulate(step)
    if n > STEP_BYTES + 1:
        return run(_MULT, n), run(_INV, n)
    if not _POWERS:
        _POWERS.update(up=run(_MULT, STEP_BYTES + 1), down=run(_INV, STEP_BYTES + 1))
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = STEP_BYTES) -> np.ndarray:
    """A 64-bit hash of every run's bytes, from prefix sums of a polynomial modulo 2^64.

    Runs are taken in blocks of about ``block`` bytes (a longer run is a block of its own), so a very long
    text needs no more memory than a step; a hash does not depend on the block."""
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + block, side="right")))
        own = data[lo:int(ends[to - 1])]
        up, down = _powers(len(own) + 1)
        total = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum((own.astype(np.uint64) + np.uint64(1)) * up[:len(own)], out=total[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


#: What an operator keeps in a worker from task to task, by name.
HELD: dict[str, object] = {}


def release(keep: str | None = None) -> None:
    """Give freed memory of this worker back, and what operators hold in it under other names than ``keep``: what
    one task or stage used is not held while others run."""
    for name in [name for name in HELD if name != keep]:
        del HELD[name]
    pa.default_memory_pool().release_unused()
    try:
        import ctypes
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lower_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words (runs of letters, digits and non-ASCII characters) of every text as 64-bit
    hashes: (hashes, first word per text + total)."""
    import pyarrow.compute as pc
    data, offsets = utf8(pc.utf8_lower(column))
    starts, ends, first = runs(WORD[data], offsets)
    return hash_runs(data, starts, ends), first


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of flat[start:start + length] over all rows."""
    total = int(length.sum())
    out = np.cumsum(length) - length
    return flat[np.repeat(start - out, length) + np.arange(total)]


class PieceCache:
    """Token ids of text pieces, each distinct piece being tokenized once while the cache lasts.

    ``encode`` takes a list of strings and returns a list of id lists.  The cache starts anew when it
    holds more than ``limit`` pieces, so its memory is bounded."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, ids per piece)."""
        if len(self.index) > self.limit:
            self.clear()
        coded = pieces.dictionary_encode()
        known = coded.dictionary.to_pylist()
        place = self.index.get
        at = np.fromiter((place(p, -1) for p in known), dtype=np.int64, count=len(known))
        new = np.flatnonzero(at < 0)
        if len(new):
            words = [known[i] for i in new]
            ids = self.encode(words)
            length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter((t for x in ids for t in x), dtype=np.uint32, count=int(length.sum()))
            base = len(self.start)
            self.index.update(zip(words, range(base, base + len(words))))
            at[new] = np.arange(base, base + len(words))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(length) - length)
            self.length = np.append(self.length, length)
            self.flat = np.append(self.flat, flat)
        row = at[coded.indices.to_numpy(zero_copy_only=False)] if len(pieces) else np.zeros(0, np.int64)
        return gather(self.flat, self.start[row], self.length[row]), self.length[row]


def pieces_between(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The strings between neighbouring cuts (the last one ends with the data), without copying."""
    offsets = np.append(cuts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
