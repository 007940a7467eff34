"""Deterministic randomness and numpy-compatible rounding.

``hash_uniform`` replaces every random number generator in the library: a
draw is a pure function of (seed, keys), so results do not depend on the
partitioning, survive task retries bit for bit, and can be recomputed in SQL.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(seed, *keys) -> Column:
    """Uniform draw in [0, 1): first 8 hex digits of md5('seed|k1|k2..') / 2^32.

    Keys must be integer columns (cast to string by value) or strings.
    """
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    h = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(TWO_32)


def hash_uniform_sql(seed, *keys: str) -> str:
    """DuckDB twin of :func:`hash_uniform`."""
    parts = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8)) AS BIGINT) / {TWO_32})"


_TURNS = [x for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for x in row * 4]
_ADDED = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_WORD = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_BEGIN = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_block(state: list[np.ndarray], words: list, last: bool) -> list[np.ndarray]:
    """One block of MD5 for many messages at once; of the last block only the first number of the digest."""
    a, b, c, d = (x.copy() for x in state)
    t, u = np.empty_like(a), np.empty_like(a)
    for i in range(61 if last else 64):
        if i < 16:
            np.bitwise_xor(c, d, out=t), np.bitwise_and(t, b, out=t), np.bitwise_xor(t, d, out=t)
        elif i < 32:
            np.bitwise_xor(b, c, out=t), np.bitwise_and(t, d, out=t), np.bitwise_xor(t, c, out=t)
        elif i < 48:
            np.bitwise_xor(b, c, out=t), np.bitwise_xor(t, d, out=t)
        else:
            np.invert(d, out=t), np.bitwise_or(t, b, out=t), np.bitwise_xor(t, c, out=t)
        np.add(a, t, out=t)
        w = words[_WORD[i]]
        if isinstance(w, int):
            np.add(t, np.uint32((w + _ADDED[i]) & 0xFFFFFFFF), out=t)
        else:
            np.add(t, w, out=t), np.add(t, np.uint32(_ADDED[i]), out=t)
        np.left_shift(t, np.uint32(_TURNS[i]), out=u), np.right_shift(t, np.uint32(32 - _TURNS[i]), out=t)
        np.bitwise_or(t, u, out=t), np.add(t, b, out=a)
        a, b, c, d = d, a, b, c
    return [state[0] + b] if last else [x + y for x, y in zip(state, (a, b, c, d))]


def hash_draws(numbers: np.ndarray, seed, *keys, block: int = 32768) -> np.ndarray:
    """:func:`hash_uniform` with the last key from ``numbers`` (not negative), times 2^32, as whole numbers: the MD5 of a block of messages
    that differ in their last digits is computed side by side."""
    prefix = "|".join(map(str, (seed, *keys, ""))).encode()
    numbers = np.asarray(numbers, np.int64)
    out = np.empty(len(numbers), np.uint32)
    digits = np.searchsorted(10 ** np.arange(1, 19), numbers, side="right") + 1
    for many in np.unique(digits):
        rows = np.flatnonzero(digits == many)
        size = len(prefix) + int(many)
        message = bytearray(prefix + b"\0" * int(many) + b"\x80")
        message += b"\0" * ((56 - len(message)) % 64) + (8 * size).to_bytes(8, "little")
        fixed = [int.from_bytes(message[k:k + 4], "little") for k in range(0, len(message), 4)]
        for lo in range(0, len(rows), block):
            own = rows[lo:lo + block]
            left, words = numbers[own], list(fixed)
            if many < 10:
                left = left.astype(np.uint32)
            for at in range(size - 1, len(prefix) - 1, -1):
                rest = left // 10
                digit = (left - rest * 10).astype(np.uint32) + np.uint32(48)
                words[at // 4] = (digit << np.uint32(8 * (at % 4))) + (words[at // 4] if not isinstance(words[at // 4], int) else np.uint32(words[at // 4]))
                left = rest
            state = [np.full(len(own), x, np.uint32) for x in _BEGIN]
            for k in range(0, len(words), 16):
                state = _md5_block(state, words[k:k + 16], k + 16 == len(words))
            out[own] = state[0].byteswap()
    return out


def np_round(c, digits: int = 0) -> Column:
    """numpy.round: half-to-even at ``digits`` decimals, as rint(x*10^d)/10^d."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def np_round_sql(expr: str, digits: int = 0) -> str:
    scale = float(10 ** digits)
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale!r}::DOUBLE, 0) / {scale!r}::DOUBLE)"
