"""Hashes of byte ranges of many texts at once, by prefix sums."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers, one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


class Ranges:
    """Hashes ``raw[a:b]`` for any ranges of one buffer; equal bytes give equal hashes in every buffer.

    Bytes become random numbers, weighted by powers of an odd ``base`` modulo
    2**64; a prefix sum and the inverse power give the hash of a range.
    """

    def __init__(self, raw: np.ndarray, base: int) -> None:
        n = len(raw)
        letters = mix(np.arange(1, 257, dtype=np.uint64) * _STEP + np.uint64(base))
        with np.errstate(over="ignore"):
            powers = np.full(n + 1, base, dtype=np.uint64)
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(letters[raw] * powers[:n], out=self.sums[1:])
            powers = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
        self.back = powers

    def of(self, starts: np.ndarray | slice, stops: np.ndarray | slice) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.back[starts])


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column one after the other, and the start of each text and the end of the last; null is empty."""
    texts = texts.cast(pa.large_binary())
    texts = texts.fill_null(b"") if texts.null_count else texts
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]
