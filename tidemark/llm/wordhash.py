"""Words of whole Arrow text columns as 64-bit hashes, in numpy.

Texts are taken in runs of at most ``RUN_BYTES`` bytes (a longer text is a run of
its own), so memory doesn't follow the batch.

A span's hash is a polynomial in a fixed random base modulo the prime 2^61 - 1:
two different spans of n symbols agree with odds of n in 2^61, whatever regular
pattern they follow. Where equal hashes decide alone, a second polynomial modulo
2^64, over other values, goes with it (``OtherSpans``): together about 120 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20

_rng = np.random.default_rng(20240501)
#: A number for each byte, and the same with A-Z as a-z.
BYTE = np.arange(1, 257, dtype=np.uint64)
FOLDED = BYTE.copy()
FOLDED[65:91] = BYTE[97:123]
#: Random values for the second polynomial.
OTHER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PRIME = (1 << 61) - 1
_P, _LOW = np.uint64(PRIME), np.uint64((1 << 32) - 1)
_BASE = int(_rng.integers(1 << 32, PRIME))
_OTHER_BASE = int(_rng.integers(1, 1 << 61)) * 8 + 5
#: Symbols whose terms, under 2^41 each, are summed before they are reduced (2^22 at most; fewer stay in cache).
_BLOCK = 1 << 15
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^61 - 1."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.minimum(x, x - _P)


def _raised(x: np.ndarray) -> np.ndarray:
    """A number under 2^62 times 2^32, not fully reduced (under 2^62)."""
    return ((x & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (x >> np.uint64(29))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    a0, a1, b0, b1 = a & _LOW, a >> np.uint64(32), b & _LOW, b >> np.uint64(32)
    low = a0 * b0
    low = (low & _P) + (low >> np.uint64(61))
    return reduced(low + _raised(a0 * b1 + a1 * b0) + ((a1 * b1) << np.uint64(3)))


def _grown(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2^61 - 1 or 2^64."""
    if len(_powers.get(kind, ((),))[0]) < n:
        size, pair = max(n, 1 << 12), []
        for base in (_OTHER_BASE, pow(_OTHER_BASE, -1, 1 << 64)) if kind == "other" else (_BASE, pow(_BASE, -1, PRIME)):
            if kind == "other":
                x = np.full(size, np.uint64(base), np.uint64)
                x[0] = 1
                x = np.multiply.accumulate(x)
            else:
                x = np.ones(1, np.uint64)
                while len(x) < size:  # the second half is the first times base^half
                    x, base = np.concatenate([x, times(x, np.full(1, base, np.uint64))]), base * base % PRIME
            pair.append(x)
        _powers[kind] = (pair[0], pair[1])
    up, down = _powers[kind]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _prefix(values: np.ndarray, up: np.ndarray, small: bool) -> np.ndarray:
    """Running sums of values times powers modulo 2^61 - 1, from 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    for at in range(0, len(values), _BLOCK):
        x, y = values[at : at + _BLOCK], up[at : at + _BLOCK]
        if small:
            low, high = (y & _LOW) * x, (y >> np.uint64(32)) * x
        else:
            terms = times(x >> np.uint64(3), y)
            low, high = terms & _LOW, terms >> np.uint64(32)
        part = np.cumsum(low)
        part = (part & _P) + (part >> np.uint64(61))
        out[at + 1 : at + 1 + len(x)] = reduced(part + _raised(np.cumsum(high)) + out[at])
    return out


class Spans:
    """Hashes of any spans of a sequence of numbers, from its prefix sums.

    small: the numbers are under 2^9 (bytes); else 64-bit hashes, of which 61 bits count.
    """

    def __init__(self, values: np.ndarray, small: bool = False):
        up, self.down = _grown("prime", len(values) + 1)
        self.sums = _prefix(values, up[:-1], small)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = times(reduced(self.sums[ends] + (_P - self.sums[starts])), self.down[starts])
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class OtherSpans:
    """The same modulo 2^64, with odd random values; to be used beside ``Spans`` only."""

    def __init__(self, values: np.ndarray):
        up, self.down = _grown("other", len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Run:
    """Consecutive texts: rows [first, first + texts) of the batch."""

    first: int
    bounds: np.ndarray  # texts + 1 byte offsets into data
    data: np.ndarray
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    upto: np.ndarray  # texts + 1 word offsets
    hashes: np.ndarray  # of each word
    others: np.ndarray | None  # of each word, by the second polynomial


def byte_runs(texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, byte offsets of the texts, bytes) run by run; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + run_bytes, "right")) - 1)
        yield at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        at = to


def word_runs(texts: pa.Array, fold: bool = False, run_bytes: int = RUN_BYTES, twice: bool = False) -> Iterator[Run]:
    """The words of a text column, hashed; fold: A-Z count as a-z; twice: by both polynomials."""
    for first, bounds, data in byte_runs(texts, run_bytes):
        inside = ~SPACE[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = bounds[1:-1][bounds[1:-1] < len(data)]
        begin[cuts] = inside[cuts]
        cuts = cuts[cuts > 0]
        end[cuts - 1] = inside[cuts - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        hashes = Spans((FOLDED if fold else BYTE)[data], small=True).hashes(starts, ends)
        others = OtherSpans(OTHER[data]).hashes(starts, ends) if twice else None
        yield Run(first, bounds, data, starts, ends, np.searchsorted(starts, bounds), hashes, others)
