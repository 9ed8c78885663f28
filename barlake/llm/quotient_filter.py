"""Counting quotient filters that lose nothing: compact counters of packed n-grams of word numbers.

An n-gram is packed into an integer, and the integer is permuted by an invertible function, which spreads
alike n-grams evenly. The upper bits of what comes out are the quotient, the others the remainder, which
is stored in full: so quotient and remainder together are the n-gram, and two n-grams never share a
counter. A filter is the sorted sequence of its entries: a bit for each quotient (does it occur), a bit
for each entry (does the run of its quotient end here), the remainders, and a byte per counter, where 255
says that the counter follows in a list of its own. The order of the entries does not depend on the
number of quotient bits, so filters of any size are merged as the sorted runs that they are.
"""

from __future__ import annotations

import struct

import numpy as np

_U = np.uint64
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # odd multipliers of splitmix64's finishing steps
_I1, _I2 = (pow(m, -1, 1 << 64) for m in (_M1, _M2))
_HEAD = struct.Struct("<QQQBBB")


def _unshift(x: np.ndarray, by: int) -> np.ndarray:
    """Inverse of ``x ^ (x >> by)``."""
    y = x.copy()
    for step in range(by, 64, by):
        y ^= x >> _U(step)
    return y


def scatter(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(_M1)
    x = (x ^ (x >> _U(27))) * _U(_M2)
    return x ^ (x >> _U(31))


def gather(x: np.ndarray) -> np.ndarray:
    """The inverse of ``scatter``."""
    x = _unshift(x, 31) * _U(_I2)
    x = _unshift(x, 27) * _U(_I1)
    return _unshift(x, 30)


def scatter_wide(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of the 96-bit integers, given as 64 upper and 32 lower bits (three Feistel rounds)."""
    low = low ^ (scatter(high) >> _U(32)).astype(np.uint32)
    high = scatter(high ^ scatter(low.astype(np.uint64) + _U(1)))
    return high, low ^ high.astype(np.uint32)


def gather_wide(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``scatter_wide``."""
    low = low ^ high.astype(np.uint32)
    high = gather(high) ^ scatter(low.astype(np.uint64) + _U(1))
    return high, low ^ (scatter(high) >> _U(32)).astype(np.uint32)


class Entries:
    """Permuted n-grams in ascending order and their counters. ``low`` holds 32 more bits, or is None."""

    __slots__ = ("high", "low", "counts")

    def __init__(self, high: np.ndarray, low: np.ndarray | None, counts: np.ndarray):
        self.high, self.low, self.counts = high, low, counts

    def __len__(self) -> int:
        return len(self.high)

    def slice(self, start: int, stop: int) -> Entries:
        low = None if self.low is None else self.low[start:stop]
        return Entries(self.high[start:stop], low, self.counts[start:stop])


def merge(parts: list[Entries]) -> Entries:
    """Sorted parts as one, counters of equal n-grams added up. The stable sort finds and merges runs."""
    wide = parts[0].low is not None
    high = np.concatenate([p.high for p in parts])
    counts = np.concatenate([p.counts for p in parts])
    if not len(high):
        return Entries(high, parts[0].low, counts)
    if wide:
        low = np.concatenate([p.low for p in parts])
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    else:
        order = np.argsort(high, kind="stable")
        high, low = high[order], None
        new = high[1:] != high[:-1]
    first = np.flatnonzero(np.r_[True, new])
    return Entries(high[first], low[first] if wide else None, np.add.reduceat(counts[order], first))


def count(keys: np.ndarray) -> Entries:
    """Entries of permuted 64-bit n-grams, one counter for each distinct one."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return Entries(keys[first], None, np.diff(np.r_[first, len(keys)]).astype(np.int64))


def encode(entries: Entries) -> bytes:
    """The filter of some entries as bytes."""
    n = len(entries)
    if not n:
        return _HEAD.pack(0, 0, 0, 0, 0, entries.low is not None)
    base = int(entries.high[0])
    offsets = entries.high - _U(base)
    width = int(offsets[-1]).bit_length()
    quotient_bits = min(width, max(n - 1, 0).bit_length())
    rest = width - quotient_bits
    quotients = offsets >> _U(rest) if rest < 64 else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients.astype(np.int64)] = True
    run_ends = np.r_[quotients[1:] != quotients[:-1], True]
    n_bytes = -(-rest // 8)
    remainders = offsets & _U((1 << rest) - 1)
    small = np.minimum(entries.counts - 1, 255).astype(np.uint8)
    parts = [
        _HEAD.pack(n, base, int((small == 255).sum()), quotient_bits, rest, entries.low is not None),
        np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes(),
        remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :n_bytes].tobytes(), small.tobytes(),
        entries.counts[small == 255].astype("<i8").tobytes(),
    ]
    if entries.low is not None:
        parts.append(entries.low.astype("<u4").tobytes())
    return b"".join(parts)


def decode(cells: bytes) -> Entries:
    """The entries of a filter."""
    n, base, escaped, quotient_bits, rest, wide = _HEAD.unpack_from(cells)
    at = _HEAD.size
    if not n:
        return Entries(np.empty(0, np.uint64), np.empty(0, np.uint32) if wide else None, np.empty(0, np.int64))

    def take(size: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(cells, np.uint8, size, at)
        at += size
        return found

    size = 1 << quotient_bits
    occupied = np.flatnonzero(np.unpackbits(take(-(-size // 8)), count=size)).astype(np.uint64)
    run_ends = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(run_ends) - run_ends  # the run that an entry lies in
    n_bytes = -(-rest // 8)
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :n_bytes] = take(n * n_bytes).reshape(n, n_bytes)
    upper = occupied[run] << _U(rest) if rest < 64 else np.zeros(n, np.uint64)
    high = (upper | remainders.view("<u8").ravel()) + _U(base)
    counts = take(n).astype(np.int64) + 1
    counts[counts == 256] = take(8 * escaped).view("<i8")
    return Entries(high, take(4 * n).view("<u4").astype(np.uint32) if wide else None, counts)
