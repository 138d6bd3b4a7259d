"""Counting quotient filters that lose nothing.

A key of two halves of ``half`` bits is permuted by a Feistel network, which
can be undone, and split into a quotient (its leading bits) and the whole
remainder.  A filter keeps its entries sorted; the quotient is not stored but
told by two bitmaps (which quotients occur, where their runs end), so an entry
costs its remainder, two or three bits and a counter of one byte, or nine
where it reaches 255.  Since the remainder is whole, counts are exact and keys
can be read back; since entries are sorted, filters of several shards merge
like sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
# fixed values: odd multipliers of the rounds
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _shift(x: np.ndarray, by: int) -> np.ndarray:
    """x >> by, also by 64 bits."""
    return x >> U(by) if by < 64 else np.zeros_like(x)


def _mixed(x: np.ndarray, k: int, half: int) -> np.ndarray:
    y = (x + U(k + 1)) * U(_ROUNDS[k])
    y ^= y >> U(31)
    y *= U(_ROUNDS[(k + 1) % 4])
    return _shift(y, 64 - half)


def permuted(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for k in range(len(_ROUNDS)):
        left, right = right, left ^ _mixed(right, k, half)
    return left, right


def restored(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for k in reversed(range(len(_ROUNDS))):
        left, right = right ^ _mixed(left, k, half), left
    return left, right


def packed(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Two or three ids of ``bits`` bits (at most 42) as (left, right, half)."""
    if len(ids) == 2:
        return ids[0], ids[1], bits
    half = (3 * bits + 1) // 2
    low = half - bits  # bits of the middle id in the right half
    return (ids[0] << U(2 * bits - half)) | (ids[1] >> U(low)), ((ids[1] & _mask(low)) << U(bits)) | ids[2], half


def unpacked(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    if n == 2:
        return [left, right]
    half = (3 * bits + 1) // 2
    high = 2 * bits - half
    return [left >> U(high), ((left & _mask(high)) << U(half - bits)) | (right >> U(bits)), right & _mask(bits)]


def tallied(left: np.ndarray, right: np.ndarray, half: int, counts: np.ndarray | None = None):
    """Sorted distinct keys with their counts, added up."""
    if half <= 32:
        key = (left << U(half)) | right
        order = None
        if counts is None:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")  # runs that are sorted already are merged
            key = key[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        left, right = key[new] >> U(half), key[new] & _mask(half)
        size = len(key)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        size = len(left)
        new = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))) if size else np.empty(0, np.int64)
        left, right = left[new], right[new]
    if counts is None:
        return left, right, np.diff(np.append(new, size))
    return left, right, np.add.reduceat(counts[order], new) if size else counts[:0]


def _bytes_of(x: np.ndarray, bits: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(len(x), 8)[:, : (bits + 7) // 8].tobytes()


def _from_bytes(data: bytes, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    width = (bits + 7) // 8
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").reshape(n).astype(U)


@dataclass
class QuotientFilter:
    """Counts of the permuted keys of one range: all keys whose left half
    begins with the ``prefix`` bits of ``place``."""

    half: int
    prefix: int
    place: int
    quotient: int  # further leading bits of the left half that the bitmaps tell
    size: int
    occupied: bytes
    run_ends: bytes
    left: bytes  # the rest of the left half
    right: bytes
    counters: bytes
    large: bytes  # counts from 255 on, as 64-bit integers

    @staticmethod
    def build(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, prefix: int) -> QuotientFilter:
        """From sorted distinct permuted keys (at least one) of one range."""
        q = max(0, min(half - prefix, len(left).bit_length() - 1))
        rest = half - prefix - q
        place = int(_shift(left[:1], half - prefix)[0]) if prefix else 0
        quotients = (_shift(left, rest) & _mask(q)).astype(np.int64)
        occupied = np.zeros(1 << q, dtype=bool)
        occupied[quotients] = True
        ends = np.append(quotients[1:] != quotients[:-1], True)
        return QuotientFilter(half, prefix, place, q, len(left), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                              _bytes_of(left & _mask(rest), rest), _bytes_of(right, half),
                              np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes())

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sorted permuted keys (left, right) and their counts."""
        rest = self.half - self.prefix - self.quotient
        occupied = np.unpackbits(np.frombuffer(self.occupied, np.uint8), count=1 << self.quotient)
        ends = np.unpackbits(np.frombuffer(self.run_ends, np.uint8), count=self.size)
        run = np.cumsum(ends) - ends  # the run each entry is in
        quotients = np.flatnonzero(occupied).astype(U)[run]
        high = quotients | (U(self.place) << U(self.quotient) if self.prefix else U(0))
        left = _from_bytes(self.left, self.size, rest) | (high << U(rest) if rest < 64 else U(0))
        counts = np.frombuffer(self.counters, np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(self.large, "<i8")
        return left, _from_bytes(self.right, self.size, self.half), counts


def merged(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted entries of several filters of one range, counts of a key added."""
    parts = [f.entries() for f in filters]
    left, right, counts = (np.concatenate(c) for c in zip(*parts))
    return tallied(left, right, filters[0].half, counts)


def ranged(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, prefix: int) -> list[QuotientFilter]:
    """One filter for each range of ``prefix`` leading bits that holds an entry."""
    if not len(left):
        return []
    places = _shift(left, half - prefix) if prefix else np.zeros(len(left), U)
    starts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    ends = np.append(starts[1:], len(left))
    return [QuotientFilter.build(left[a:b], right[a:b], counts[a:b], half, prefix) for a, b in zip(starts, ends)]
