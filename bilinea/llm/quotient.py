"""Counting quotient filters, lossless ones: compact, sorted, mergeable counters of packed phrases.

A phrase of words with numbers of so many bits is packed into two halves of equal width. A permutation of all such pairs,
four rounds of a Feistel network, spreads them evenly and can be undone. The leading bits of a permuted phrase are its
quotient and all others its remainder; a filter keeps, in order, how many phrases each quotient has, their remainders in
full, and their counters. So nothing is confused with anything else. Leading bits part a filter into slices; the slices
of all shards with the same bits are merged as sorted lists.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Constants of the rounds: odd multipliers.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_CODEC = pa.Codec("zstd")


def squeeze(data: bytes) -> bytes:
    return struct.pack("<q", len(data)) + _CODEC.compress(data, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return _CODEC.decompress(data[8:], struct.unpack("<q", data[:8])[0], asbytes=True)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte: all lowest bytes, then the next ones, as far as there are any."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    return struct.pack("<bq", width, len(values)) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The numbers that stand at a place, and the place after them."""
    width, n = struct.unpack_from("<bq", data, at)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n).T
    return out.view("<u8").ravel(), at + 9 + n * width


def _round(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(max(1, bits // 2)))) * np.uint64(key) + np.uint64(key >> 7)
    return (x ^ (x >> np.uint64(29))) * np.uint64(ROUNDS[0]) >> np.uint64(64 - bits)


def permute(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Halves of `bits` bits, 1 to 64, to others, one to one."""
    for key in ROUNDS:
        left, right = right, left ^ _round(right, key, bits)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(ROUNDS):
        left, right = right ^ _round(left, key, bits), left
    return left, right


def order_of(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Sorts by both halves. Where they do not fit into 64 bits, by as many as fit, and then the few stretches that these
    leave open."""
    if 2 * bits <= 64:
        return np.argsort(left << np.uint64(bits) | right, kind="stable")
    room = 64 - bits
    cut = max(0, int(right.max(initial=0)).bit_length() - room)
    key = (left << np.uint64(room) if room else left) | (right >> np.uint64(cut) if room else np.uint64(0))
    order = np.argsort(key)
    key, rest = key[order], right[order]
    same = key[1:] == key[:-1]
    run = np.concatenate([[0], np.cumsum(~same)]) if len(key) else np.zeros(0, np.int64)
    unlike = np.zeros(int(run.max(initial=-1)) + 1, dtype=bool)
    unlike[run[1:][same & (rest[1:] != rest[:-1])]] = True
    some = np.flatnonzero(unlike[run])
    order[some] = order[some[np.lexsort((rest[some], run[some]))]]
    return order


def firsts(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where, in sorted halves, another pair starts."""
    if not len(left):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))


@dataclass
class Filter:
    """Sorted, permuted phrases without repetition, and their counters. bits: of a half."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray
    bits: int

    @classmethod
    def of(cls, left: np.ndarray, right: np.ndarray, bits: int, even: bool = False) -> tuple[Filter, np.ndarray]:
        """The filter of phrases as they stand, with repetitions, and each one's place in it. even: they are spread evenly
        as they are, hashes for one, and stay so."""
        left, right = (left, right) if even else permute(left, right, bits)
        order = order_of(left, right, bits)
        first = firsts(left[order], right[order])
        counts = np.diff(np.append(first, len(order)))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.repeat(np.arange(len(first)), counts)
        kept = order[first]
        return cls(left[kept], right[kept], counts, bits), place

    def slices(self, slice_bits: int) -> np.ndarray:
        """Where each slice starts, and the end."""
        edges = np.arange(1 << slice_bits, dtype=np.uint64) << np.uint64(self.bits - slice_bits)
        return np.append(np.searchsorted(self.left, edges), len(self.left))

    def packed(self, slice_bits: int, start: int, end: int) -> bytes:
        """A slice: how many phrases each quotient has, the remainders, the counters."""
        rest = self.bits - slice_bits
        more = min(rest, max(0, (end - start).bit_length() - 1))  # about as many quotients as phrases
        low = np.uint64(rest - more)
        left = self.left[start:end] & np.uint64((1 << rest) - 1)
        held = np.bincount((left >> low).astype(np.int64), minlength=1 << more)
        parts = (held, left & np.uint64((1 << int(low)) - 1), self.right[start:end], self.counts[start:end])
        return squeeze(struct.pack("<bb", self.bits, more) + b"".join(map(planes, parts)))

    @classmethod
    def unpacked(cls, data: bytes, slice_bits: int, slice_: int) -> Filter:
        data = unsqueeze(data)
        (bits, more), at, parts = struct.unpack_from("<bb", data), 2, []
        for _ in range(4):
            values, at = unplanes(data, at)
            parts.append(values)
        held, low, right, counts = parts
        rest = bits - slice_bits
        quotient = np.repeat(np.arange(len(held), dtype=np.uint64), held.astype(np.int64))
        left = np.uint64(slice_) << np.uint64(rest) | quotient << np.uint64(rest - more) | low
        return cls(left, right, counts.astype(np.int64), bits)


def merged(filters: list[Filter]) -> tuple[Filter, list[np.ndarray]]:
    """One filter with the sums of the counters, and for each given filter the places of its phrases in it."""
    left, right, counts = (np.concatenate([getattr(f, c) for f in filters]) for c in ("left", "right", "counts"))
    bits = filters[0].bits
    order = order_of(left, right, bits)
    first = firsts(left[order], right[order])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    sums = np.add.reduceat(counts[order], first) if len(first) else counts
    kept = order[first]
    return Filter(left[kept], right[kept], sums, bits), np.split(place, np.cumsum([len(f.left) for f in filters])[:-1])
