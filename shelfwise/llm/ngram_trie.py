"""Elias-Fano n-gram tries: compact memory-mapped levels and successor search."""

from __future__ import annotations

import os

import numpy as np

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)       # place of the k-th set bit of a byte
for _byte in range(256):
    for _k, _bit in enumerate([b for b in range(8) if _byte >> b & 1]):
        _SELECT[_byte, _k] = _bit


RUN, SPREAD = 1 << 16, 16        # values looked up at a time; high bits decoded for each at most


def mapped(folder: str, name: str, values: np.ndarray) -> np.ndarray:
    """The array, written to ``folder`` and memory-mapped."""
    path = os.path.join(folder, f"{name}.npy")
    np.save(path, values)
    return np.load(path, mmap_mode="r") if len(values) else values


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit values.

    The low bits are packed one after another; the high bits are a unary code of
    their gaps, with the number of zeros before each 64-bit word as directory.
    """

    def __init__(self, values: np.ndarray, folder: str, name: str):
        values = np.ascontiguousarray(values, dtype=np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.low = min(56, max(0, (top // max(1, self.n)).bit_length() - 1))
        high = (values >> np.uint64(self.low)).astype(np.int64)
        self.buckets = int(high[-1]) + 1 if self.n else 0
        ones = np.zeros(-(-(self.n + self.buckets + 1) // 64) * 64, np.uint8)
        ones[high + np.arange(self.n)] = 1
        packed = np.packbits(ones, bitorder="little")
        zeros = (64 - _POP[packed].reshape(-1, 8).sum(1)).astype(np.int64)
        self.high = mapped(folder, f"{name}-high", packed)
        self.before = mapped(folder, f"{name}-zeros", np.concatenate([[0], np.cumsum(zeros)]).astype(np.int64))
        self.bits = mapped(folder, f"{name}-low", self._pack(values))

    def _pack(self, values: np.ndarray) -> np.ndarray:
        parts, shifts = [], np.arange(self.low, dtype=np.uint64)
        for at in range(0, self.n if self.low else 0, 1 << 16):      # a multiple of 8 values: whole bytes
            part = (values[at:at + (1 << 16), None] >> shifts) & np.uint64(1)
            parts.append(np.packbits(part.astype(np.uint8).ravel(), bitorder="little"))
        return np.concatenate([*parts, np.zeros(8, np.uint8)])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low                       # 56 bits at most, from any bit of a byte: within eight bytes
        words = np.ndarray(len(self.bits) - 7, "<u8", self.bits, strides=(1,))
        return (words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the high bits."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left, at = k - self.before[word], word * 8
        done, out = np.zeros(len(k), bool), np.zeros(len(k), np.int64)
        for step in range(8):
            byte = ~self.high[at + step]
            count = _POP[byte].astype(np.int64)
            here = ~done & (left < count)
            out[here] = (at[here] + step) * 8 + _SELECT[byte[here], left[here]]
            done |= here
            left = np.where(done, left, left - count)
        return out

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i`` (select on the ones by search over the zeros)."""
        low, high = np.zeros(len(i), np.int64), np.full(len(i), self.buckets, np.int64)
        while (low < high).any():                # smallest bucket that ends after i
            mid = (low + high) >> 1
            over = self._select0(np.minimum(mid, self.buckets - 1)) - np.minimum(mid, self.buckets - 1) > i
            high, low = np.where((low < high) & over, mid, high), np.where((low < high) & ~over, mid + 1, low)
        return (low.astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Position of the first element not below each value (n where none is)."""
        values = np.asarray(values, np.uint64)
        if not self.n:
            return np.zeros(len(values), np.int64)
        bucket = (values >> np.uint64(self.low))
        inside = bucket < np.uint64(self.buckets)
        b = np.where(inside, bucket, 0).astype(np.int64)
        start = np.where(b > 0, self._select0(np.maximum(b - 1, 0)) + 1 - b, 0)
        end = self._select0(b) - b
        want, stop = values & np.uint64((1 << self.low) - 1), end.copy()
        while (start < stop).any():
            mid = (start + stop) >> 1
            below = self._low(np.minimum(mid, self.n - 1)) < want
            open_ = start < stop
            start, stop = np.where(open_ & below, mid + 1, start), np.where(open_ & ~below, mid, stop)
        return np.where(inside, start, self.n)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, -1 where it is not in the sequence."""
        values = np.asarray(values, np.uint64)
        out = np.full(len(values), -1)
        if not self.n:
            return out
        if (values[1:] < values[:-1]).any():
            order = np.argsort(values, kind="stable")
            out[order] = self.find(values[order])
            return out
        for a in range(0, len(values), RUN):
            out[a:a + RUN] = self._find_run(values[a:a + RUN])
        return out

    def _find_run(self, values: np.ndarray) -> np.ndarray:
        """Positions of ascending values: the stretch of the sequence that they span is
        decoded once, unless it is far longer than they are many."""
        b = np.minimum(values[[0, -1]] >> np.uint64(self.low), np.uint64(self.buckets - 1)).astype(np.int64)
        ends = self._select0(np.array([max(b[0] - 1, 0), b[1]]))
        first, last = int(ends[0]) + 1 if b[0] else 0, int(ends[1])
        if last - first > SPREAD * len(values):
            return self._probe(values)
        start = first - int(b[0])
        held = self._decode(first, last, start)
        if not len(held):
            return np.full(len(values), -1)
        at = np.searchsorted(held, values)
        return np.where(held[np.minimum(at, len(held) - 1)] == values, start + at, -1)

    def _decode(self, first: int, last: int, start: int) -> np.ndarray:
        """The values whose high bits lie at ``first`` to ``last``, from position ``start`` on."""
        bits = np.unpackbits(self.high[first >> 3:(last >> 3) + 1], bitorder="little")
        ones = np.flatnonzero(bits[first & 7:(first & 7) + last - first])
        at = np.arange(start, start + len(ones))
        return ((ones + first - at).astype(np.uint64) << np.uint64(self.low)) | self._low(at)

    def _probe(self, values: np.ndarray) -> np.ndarray:
        """Positions of any values, each searched inside its bucket."""
        at = self.successor(values)
        there = at < self.n
        probe = np.minimum(at, self.n - 1)
        # equal high bits hold by the bucket searched, or the element lies in a later one
        same = there & (self._low(probe) == (values & np.uint64((1 << self.low) - 1)))
        same &= self._bucket_of(probe, values)
        return np.where(same, at, -1)

    def _bucket_of(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Whether the element at a position lies in the bucket of the value."""
        b = (values >> np.uint64(self.low))
        inside = b < np.uint64(self.buckets)
        b = np.where(inside, b, 0).astype(np.int64)
        return inside & (at < self._select0(b) - b)


class Quantiser:
    """Log10 values from ``floor`` to 0 in 65,535 even steps; code 0 means none."""

    def __init__(self, floor: float = -16.0):
        self.floor = floor

    def encode(self, logs: np.ndarray) -> np.ndarray:
        return (np.rint((np.clip(logs, self.floor, 0) / self.floor) * 65534) + 1).astype(np.uint16)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.float64) - 1) / 65534 * self.floor


class Trie:
    """One level below its contexts: for each context its successors, with a value each.

    Successors may be hashes, which are remapped to ranks in the level's
    vocabulary, or small numbers already (places among the successors of a shorter
    context).  A context's range is made monotone by its rank, so that one sequence
    holds the whole level and a search looks inside the context only.
    """

    def __init__(self, contexts, pointers, successors, values, folder: str, vocabulary=None):
        """``successors`` are ranks in the vocabulary (or the numbers themselves), in
        order of contexts; ``pointers`` the starts of the contexts' ranges."""
        self.contexts = EliasFano(contexts, folder, "contexts")
        self.pointers = EliasFano(pointers, folder, "pointers")
        self.vocabulary = None if vocabulary is None else EliasFano(vocabulary, folder, "vocabulary")
        successors = np.asarray(successors).astype(np.int64)
        self.width = (int(successors.max()) if len(successors) else 0) + 1
        owner = np.repeat(np.arange(len(contexts)), np.diff(np.append(pointers, len(successors))))
        self.level = EliasFano(owner * self.width + successors, folder, "successors")
        self.values = mapped(folder, "values", values)

    def children(self, context: np.ndarray) -> np.ndarray:
        """Number of successors of the contexts at these ranks."""
        end = np.where(context + 1 < self.contexts.n, self.pointers[np.minimum(context + 1, self.contexts.n - 1)],
                       np.uint64(self.level.n))
        return (end - self.pointers[context]).astype(np.int64)

    def search(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Places of (context rank, successor) in the level, -1 where there is none."""
        return self.search_ranks(context, self.ranks(successor))

    def ranks(self, successor: np.ndarray) -> np.ndarray:
        """Ranks of successors in the vocabulary (-1: not there), or the numbers themselves."""
        return successor.astype(np.int64) if self.vocabulary is None else self.vocabulary.find(successor)

    def search_ranks(self, context: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """As ``search``, by the successors' ranks; fastest in order of (context, rank)."""
        known = (context >= 0) & (rank >= 0) & (rank < self.width)
        at = self.level.find(np.maximum(context, 0) * self.width + np.clip(rank, 0, self.width - 1))
        return np.where(known, at, -1)
