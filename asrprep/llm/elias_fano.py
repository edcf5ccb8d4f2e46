"""Elias-Fano sequences and an n-gram trie of them, in numpy.

A trie keeps one level per n-gram length. A level is the monotone sequence of its word ids, where the
ids below each context are raised by a running base so that the whole level never falls, and the
monotone pointers at which each context's successors begin; both are Elias-Fano coded. Values are
quantised to one byte through a code book per level. A query walks from the first word down: the
pointers give a context's range, and a successor search inside that range finds the next word,
relative to the context.

``save`` lays all arrays out in one file and ``open`` maps it, so only the pages that are searched are read.
"""

from __future__ import annotations

import json

import numpy as np


#: The code of an n-gram that is not in a trie.
UNSEEN = 255


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits as a unary bit vector."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self._starts: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        width = max(0, (top // max(1, n)).bit_length() - 1)
        high = (v >> np.uint64(width)).astype(np.int64)
        bits = np.zeros((int(high[-1]) if n else 0) + n + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        shifts = np.arange(width, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little") if width \
            else np.zeros(0, np.uint8)
        return cls(n, width, low, np.packbits(bits, bitorder="little"))

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        first = at * self.width
        for k in range(self.width):
            bit = first + k
            out |= ((self.low[bit >> 3] >> (bit & 7)) & 1).astype(np.int64) << k
        return out

    def _buckets(self) -> np.ndarray:
        """Number of elements below each value of the high bits (selects of the zeros)."""
        if self._starts is None:
            zeros = np.flatnonzero(np.unpackbits(np.asarray(self.high), bitorder="little") == 0)
            self._starts = np.concatenate([[0], zeros - np.arange(len(zeros))])
        return self._starts

    def get(self, at: np.ndarray) -> np.ndarray:
        starts = self._buckets()
        high = np.searchsorted(starts, at, "right") - 1
        return (high << self.width) | self._lows(at)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of the first element not below each value (its successor), ``n`` if there is none."""
        starts = self._buckets()
        values = np.asarray(values, np.int64)
        high = values >> self.width
        last = len(starts) - 2
        lo = np.where(high > last, self.n, starts[np.minimum(high, last)])
        hi = np.where(high > last, self.n, starts[np.minimum(high, last) + 1])
        want = values & ((1 << self.width) - 1)
        while True:  # binary search by low bits inside each bucket
            live = np.flatnonzero(lo < hi)
            if not len(live):
                return np.minimum(lo, self.n)
            mid = (lo[live] + hi[live]) >> 1
            below = self._lows(mid) < want[live]
            lo[live] = np.where(below, mid + 1, lo[live])
            hi[live] = np.where(below, hi[live], mid)


def quantise(values: np.ndarray, levels: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """(codes, code book): bins of equal width, each at the mean of its values."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(levels)
    least, span = values.min(), max(float(np.ptp(values)), 1e-12)
    codes = np.minimum(((values - least) / span * levels).astype(np.int64), levels - 1)
    counts = np.bincount(codes, minlength=levels)
    book = np.bincount(codes, weights=values, minlength=levels) / np.maximum(counts, 1)
    return codes.astype(np.uint8), book


class Trie:
    """Levels of (ids, pointers from the level above, codes, code book)."""

    def __init__(self, universe: int, levels: list[dict]):
        self.universe, self.levels = universe, levels

    @classmethod
    def build(cls, grams: np.ndarray, values: np.ndarray, universe: int) -> "Trie":
        """``grams``: distinct n-grams, n columns of ids below ``universe``, in lexicographic order;
        ``values`` of the full n-grams. Shorter levels hold their prefixes."""
        order, levels = grams.shape[1], []
        parent_of_row = np.zeros(len(grams), np.int64)
        for k in range(order):
            new = np.ones(len(grams), bool)
            if len(grams):
                new[1:] = (grams[1:, k] != grams[:-1, k]) | (parent_of_row[1:] != parent_of_row[:-1])
            rows = np.flatnonzero(new)
            parent, ids = parent_of_row[rows], grams[rows, k].astype(np.int64)
            parents = int(parent_of_row[-1]) + 1 if len(grams) else 0
            levels.append({"ids": EliasFano.of(parent * universe + ids),
                           "begins": EliasFano.of(np.searchsorted(parent, np.arange(parents + 1)))})
            parent_of_row = np.cumsum(new) - 1
        codes, book = quantise(values)
        levels[-1] |= {"codes": codes, "book": book}
        return cls(universe, levels)

    @property
    def book(self) -> np.ndarray:
        return self.levels[-1]["book"]

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Value of each n-gram, NaN where it is not in the trie."""
        codes = self.find_codes(grams)
        return np.where(codes == UNSEEN, np.nan, np.asarray(self.book)[np.minimum(codes, len(self.book) - 1)])

    def find_codes(self, grams: np.ndarray) -> np.ndarray:
        """Code of each n-gram, ``UNSEEN`` where it is not in the trie."""
        node, found = np.zeros(len(grams), np.int64), np.ones(len(grams), bool)
        for k, level in enumerate(self.levels):
            ids, begins = level["ids"], level["begins"]
            if not ids.n:
                return np.full(len(grams), UNSEEN, np.uint8)
            begin, end = begins.get(node), begins.get(node + 1)
            want = node * self.universe + grams[:, k]
            at = ids.find(want)
            inside = (at >= begin) & (at < end)
            safe = np.where(inside, at, 0)
            found &= inside & (ids.get(safe) == want)
            node = np.where(found, safe, 0)
        return np.where(found, np.asarray(self.levels[-1]["codes"])[node], UNSEEN).astype(np.uint8)

    def save(self, path: str) -> None:
        head, parts, at = {"universe": self.universe, "levels": []}, [], 0
        for level in self.levels:
            kept = {}
            for name, x in level.items():
                arrays = x.arrays() if isinstance(x, EliasFano) else [x]
                places = []
                for a in arrays:
                    pad = -at % 8
                    parts.append(b"\0" * pad + a.tobytes())
                    places.append([at + pad, a.dtype.str, len(a)])
                    at += pad + a.nbytes
                kept[name] = [places, [x.n, x.width] if isinstance(x, EliasFano) else None]
            head["levels"].append(kept)
        text = json.dumps(head).encode()
        with open(path, "wb") as f:
            f.write(len(text).to_bytes(8, "little") + text.ljust(-(-len(text) // 8) * 8))
            for p in parts:
                f.write(p)

    @classmethod
    def open(cls, path: str) -> "Trie":
        whole = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(whole[:8].tobytes(), "little")
        head, base = json.loads(whole[8:8 + size].tobytes()), 8 + -(-size // 8) * 8

        def array(place):
            at, kind, n = place
            return whole[base + at:base + at + n * np.dtype(kind).itemsize].view(kind)

        levels = [{name: EliasFano(*shape, *map(array, places)) if shape else array(places[0])
                   for name, (places, shape) in level.items()} for level in head["levels"]]
        return cls(head["universe"], levels)
