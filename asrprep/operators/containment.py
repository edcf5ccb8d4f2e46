"""Which of many short strings occur in the texts of their group: a filter of the strings, one pass over the texts.

Used for corrections that hold other than word characters, which may lie across words and chunks. Joining
them with every place where they could be (any part of a word, the following text, any part of another word) would
shuffle some thirty keys a word. Instead:

1. Every asked string goes into a Bloom filter by (group, string). Its *shape* is noted: the kind of its first character (word or
   other), its number of runs of one kind, the lengths of its first and last run. The filter has a fixed largest size;
   more strings than it can tell apart are taken in several passes.
2. A pass over the texts looks, at each run, at the stretches of the shapes asked for: a tail of this run, whole runs
   behind it, a head of another. The hash of any stretch is the difference of two prefix hashes, so that a look costs the same
   for a long string as for a short one. Stretches that the filter knows are returned as text, once a batch.
3. The caller joins them with the asked strings on (group, string): the result is exact, the filter only saves rows.

No row is keyed by the group alone, so a group with a third of all texts is spread like any other. Only the filter (at
most ``MAX_BITS``), and the distinct run lengths (fewer than the square root of all asked characters for either end) are
collected and broadcast.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27    # 16 MB
BITS_PER_KEY = 12
PROBES = 4
SLICE_CHARS = 2 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they have inverses
_KINDS = np.full(0x110000, -1, np.int8)


def _kind(chars: np.ndarray) -> np.ndarray:
    """1 for characters of words (letters, numbers, underscore), 0 for others."""
    for c in np.unique(chars[_KINDS[chars] < 0]).tolist():
        _KINDS[c] = unicodedata.category(chr(c))[0] in "LN" or c == 0x5F
    return _KINDS[chars]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Texts:
    """Texts of a batch as one array of characters, with their runs and prefix hashes."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        kind = _kind(self.chars)
        edge = np.ones(len(self.chars), bool)
        edge[1:] = kind[1:] != kind[:-1]
        edge[self.bounds[:-1][self.bounds[:-1] < len(self.chars)]] = True
        self.start = np.flatnonzero(edge)
        self.end = np.append(self.start[1:], len(self.chars))
        self.size = self.end - self.start
        self.kind = kind[self.start]
        self.row = np.searchsorted(self.bounds, self.start, side="right") - 1
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _prefix(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self._sums:
            n = len(self.chars)
            up, down = np.full(n, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
            up[:1], down[:1] = 1, 1
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_mix(self.chars.astype(np.uint64) + np.uint64(base)) * np.cumprod(up), out=sums[1:])
            self._sums[base] = sums, np.cumprod(down)
        return self._sums[base]

    def hashes(self, start: np.ndarray, end: np.ndarray, group: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
        sums, down = self._prefix(base)
        return _mix((sums[end] - sums[start]) * down[start] + group.view(np.uint64) + (end - start).astype(np.uint64))


def _place(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The filter's bit for a probe (``bits`` is a power of two)."""
    return (h + (h >> np.uint64(32)) * np.uint64(probe)) & np.uint64(bits - 1)


def _sliced(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = pc.fill_null(pc.utf8_length(b.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, row = np.cumsum(sizes), 0
        while row < b.num_rows:
            to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + SLICE_CHARS, side="right")))
            yield b.slice(row, to - row)
            row = to


def _filter_of(asked: DataFrame, bits: int) -> tuple[np.ndarray, dict[tuple[int, int], tuple[list[int], list[int]]]]:
    """(filter, {(kind of the first run, runs): (lengths of the first run, of the last)}) of (_g, correct)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        shapes: set = set()
        for b in _sliced(batches, 1):
            t = _Texts(b.column(1).to_pylist())
            group = b.column(0).to_numpy(zero_copy_only=False)
            h = t.hashes(t.bounds[:-1], t.bounds[1:], group)
            for p in (_place(h, k, bits) for k in range(PROBES)):
                np.bitwise_or.at(words, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
            first = np.searchsorted(t.row, np.arange(len(t.texts)))
            last = np.searchsorted(t.row, np.arange(len(t.texts)), side="right") - 1
            seen = np.stack([t.kind[first], last - first + 1, t.size[first], t.size[last]], 1)
            for kind, n, x, y in np.unique(seen, axis=0).tolist():
                shapes |= {(kind, n, 0, x), (kind, n, 1, y)}
        at = np.flatnonzero(words)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part].view(np.int64)), pa.nulls(len(part), pa.list_(pa.int64()))],
                                             names=["at", "bits", "shape"])
        kept = sorted(shapes)
        yield pa.RecordBatch.from_arrays([pa.array([-1 - i for i in range(len(kept))], pa.int64()), pa.array([0] * len(kept), pa.int64()),
                                          pa.array([list(s) for s in kept], pa.list_(pa.int64()))], names=["at", "bits", "shape"])

    made = asked.mapInArrow(run, "at long, bits long, shape array<long>")
    found = (made.groupBy(F.when(F.col("shape").isNull(), F.col("at")).alias("at"), "shape").agg(F.bit_or("bits").alias("bits"))).toArrow()
    at = found.column("at").to_numpy(zero_copy_only=False)
    told = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)
    words = np.zeros(bits // 64, np.uint64)
    words[at[told].astype(np.int64)] = found.column("bits").to_numpy(zero_copy_only=False)[told].view(np.uint64)
    shapes: dict = {}
    for s in found.column("shape").to_pylist():
        if s is not None:
            shapes.setdefault((s[0], s[1]), ([], []))[s[2]].append(s[3])
    return words, {k: (sorted(x), sorted(y)) for k, (x, y) in shapes.items()}


def _stretches(t: _Texts, shapes: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, start, end) of all stretches of ``t`` with an asked shape."""
    for (kind, n), (heads, tails) in shapes.items():
        first = np.flatnonzero(t.kind == kind)
        if n == 1:
            for size in heads:
                able = first[t.size[first] >= size]
                times = t.size[able] - size + 1
                start = np.repeat(t.start[able], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                yield np.repeat(t.row[able], times), start, start + size
            continue
        first = first[first + n - 1 < len(t.start)]
        first = first[t.row[first] == t.row[first + n - 1]]
        for x in heads:
            able = first[t.size[first] >= x]
            room = t.size[able + n - 1]
            for y in tails:
                one = able[room >= y]
                yield t.row[one], t.end[one] - x, t.start[one + n - 1] + y


def candidates(texts: DataFrame, asked: DataFrame, asked_rows: int, group_col: str, text_col: str = "_t", max_bits: int = MAX_BITS) -> DataFrame:
    """``(group_col, correct)``: strings that occur in ``texts`` of the group, each at least once, among them all of ``asked``
    (``group_col``, correct; not empty) that do. ``texts`` and ``asked`` are read once a pass: pin them."""
    sc = texts.sparkSession.sparkContext
    hashed = asked.select(F.xxhash64(group_col).alias("_g"), "correct")
    rows = texts.select(F.xxhash64(group_col).alias("_g"), F.col(text_col).alias("_t"), F.col(group_col))
    kind = rows.schema[group_col].dataType.simpleString()
    passes = max(1, -(-asked_rows * BITS_PER_KEY // max_bits))
    bits = min(max_bits, 1 << max(16, (asked_rows * BITS_PER_KEY).bit_length()))
    out = []
    for k in range(passes):
        part = hashed if passes == 1 else hashed.where(F.pmod(F.xxhash64("_g", "correct"), F.lit(passes)) == k)
        words, shapes = _filter_of(part, bits)
        shared = sc.broadcast((words, shapes))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, shapes = shared.value
            for b in _sliced(batches, 1):
                t = _Texts(b.column(1).to_pylist())
                group, names = b.column(0).to_numpy(zero_copy_only=False), b.column(2)
                found = [np.zeros((0, 3), np.int64)]
                for row, start, end in _stretches(t, shapes):
                    h = t.hashes(start, end, group[row])
                    for k in range(PROBES):
                        p = _place(h, k, bits)
                        hit = (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
                        h, row, start, end = h[hit], row[hit], start[hit], end[hit]
                    if len(row):
                        found.append(np.stack([row, start, end], 1))
                hits = np.concatenate(found)
                if not len(hits):
                    continue
                # one of equal strings of a group: equal in two independent hashes
                h = [t.hashes(hits[:, 1], hits[:, 2], group[hits[:, 0]], base) for base in _BASES]
                order = np.lexsort(h)
                new = np.ones(len(order), bool)
                new[1:] = (h[0][order][1:] != h[0][order][:-1]) | (h[1][order][1:] != h[1][order][:-1])
                hits = hits[order[new]]
                rows_of = hits[:, 0]
                strings = [t.texts[r][s:e] for r, s, e in zip(rows_of.tolist(), (hits[:, 1] - t.bounds[rows_of]).tolist(),
                                                             (hits[:, 2] - t.bounds[rows_of]).tolist())]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(rows_of)), pa.array(strings, pa.string())], names=[group_col, "correct"])

        out.append(rows.mapInArrow(run, f"`{group_col}` {kind}, correct string"))
    return reduce(DataFrame.unionByName, out)
