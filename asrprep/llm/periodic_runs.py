"""Periodic runs of words by dyadic square catching, and texts with their repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``max(min_words, 2 q)`` words that can't be made longer on either side.

Method (after Leung, Peng and Ting's online detection of squares): the words so far are cut into blocks of
``s`` words for every power of two ``s``. A completed block gets a catcher. Each word that is appended
afterwards moves the catcher on: ``p`` words later it compares the text's last ``s`` words with its block. If they
are equal, the words around may repeat at distance ``p``; how far they do, on both sides, is found by
comparing words, and a stretch that repeats for ``p`` words at least is a square, which merges with all
squares of the same stretch into one run. The catchers of blocks of ``s`` words watch the periods for which a
run must hold a whole block in what repeats (``2 s - 1`` words of it do), about ``2 s`` periods each, so a text of n words
takes in the order of ``n log n`` comparisons.

Catchers compare names of word windows, where the name of a window of 2s words comes from those of its
halves; equal names are only a hint, the words themselves are compared before anything is reported. The
appended words of all catchers of a level are taken together as array operations, and rows of about a megabyte
of an Arrow batch are one stream of words, in which a separator that occurs once stands between rows. No shuffle; a
text is one task's, its memory some 60 bytes a word.

Defined cases: a null or empty text has no words and no runs; very long texts are taken alone and whole; repeated
rows and ids each give a row; an empty table gives an empty table; other columns are not read. Of two
stretches that are equal only the smallest period is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.llm.wordcols import slices, space_table, words

#: Comparisons held at once.
TILE = 1 << 18
#: Bytes of text taken as one stream (a longer text alone): its arrays take some 25 times as much.
STREAM_BYTES = 1 << 20
#: Words compared for all hits together before the remaining ones are followed one by one.
TRIAL = 12
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _levels(longest: int, min_words: int) -> Iterator[tuple[int, int, int]]:
    """(s, first, last): ranges of periods, ascending, with the block size whose catchers watch them."""
    def size(p: int) -> int:
        repeated = max(min_words - p, p)  # words equal to those p later, in the shortest run of the period
        return 1 << (((repeated + 1) // 2).bit_length() - 1)

    first, top = 1, longest // 2
    while first <= top:
        s, last = size(first), first
        if 2 * first >= min_words:  # from here on sizes only grow
            last = min(top, 4 * s - 2)
        else:
            while last < top and 2 * (last + 1) <= min_words and size(last + 1) == s:
                last += 1
        yield s, first, last
        first = last + 1


def _equal_for(t: np.ndarray, x: int, y: int, step: int) -> int:
    """How many words from x and y on (``step`` 1) or before them (-1) are equal; x < y, both in one row."""
    n, size = 0, 16
    while True:
        if step > 0:
            room = min(size, len(t) - y - n)
            same = t[x + n:x + n + room] == t[y + n:y + n + room]
        else:
            room = min(size, x - n)
            same = (t[x - n - room:x - n] == t[y - n - room:y - n])[::-1]
        stop = int(same.argmin()) if room else 0
        if room == 0 or not same[stop]:
            return n + stop
        n, size = n + room, size * 2


class _Runs:
    """Runs found so far, and for every word the one that reaches farthest."""

    def __init__(self, t: np.ndarray, min_words: int):
        self.t, self.min_words, self.found = t, min_words, {}
        self.period, self.reach = np.zeros(len(t), np.int32), np.zeros(len(t), np.int64)

    def known(self, a, p, s):
        """Whether the block at ``a`` and its copy lie in a run whose period divides ``p``: that run, then, is theirs."""
        q = self.period[a]
        return (q > 0) & (p % np.maximum(q, 1) == 0) & (a + p + s <= self.reach[a])

    def square(self, a: int, p: int) -> None:
        right, left = _equal_for(self.t, a, a + p, 1), _equal_for(self.t, a, a + p, -1)
        if left + right < max(self.min_words - p, p):
            return
        lo, hi = a - left, a + right + p
        if self.found.setdefault((lo, hi), p) == p:
            longer = self.reach[lo:hi] < hi
            self.period[lo:hi][longer] = p
            self.reach[lo:hi][longer] = hi


def _hits(names: np.ndarray, blocks: np.ndarray, s: int, first: int, last: int, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block starts, periods) where a catcher finds its block again, ascending by period."""
    own, p = names[blocks], first
    while p <= last:
        alive = blocks + p + s <= ends  # the rest of the row is too short for the others
        if not alive.all():
            blocks, own, ends = blocks[alive], own[alive], ends[alive]
        if not len(blocks):
            return
        steps = np.arange(p, min(last, p + max(1, TILE // len(blocks)) - 1) + 1)
        at = blocks[None, :] + steps[:, None]
        np.minimum(at, len(names) - 1, out=at)
        which, block = np.nonzero(names[at] == own[None, :])
        yield blocks[block], steps[which]
        p = int(steps[-1]) + 1


def find_runs(t: np.ndarray, rows: np.ndarray, min_words: int = 12) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in the stream ``t``, ascending; row i lies from rows[i, 0] up to rows[i, 1], and
    the words between rows (one at least, and one before the first) occur nowhere else."""
    size = rows[:, 1] - rows[:, 0]
    runs = _Runs(t, min_words)
    names = {1: (t.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)}
    for s, first, last in _levels(int(size.max(initial=0)), min_words):
        while s not in names:  # sizes fall by one step at most, and only once
            k = max(names)
            now = names[k][:-k] * np.uint64(0x94D049BB133111EB) + (names[k][k:] ^ (names[k][k:] >> np.uint64(29)))
            names[2 * k] = (now ^ (now >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        for k in [k for k in names if k < s // 2]:
            del names[k]
        wide = rows[size >= max(min_words, 2 * first)]
        lo, count = -(-wide[:, 0] // s), wide[:, 1] // s - -(-wide[:, 0] // s)
        wide, lo, count = wide[count > 0], lo[count > 0], count[count > 0]
        if not len(lo):
            continue
        of = np.repeat(np.arange(len(lo)), count)
        blocks = (lo[of] + np.arange(len(of)) - (np.cumsum(count) - count)[of]) * s
        for a, p in _hits(names[s], blocks, s, first, last, wide[of, 1]):
            new = ~runs.known(a, p, s)
            a, p = a[new], p[new]
            # words right and left of the block, for all hits at once
            right, left = np.full(len(a), s), np.zeros(len(a), np.int64)
            on_right, on_left = np.ones(len(a), bool), np.ones(len(a), bool)
            for _ in range(TRIAL):
                on_right &= t[np.minimum(a + right, len(t) - 1)] == t[np.minimum(a + right + p, len(t) - 1)]
                on_left &= t[a - left - 1] == t[a - left - 1 + p]
                right, left = right + on_right, left + on_left
            good = on_right | on_left | (right + left >= np.maximum(min_words - p, p))
            for x, y in zip(a[good].tolist(), p[good].tolist()):
                if not runs.known(x, y, s):
                    runs.square(x, y)
    return sorted((lo, hi, p) for (lo, hi), p in runs.found.items())


def _of_slice(part: pa.RecordBatch, min_words: int, table: np.ndarray) -> pa.RecordBatch:
    flat, offsets = words(part.column(1), table)
    n = part.num_rows
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int32)
    # the stream: separator, row, separator, row, ..., separator
    row_of = np.repeat(np.arange(n), np.diff(offsets))
    t = np.empty(len(ids) + n + 1, np.int32)
    at = np.arange(len(ids)) + row_of + 1
    t[at] = ids
    gaps = np.concatenate([offsets[:-1] + np.arange(n), [len(t) - 1]])
    t[gaps] = -1 - np.arange(n + 1)
    rows = np.stack([gaps[:-1] + 1, gaps[1:]], 1)
    found = np.array(find_runs(t, rows, min_words), np.int64).reshape(-1, 3)

    dropped = np.zeros(len(t), bool)
    for lo, hi, p in found.tolist():
        dropped[lo + p:hi] = True
    keep = ~dropped[at]
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    collapsed = pc.binary_join(pa.ListArray.from_arrays(kept_before[offsets].astype(np.int32), flat.filter(pa.array(keep))), " ")
    row = np.searchsorted(rows[:, 1], found[:, 0], side="right")
    values = pa.StructArray.from_arrays([pa.array(found[:, 0] - rows[row, 0] if len(found) else found[:, 0]),
                                         pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], fields=list(RUN))
    lists = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), values)
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets), pa.int64()), lists, collapsed],
                                      names=["doc_id", "n_words", "runs", "collapsed"])


def _of_batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    table = space_table()
    for batch in batches:
        for part in slices(batch, 1, STREAM_BYTES):
            yield _of_slice(part, min_words, table)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period, by start and period, words from
    0) and collapsed (the words joined by one space, of each run only the first period)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    return rows.mapInArrow(lambda batches: _of_batches(batches, min_words), f"doc_id {kind}, n_words long, "
                           "runs array<struct<start: long, length: long, period: long>>, collapsed string")
