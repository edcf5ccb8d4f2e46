"""Best-fit-decreasing packing of token ids into fixed rows.

Texts are tokenised, an end id follows each. Documents longer than a row are cut, without loss, into
full rows and a remainder. The pieces of a block are placed longest first, each into the row
with the least room that still holds it, found by a segment tree over remaining capacities. A block
is what one task reads, up to ``block_tokens``; nothing is shuffled. Each row of the
result is one packed row: its ids as little-endian unsigned integers padded to ``length``, the cumulative segment
lengths, the document and the start of every segment, and the offsets at which positions restart.

Defined cases: a null text counts as empty and still has its end id; repeated rows are packed each;
an empty table gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.llm.tokens import byte_encoding, tokenizer_path

LENGTH = 4096
END_ID = 50256
BLOCK_TOKENS = 4 << 20
_READ_CHARS = 4 << 20


class RoomTree:
    """Rows by remaining capacity; the smallest capacity at or above a size in log(length) steps."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.base + room
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the tightest row for ``size``, or None."""
        i = self.base + size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.base
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every size is between 1 and ``length``."""
    tree, rows = RoomTree(length), []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = tree.take(sizes[k])
        if found is None:
            found = (length, len(rows))
            rows.append([])
        rows[found[1]].append(k)
        if found[0] > sizes[k]:
            tree.put(found[0] - sizes[k], found[1])
    return rows


def pack(docs: DataFrame, ranks: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Columns sequence_id, n_tokens, doc_ids, starts, cu_seqlens, position_resets, ids (binary)."""
    path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    id_type = docs.schema[id_col].dataType.simpleString()
    out = (f"sequence_id long, n_tokens int, doc_ids array<{id_type}>, starts array<long>, cu_seqlens array<int>, "
           "position_resets array<int>, ids binary")

    def rows_of(pieces: list, first: int) -> list[list]:
        cols: list[list] = [[] for _ in range(7)]
        for r, members in enumerate(best_fit([len(p[2]) for p in pieces], length)):
            ids = np.full(length, end_id, "<u4" if end_id > 65535 else "<u2")
            cu = np.concatenate([[0], np.cumsum([len(pieces[k][2]) for k in members])]).tolist()
            for k, at in zip(members, cu):
                ids[at:at + len(pieces[k][2])] = pieces[k][2]
            for c, v in zip(cols, (first + r, cu[-1], [pieces[k][0] for k in members],
                                   [pieces[k][1] for k in members], cu, cu[:-1], ids.tobytes())):
                c.append(v)
        return cols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, next_id = byte_encoding(path), TaskContext.get().partitionId() << 32
        pieces: list = []
        held = 0
        kind = np.uint32 if end_id > 65535 else np.uint16

        def flush():
            nonlocal pieces, held, next_id
            cols = rows_of(pieces, next_id)
            next_id += len(cols[0])
            pieces, held = [], 0
            types = [pa.int64(), pa.int32(), pa.list_(id_arrow), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        id_arrow = None
        for big in batches:
            id_arrow = big.column(0).type
            step = max(1, int(big.num_rows * _READ_CHARS / max(1, big.nbytes)))
            for at in range(0, big.num_rows, step):
                b = big.slice(at, step)
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.array(enc.encode_ordinary(text or "") + [end_id], kind)
                    for start in range(0, len(ids), length):
                        pieces.append((doc_id, start, ids[start:start + length]))
                    held += len(ids)
                    if held >= block_tokens:
                        yield flush()
        if pieces:
            yield flush()

    names = [x.strip().split()[0] for x in out.split(", ")]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, out)


def id_matrix(row_ids: list[bytes], length: int = LENGTH, dtype: str = "<u2") -> np.ndarray:
    """The packed rows as one matrix."""
    return np.frombuffer(b"".join(row_ids), dtype).reshape(-1, length)
