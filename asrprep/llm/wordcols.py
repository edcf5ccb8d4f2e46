"""Words of whole Arrow columns of texts, found with array operations instead of a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from asrprep.llm.exprs import WS

#: Bytes of text taken at a time; a longer text is taken alone.
SLICE_BYTES = 8 << 20


def byte_table(separators: bytes, lower: bool = False) -> np.ndarray:
    """What each byte of a text becomes: 0 for a separator, else itself. On demand A-Z come in lower case first. A zero
    byte that is no separator would be taken for one: see ``NUL``."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[np.isin(table, np.frombuffer(separators, np.uint8))] = 0
    return table


#: Byte that stands for U+0000 in a text while words are told apart; it never occurs in UTF-8.
NUL = 0xFF


def space_table() -> np.ndarray:
    table = byte_table(WS.encode())
    table[0] = NUL
    return table


def slices(batch: pa.RecordBatch, text_col: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs of at most ``size`` bytes of text, or of one row."""
    n = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(n), 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + size
        to = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def words(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, offsets): words of row i are those from offsets[i] up to offsets[i + 1]; null has none."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    raw = table[raw]
    inside = raw != 0
    edge = np.concatenate([inside[:1], inside[1:] & ~inside[:-1]])  # first byte of a word
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge[begins] = inside[begins]  # a text's first byte continues no word of the text before
    starts = np.flatnonzero(edge)
    kept = np.concatenate([[0], np.cumsum(inside)])
    lengths = np.concatenate([kept[starts], kept[-1:]]).astype(np.int32)
    joined = raw[inside]
    joined[joined == NUL] = 0
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(lengths.tobytes()), pa.py_buffer(joined.tobytes()))
    return flat, np.searchsorted(starts, offsets, side="left")
