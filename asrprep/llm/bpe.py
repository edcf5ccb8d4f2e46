"""Byte-level BPE in Spark higher-order functions.

1. Texts are cut into matches of the vocabulary's pattern ("words"). Each chunk of documents sends
   its distinct words to their shards, and each shard holds the distinct words of the whole corpus
   that hash to it (``chunks``), so a word is encoded once however often it occurs.
2. A projection folds the ranked merges over the byte arrays of a shard's words: the ids of the
   pieces and the ranks of neighbouring pairs are the state, each step joins the pair of lowest rank,
   leftmost first, and only the two ranks beside it are looked up anew. The rank map is a literal.
   The same projection decodes: the binary pieces of the ids, from a literal, are concatenated.
3. Ids and decoded bytes go back to the chunks, whose documents join them by word number.

A fold takes steps quadratic in a word's length, so words over ``LONG_WORD`` bytes are encoded in step 3
by the ``tiktoken`` library with the same ranks: the same ids.

Defined cases: a null text counts as empty: no tokens, hashes of nothing; repeated rows are encoded
alike; an empty table gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm import chunks
from asrprep.llm.exprs import let
from asrprep.llm.tokens import byte_encoding, read_ranks, splitter, tokenizer_path

BUCKETS = 1 << 15
LONG_WORD = 512
_NEVER = 65536


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as one constant column, which Spark folds from JSON text to a literal.

    ``bytes``: id of each single byte. ``first``: rank of each pair of bytes, at 256 * a + b.
    ``pairs``: from a pair of ids to the rank of their concatenation, for every way to cut a token in
    two tokens. Buckets by hash hold key, rank, key, rank, ...; keys lie above all ranks.
    """
    import xxhash

    first = [_NEVER] * 65536
    pairs: list[list[int]] = [[] for _ in range(BUCKETS)]
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is None or b is None:
                continue
            if len(token) == 2:
                first[256 * token[0] + token[1]] = r
            k = 65536 * (a + 1) + b
            pairs[xxhash.xxh64_intdigest(k.to_bytes(8, "little"), 42) & (BUCKETS - 1)] += [k, r]
    return F.from_json(F.lit(json.dumps({"bytes": [ranks[bytes([b])] for b in range(256)], "first": first, "pairs": pairs})),
                       "bytes array<bigint>, first array<bigint>, pairs array<array<bigint>>")


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """The bytes of each id as a constant column."""
    pieces = [""] * (max(ranks.values()) + 1)
    for b, r in ranks.items():
        pieces[r] = base64.b64encode(b).decode()
    return F.from_json(F.lit(json.dumps(pieces)), "array<binary>")


def _rank(t: Column, a: Column, b: Column) -> Column:
    """Rank of the concatenation of ids ``a`` and ``b``, or a number from ``_NEVER`` up: the element
    after the key in its bucket; a missing key gives the bucket's first key."""
    def bucket(k):
        return F.get(t["pairs"], F.xxhash64(k).bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int"))

    return let((a + 1) * 65536 + b, lambda k: F.coalesce(
        F.get(bucket(k), F.array_position(bucket(k), k).cast("int")), F.lit(_NEVER).cast("long")))


def encode_word(t: Column, word: Column) -> Column:
    """Ids of one word, given as its byte values."""
    none = F.array().cast("array<bigint>")

    def step(acc):
        p, r = acc["p"], acc["r"]
        return let(F.array_min(r), lambda m: F.when(m.isNull() | (m >= _NEVER), acc).otherwise(let(
            F.array_position(r, m).cast("int") - 1, lambda i: F.struct(
                F.concat(F.slice(p, F.lit(1), i), F.array(m), F.slice(p, i + 3, F.size(p))).alias("p"),
                F.concat(F.slice(r, F.lit(1), F.greatest(i - 1, F.lit(0))),
                         F.when(i > 0, F.array(_rank(t, F.get(p, i - 1), m))).otherwise(none),
                         F.when(i + 2 < F.size(p), F.array(_rank(t, m, F.get(p, i + 2)))).otherwise(none),
                         F.slice(r, i + 3, F.size(r))).alias("r")))))

    start = F.struct(
        F.transform(word, lambda b: F.get(t["bytes"], b)).alias("p"),
        F.when(F.size(word) > 1, F.transform(
            F.sequence(F.lit(0), F.size(word) - 2),
            lambda i: F.get(t["first"], F.get(word, i) * 256 + F.get(word, i + 1)))).otherwise(none).alias("r"))
    return F.aggregate(F.slice(word, 2, F.size(word)), start, lambda acc, _: step(acc), lambda acc: acc["p"])


def decode_ids(pieces: Column, ids: Column) -> Column:
    """Bytes of an array of ids."""
    return F.aggregate(ids, F.lit(b""), lambda acc, i: F.concat(acc, F.get(pieces, i.cast("int"))))


def _cut(shards: int):
    """Blocks of a task's documents: word numbers per document, and distinct words per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        find = splitter()
        for chunk, parts in chunks.batched(batches, 1):
            index: defaultdict[str, int] = defaultdict()
            index.default_factory = index.__len__  # a new word gets the next number
            numbers, lengths = [], []
            for part in parts:
                for text in part.column(1).to_pylist():
                    found = find(text)
                    numbers.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
                    lengths.append(len(found))
            words = [w.encode("utf-8", "replace") for w in index]
            flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
            often = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")  # small numbers for frequent words
            rank = np.empty(len(words), np.int32)
            rank[often] = np.arange(len(words))
            long = np.array([len(w) > LONG_WORD for w in words], bool)
            short = np.flatnonzero(~long)
            home = np.array([zlib.crc32(words[i]) % shards for i in short.tolist()], np.int64)
            asked = []
            for shard, at in chunks.by_shard(home, shards):
                own = short[at]
                asked.append(rank[own])
                yield chunk, shard, chunks.pack(*chunks.pack_words([words[i] for i in own.tolist()]))
            own = np.flatnonzero(long)
            ids = pa.concat_arrays([p.column(0) for p in parts])
            yield chunk, -1, chunks.pack(
                np.frombuffer(_ids_block(ids), np.uint8), np.array(lengths, np.int32),
                rank[flat] if len(words) else flat, np.concatenate([*asked, np.zeros(0, np.int32)]), rank[own],
                *chunks.pack_words([words[i] for i in own.tolist()]))
    return run


def _ids_block(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ids_of(block: np.ndarray) -> list:
    return pa.ipc.open_stream(block.tobytes()).read_all().column(0).to_pylist()


def _distinct(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's distinct words as byte arrays, and each chunk's numbers in them."""
    if rows["key"].iloc[0] >= 0:
        return pd.DataFrame({"shard": [], "chunks": [], "asked": [], "words": []}, dtype=object)
    index: dict[bytes, int] = {}
    asked = []
    for block in rows["block"]:
        ws = chunks.unpack_words(*chunks.unpack(block))
        asked.append(chunks.pack(np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int32, len(ws))))
    return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "chunks": [rows["chunk"].to_numpy()], "asked": [asked],
                         "words": [[np.frombuffer(w, np.uint8).astype(np.int16) for w in index]]})


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk that asked: ids per word, ids, decoded length per word, decoded bytes."""
    for b in batches:
        for i in range(b.num_rows):
            ids = b.column(3)[i].values
            counts = np.diff(ids.offsets.to_numpy())
            starts = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype(np.uint32)
            back = b.column(4)[i].as_py()
            for chunk, block in zip(b.column(1)[i].as_py(), b.column(2)[i].as_py()):
                own = chunks.unpack(block)[0]
                n = counts[own]
                at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                answer = chunks.pack(n.astype(np.int32), flat[at], *chunks.pack_words([back[k] for k in own.tolist()]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int64()), pa.array([b.column(0)[i].as_py()], pa.int32()), pa.array([answer], pa.binary())],
                    names=["chunk", "shard", "block"])


def encode(docs: DataFrame, rank_file: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row; ``with_ids`` adds ids and decoded bytes."""
    path = rank_file or tokenizer_path("byte_bpe_multi_50k.tiktoken")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = chunks.keyed(rows, _cut(chunks.shards_for(docs.sparkSession, rows)))
    words = blocks.groupBy("key").applyInPandas(
        _distinct, "shard int, chunks array<long>, asked array<binary>, words array<array<smallint>>")
    ranks = read_ranks(path)
    # one row per shard: both projections bind their literal once per row
    encoded = words.select("shard", "chunks", "asked", let(rank_literal(ranks), lambda t: F.transform(
        "words", lambda w: encode_word(t, w))).alias("ids"))
    decoded = encoded.select("shard", "chunks", "asked", "ids", let(piece_literal(ranks), lambda t: F.transform(
        "ids", lambda i: decode_ids(t, i))).alias("back"))
    answers = decoded.mapInArrow(_answers, "chunk long, shard int, block binary")

    digits = [str(i) for i in range(max(ranks.values()) + 1)]

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[] for _ in names]
        for block in left["block"][left["shard"] < 0]:
            ids_block, lengths, numbers, asked, long, *rest = chunks.unpack(block)
            n = len(asked) + len(long)
            text, back, count, raw = [b""] * n, [b""] * n, np.zeros(n, np.int64), [b""] * n
            at = 0
            for answer in right.sort_values("shard")["block"]:
                counts, ids, *bytes_ = chunks.unpack(answer)
                ends, pieces = np.cumsum(counts).tolist(), list(map(digits.__getitem__, ids.tolist()))
                flat = ids.astype("<u4")
                own = asked[at:at + len(counts)].tolist()
                at += len(counts)
                count[own] = counts
                for k, a, b, d in zip(own, [0, *ends], ends, chunks.unpack_words(*bytes_)):
                    text[k], back[k] = ",".join(pieces[a:b]).encode(), d
                    if with_ids:
                        raw[k] = flat[a:b].tobytes()
            if len(long):
                enc, pieces_of = byte_encoding(path)._core_bpe, {r: b for b, r in read_ranks(path).items()}
                for k, w in zip(long.tolist(), chunks.unpack_words(*rest)):
                    ids = enc.encode_single_piece(w)
                    text[k], back[k], count[k] = ",".join(map(str, ids)).encode(), b"".join(pieces_of[i] for i in ids), len(ids)
                    raw[k] = np.array(ids, "<u4").tobytes()
            at = 0
            for doc_id, length in zip(_ids_of(ids_block), lengths.tolist()):
                mine = numbers[at:at + length]
                own = mine.tolist()
                at += length
                whole = b"".join([back[k] for k in own])
                row = [doc_id, int(count[mine].sum()),
                       hashlib.sha256(b",".join([text[k] for k in own])).hexdigest(), hashlib.sha256(whole).hexdigest()]
                if with_ids:
                    row += [np.frombuffer(b"".join([raw[k] for k in own]), "<u4").astype(np.int64).tolist(), whole]
                for c, v in zip(out, row):
                    c.append(v)
        return pd.DataFrame(dict(zip(names, out)), columns=names, dtype=None if out[0] else object)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<long>, decoded binary" if with_ids else ""
    names = [x.split()[0] for x in schema.split(", ")]
    return blocks.groupBy("key").cogroup(answers.groupBy("chunk")).applyInPandas(join, schema)
