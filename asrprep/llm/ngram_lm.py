"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is a bigram model over words and an end mark, which is also the context of a text's first
word. With c() counts over all training texts and p1 the add-half unigram probability,
    p(w | h) = (c(h w) + m(h) p1(w)) / (c(h) + m(h)),   m(h) = 5 + c(h),
so rare contexts lean on p1, and no context trusts its counts alone. It sums to one over all words
seen in training and one more for all others.

1. Chunks send their distinct words with training counts to the words' shards (``chunks``), which
   return each word's total and its number. Types and tokens per shard are added up.
2. Chunks know their words' counts now: base scores follow, and word pairs go, with training
   counts, to the pairs' shards, spread by hash of both words so that no context is hot.
3. Each pair shard adds up the counts, smooths, and builds a trie in a memory-mapped file: contexts,
   monotone pointers, successors, quantised log10 probabilities. All pairs that chunks asked for are looked
   up in it, and probabilities of pairs unseen in training follow from the formula.
4. Chunks add up the answers per document.
All steps cover all texts; there is no cut-off.

Defined cases: a null text counts as empty (one token, the end); without training texts the unigram
is one half over one half; repeated rows count each in training and score alike; an empty table
gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm import chunks
from asrprep.llm.elias_fano import UNSEEN, Trie
from asrprep.session import scratch_path

CONST, SHARE = 5.0, 1.0  # m(h) = CONST + SHARE * c(h)
END = b""
CHUNK_BYTES = 9 << 20
PAIR_SHARDS = 4  # pair shards per word shard: a text has many more distinct pairs than words


def _ids_block(ids: pa.Array) -> np.ndarray:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return np.frombuffer(sink.getvalue(), np.uint8)


def _ids_of(block: np.ndarray) -> list:
    return pa.ipc.open_stream(block.tobytes()).read_all().column(0).to_pylist()


def _cut(shards: int):
    """Documents as word numbers (a document ends with the end mark), and distinct words per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for chunk, parts in chunks.batched(batches, 1, CHUNK_BYTES):
            index: defaultdict[bytes, int] = defaultdict()
            index.default_factory = index.__len__
            numbers, lengths, train = [], [], []
            for part in parts:
                train += part.column(2).to_pylist()
                for text in part.column(1).to_pylist():
                    ws = text.encode("utf-8", "replace").lower().split()
                    ws.append(END)
                    numbers.append(np.fromiter(map(index.__getitem__, ws), np.int32, len(ws)))
                    lengths.append(len(ws))
            words, flat, lengths = list(index), np.concatenate(numbers), np.array(lengths, np.int64)
            often = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int32)
            rank[often] = np.arange(len(words))
            learned = np.repeat(np.array(train, bool), lengths)
            counts = np.bincount(flat[learned], minlength=len(words)).astype(np.int32)
            home = np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))
            asked = []
            for shard, at in chunks.by_shard(home, shards):
                asked.append(rank[at])
                yield chunk, shard, chunks.pack(counts[at], *chunks.pack_words([words[i] for i in at.tolist()]))
            yield chunk, -1, chunks.pack(
                _ids_block(pa.concat_arrays([p.column(0) for p in parts])), lengths.astype(np.int32),
                np.array(train, np.uint8), rank[flat], np.concatenate(asked), np.array([rank[index[END]]], np.int32))
    return run


def _count_words(rows: pd.DataFrame) -> pd.DataFrame:
    """A word shard's answers (count and number within the shard), and its types and tokens (chunk -1)."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    asked, counts = [], []
    for block in rows["block"]:
        n, *ws = chunks.unpack(block)
        asked.append(np.array(list(map(index.__getitem__, chunks.unpack_words(*ws))), np.int64))
        counts.append(n)
    total = np.bincount(np.concatenate(asked), weights=np.concatenate(counts), minlength=len(index)).astype(np.int64)
    number = np.empty(len(total), np.int64)
    number[np.argsort(-total, kind="stable")] = np.arange(len(total))  # frequent words get small numbers: small blocks
    shard = int(rows["shard"].iloc[0])
    return pd.DataFrame({
        "shard": shard, "chunk": [-1, *rows["chunk"]],
        "block": [b"", *(chunks.pack(total[a], number[a].astype(np.int32)) for a in asked)],
        "types": [int((total > 0).sum())] + [0] * len(asked), "tokens": [int(total.sum())] + [0] * len(asked)})


def _pairs(word_shards: int, shards: int, tokens: int, types: int, names: list[str]):
    """Cogroup of a chunk's documents with its words' answers: base scores, and pairs per shard."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        z = tokens + 0.5 * (types + 1)
        for chunk, block in left[["chunk", "block"]].itertuples(index=False):
            doc_ids, lengths, train, numbers, asked, end = chunks.unpack(block)
            count, ids = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
            at = 0
            for shard, answer in right.sort_values("shard")[["shard", "block"]].itertuples(index=False):
                c, number = chunks.unpack(answer)
                own = asked[at:at + len(c)]
                count[own], ids[own] = c, number.astype(np.int64) * word_shards + shard
                at += len(c)
            log1 = np.log10((count + 0.5) / z)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            before = np.concatenate([end, numbers[:-1]]) if len(numbers) else numbers
            before[starts] = end[0]
            base = np.add.reduceat(log1[numbers], starts)
            known = np.add.reduceat((count[numbers] > 0).astype(np.int64), starts)
            # a pair with an unknown word is not asked for: an unknown context leaves p1, an unknown
            # word has no pair count
            h, w = count[before], count[numbers]
            direct = (h == 0) | (w == 0)
            m = CONST + SHARE * h
            plain = np.where(h == 0, log1[numbers], log1[numbers] + np.log10(m / (h + m)))
            extra = np.add.reduceat(np.where(direct, plain, 0.0), starts)
            ask = np.flatnonzero(~direct)
            key, first, inverse = np.unique(before[ask].astype(np.int64) << 32 | numbers[ask], return_index=True, return_inverse=True)
            learned = np.repeat(train.astype(bool), lengths)[ask]
            n = np.bincount(inverse[learned], minlength=len(key)).astype(np.int32)
            a, b = before[ask][first], numbers[ask][first]
            mixed = (ids[a].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[b].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
            home = ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((ids[b], ids[a], home))
            place = np.empty(len(key), np.int32)
            place[order] = np.arange(len(key))
            edges = np.flatnonzero(np.diff(home[order], prepend=-1, append=shards))
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                p, q = a[order[x:y]], b[order[x:y]]
                new = np.flatnonzero(np.diff(ids[p], prepend=-1))
                out.append((-1 - int(home[order[x]]), chunk, int(home[order[x]]), chunks.pack(
                    ids[p][new], count[p][new], np.diff(new, append=len(p)).astype(np.int32),
                    np.diff(ids[q], prepend=0), count[q], n[order[x:y]], level=5)))
            per_doc = np.add.reduceat((~direct).astype(np.int32), starts)
            out.append((chunk, chunk, -1, chunks.pack(
                doc_ids, lengths, train, known.astype(np.int32), base, extra, per_doc, place[inverse], level=5)))
        return pd.DataFrame(dict(zip(names, zip(*out))), columns=names, dtype=None if out else object)
    return run


def _score_pairs(rows: pd.DataFrame, tokens: int, types: int) -> pd.DataFrame:
    """A pair shard: counts added up, the trie built and mapped, each chunk's pairs answered."""
    if rows["key"].iloc[0] >= 0:
        return pd.DataFrame({"chunk": [], "shard": [], "block": []}, dtype=object)
    asked = []
    for block in rows["block"]:
        h, ch, run, w, cw, n = chunks.unpack(block)
        asked.append((np.repeat(h, run), np.repeat(ch, run), np.cumsum(w), cw, n))
    ends = np.cumsum([len(x[0]) for x in asked])
    h, ch, w, cw, n = map(np.concatenate, zip(*asked))
    del asked
    local, w_local = np.unique(w, return_inverse=True)  # ids relative to the shard keep the levels' universe small
    heads, h_local = np.unique(h, return_inverse=True)
    universe = max(len(local), len(heads))
    del h, w
    key, first, inverse = np.unique(h_local * universe + w_local, return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=n, minlength=len(key))
    p1 = (cw + 0.5) / (tokens + 0.5 * (types + 1))
    m = CONST + SHARE * ch
    seen = np.flatnonzero(total > 0)
    at = first[seen]
    value = np.log10((total[seen] + m[at] * p1[at]) / (ch[at] + m[at]))
    unseen = np.log10(m * p1 / (ch + m))
    with tempfile.TemporaryDirectory() as folder:  # local to this task, gone at its end
        path = os.path.join(folder, "trie")
        Trie.build(np.stack([key[seen] // universe, key[seen] % universe], 1), value, universe).save(path)
        trie = Trie.open(path)
        codes, book = trie.find_codes(np.stack([h_local, w_local], 1)), np.array(trie.book)
        del trie
    blocks = [chunks.pack(codes[a:b], book, unseen[a:b][codes[a:b] == UNSEEN].astype(np.float32)) for a, b in zip([0, *ends], ends)]
    return pd.DataFrame({"chunk": rows["chunk"].tolist(), "shard": int(rows["shard"].iloc[0]), "block": blocks})


def _values(codes: np.ndarray, book: np.ndarray, unseen: np.ndarray) -> np.ndarray:
    out = book[np.minimum(codes, len(book) - 1)]
    out[codes == UNSEEN] = unseen
    return out


def score(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (``learnable`` does not hold), n_tokens, n_known, train_tokens, base_score, score per row."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(learnable, F.lit(False)).alias("train"))
    shards = chunks.shards_for(spark, rows)
    blocks = chunks.saved(rows, _cut(shards), "lm-blocks")
    path = scratch_path(spark, "lm-words")
    (blocks.where("shard >= 0").groupBy("shard").applyInPandas(_count_words, "shard int, chunk long, block binary, types long, tokens long")
     .write.option("compression", "none").parquet(path))
    words = spark.read.parquet(path)
    totals = words.where("chunk = -1").select("shard", "types", "tokens").collect()  # a row per shard
    tokens, types = sum(r["tokens"] for r in totals), sum(r["types"] for r in totals)

    names = ["key", "chunk", "shard", "block"]
    answers = words.where("chunk >= 0").select("chunk", "shard", "block")
    pairs = (blocks.where("shard < 0").groupBy("chunk").cogroup(answers.groupBy("chunk"))
             .applyInPandas(_pairs(shards, PAIR_SHARDS * shards, tokens, types, names), chunks.BLOCK).repartition("key"))
    found = pairs.groupBy("key").applyInPandas(lambda x: _score_pairs(x, tokens, types), "chunk long, shard int, block binary")

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in left.loc[left["shard"] < 0, "block"]:
            doc_ids, lengths, train, known, base, extra, per_doc, place = chunks.unpack(block)
            values = [_values(*chunks.unpack(b)) for b in right.sort_values("shard")["block"]]
            sums = np.concatenate([[0.0], np.cumsum(np.concatenate(values).astype(float)[place])]) if values else np.zeros(1)
            ends = np.cumsum(per_doc)
            out.append(pd.DataFrame({
                "doc_id": _ids_of(doc_ids), "held_out": train == 0, "n_tokens": lengths, "n_known": known,
                "train_tokens": tokens, "base_score": base, "score": extra + sums[ends] - sums[ends - per_doc]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in columns}, dtype=object)

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    columns = [x.split()[0] for x in schema.split(", ")]
    return pairs.groupBy("key").cogroup(found.groupBy("chunk")).applyInPandas(join, schema)
