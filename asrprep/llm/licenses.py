"""License scan: an exact set-similarity join between blocks of texts and templates of license notices.

A *block* is a window of ``2 w`` words of a text, every ``w`` words, for w = 4, 8, 16, ... so that any ``w + 1`` words in a row lie
whole in one; a template is compared with the blocks of the smallest ``w`` of at least its own number of words. A block
holds a template when it has at least ``ceil(threshold * |T|)`` of the template's distinct words: containment
``|T n B| / |T|``. The join returns every such pair:

1. **Global order.** Words of the templates are counted over all texts; tokens are numbered from the rarest up (ties by
   the word). Other words of a block can't add to an overlap and count for no size below, so a block is the set of its
   template words, as an ascending array of these numbers.
2. **Prefix filter.** With ``c`` words needed, T and B share one of the ``|T| - c + 1`` rarest of T and the ``|B| - c + 1``
   rarest of B: the join is an equi-join on these tokens. Blocks without any template's prefix token aren't
   made at all, nor blocks smaller than the least ``c`` of their width.
3. **Length filter.** ``|B| >= c``.
4. **Positional filter.** If the shared token is the i-th of T and the j-th of B (from 0), at most
   ``1 + min(i, j) + min(|T| - i - 1, |B| - j - 1)`` words are shared.
5. Pairs that are left are compared whole.

The phrases of ``PHRASES`` are found beside, as words in a row. The templates and phrases are parameters of
bounded size, so their tables are broadcast; texts aren't shuffled, only a narrow row for each text and those few
blocks that pass are written, to the shared folder. A hot source or long text has no effect: a text's blocks are
rows, spread by the text's number and width.

Defined cases: a null or empty text has no words, no place, no label and score 0; very long texts are read whole; repeated
rows and ids each give a row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.llm.wordcols import byte_table, slices, words
from asrprep.session import scratch_path

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
THRESHOLD = 0.9

# Phrases of the contract, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices in the words of the public licenses.
TEMPLATES = [
    ("mit", "released under the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the license. You may obtain a copy of the license at "
                 "apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License, version"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial International License"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl-2", "This source code form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
]


def lower_ascii(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def words_of(text: str) -> list[str]:
    return re.findall(WORD, lower_ascii(text))


def stride(n_words: int) -> int:
    """``w`` of the blocks that a template of so many words is compared with."""
    w = 4
    while w < n_words:
        w *= 2
    return w


def needed(size: int, threshold: float) -> int:
    part = Fraction(str(threshold)) * size  # not 0.7 * 10 = 7.000000000000001
    return -(-part.numerator // part.denominator)


class Templates:
    """The templates' side of the join: plain Python, as small as the parameter."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must be over 0 and at most 1")
        self.rows = [(i, label, words_of(text)) for i, (label, text) in enumerate(templates) if words_of(text)]
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.threshold = threshold
        self.vocabulary = sorted({w for _, _, ws in self.rows for w in ws} | {w for p, _ in self.phrases for w in p})

    def ranked(self, counts: dict[str, int]) -> RankedTemplates:
        return RankedTemplates(self, counts)


class RankedTemplates:
    def __init__(self, t: Templates, counts: dict[str, int]):
        #: the vocabulary from the rarest word up; a token is its place here
        self.order = sorted(t.vocabulary, key=lambda w: (counts.get(w, 0), w))
        token = {w: i for i, w in enumerate(self.order)}
        self.phrases = [(np.array([token[w] for w in p], np.int32), label) for p, label in t.phrases]
        self.sets = [(i, label, stride(len(ws)), sorted({token[w] for w in ws})) for i, label, ws in t.rows]
        self.need = {i: needed(len(s), t.threshold) for i, _, _, s in self.sets}
        self.widths = sorted({w for _, _, w, _ in self.sets})
        #: by width: the least overlap, the members and the prefix tokens of its templates
        self.least = {w: min(self.need[i] for i, _, v, _ in self.sets if v == w) for w in self.widths}
        self.member, self.prefix = {}, {}
        for w in self.widths:
            self.member[w], self.prefix[w] = np.zeros(len(self.order), bool), np.zeros(len(self.order), bool)
            for i, _, v, s in self.sets:
                if v == w:
                    self.member[w][s] = True
                    self.prefix[w][s[:len(s) - self.need[i] + 1]] = True

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(i, label, w, s, len(s), self.need[i]) for i, label, w, s in self.sets],
                                     "template int, label string, width int, t array<int>, n_t int, need int")


def _counts(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the vocabulary occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = byte_table(SEPARATORS, lower=True), pa.array(vocabulary, pa.string())
        seen = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                at = pc.index_in(words(part.column(1), table)[0], known).drop_null().to_numpy(zero_copy_only=False)
                seen += np.bincount(at, minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([known, pa.array(seen)], names=["word", "n"])

    found = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in found.collect()}  # a row per word of the templates


def _of_slice(part: pa.RecordBatch, ranked: RankedTemplates, known: pa.Array, table: np.ndarray) -> pa.RecordBatch:
    flat, offsets = words(part.column(1), table)
    n = part.num_rows
    tokens = pc.fill_null(pc.index_in(flat, known), -1).to_numpy(zero_copy_only=False)
    row_of = np.repeat(np.arange(n), np.diff(offsets))

    # phrases: all places
    places, labels = [], [[] for _ in range(n)]
    for phrase, label in ranked.phrases:
        k = len(phrase)
        at = np.flatnonzero(tokens[:max(0, len(tokens) - k + 1)] == phrase[0])
        for j in range(1, k):
            at = at[tokens[at + j] == phrase[j]]
        at = at[row_of[at] == row_of[at + k - 1]]
        places.append(at)
        for r in np.unique(row_of[at]).tolist():
            labels[r].append(label)
    places = np.sort(np.concatenate(places)) if places else np.zeros(0, np.int64)
    of = row_of[places]
    n_base = np.bincount(of, minlength=n)
    ends = np.cumsum(n_base)
    has = n_base > 0
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    first[has] = places[(ends - n_base)[has]] - offsets[:-1][has]
    last[has] = places[ends[has] - 1] - offsets[:-1][has]

    # blocks: (row, width, number, token), each token once, of those blocks that hold a prefix token
    made = [np.zeros((0, 4), np.int64)]
    known_at = np.flatnonzero(tokens >= 0)
    for w in ranked.widths:
        hit = known_at[ranked.member[w][tokens[known_at]]]
        row, number = row_of[hit], (hit - offsets[row_of[hit]]) // w
        row, token = np.concatenate([row, row]), np.concatenate([tokens[hit], tokens[hit]]).astype(np.int64)
        number = np.concatenate([number, number - 1])  # block k holds the words from k w up to (k + 2) w
        first_of = np.concatenate([[0], np.cumsum(np.diff(offsets) // w + 2)])  # a row's blocks are numbered from here
        key = first_of[row] + number + 1
        able = np.zeros(first_of[-1], bool)
        able[key[ranked.prefix[w][token]]] = True
        able[first_of[:-1]] = False  # number -1: no block
        key, token = key[able[key]], token[able[key]]
        pair = np.unique(key * len(ranked.order) + token)
        key, token = pair // len(ranked.order), pair % len(ranked.order)
        at, size = np.unique(key, return_counts=True)
        big = np.repeat(size >= ranked.least[w], size)
        key, token = key[big], token[big]
        row = np.searchsorted(first_of, key, side="right") - 1
        made.append(np.stack([row, np.full(len(key), w), key - first_of[row] - 1, token], 1))
    made = np.concatenate(made)
    made = made[np.lexsort((made[:, 3], made[:, 2], made[:, 1], made[:, 0]))]
    new = np.flatnonzero(np.concatenate([[True], (made[1:, :3] != made[:-1, :3]).any(1)])) if len(made) else np.zeros(0, np.int64)
    blocks = pa.StructArray.from_arrays(
        [pa.array(made[new, 1], pa.int32()), pa.array(made[new, 2]),
         pa.ListArray.from_arrays(np.append(new, len(made)).astype(np.int32), pa.array(made[:, 3], pa.int32()))],
        names=["width", "number", "b"])
    lists = pa.ListArray.from_arrays(np.searchsorted(made[new, 0], np.arange(n + 1)).astype(np.int32), blocks)
    none = pa.array(~has)
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(n_base, pa.int64()),
         pc.if_else(none, None, pa.array(first, pa.int64())), pc.if_else(none, None, pa.array(last, pa.int64())),
         pa.array([sorted(set(x)) for x in labels], pa.list_(pa.string())), lists],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])


def contained(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """(row, number, width, template, label, containment) of all pairs of a block and a template of its width that meet
    the template's ``need``: prefix, length and positional filter, then the whole sets."""
    small = F.broadcast(templates.select("template", "label", "width", "n_t", "need", "t", F.posexplode(
        F.slice("t", F.lit(1), F.col("n_t") - F.col("need") + 1)).alias("i", "token")))
    least = templates.groupBy("width").agg(F.min("need").alias("least"))
    prefix = (blocks.join(F.broadcast(least), "width").withColumn("n_b", F.size("b")).where("n_b >= least")
              .select("row", "number", "width", "b", "n_b", F.posexplode(
                  F.slice("b", F.lit(1), F.col("n_b") - F.col("least") + 1)).alias("j", "token")))
    pairs = (prefix.join(small, ["width", "token"])
             .where((F.col("n_b") >= F.col("need")) & (F.col("j") <= F.col("n_b") - F.col("need")))
             .where(F.least("i", "j") + F.least(F.col("n_t") - F.col("i"), F.col("n_b") - F.col("j")) >= F.col("need")))
    shared = F.size(F.array_intersect("b", "t"))
    return (pairs.withColumn("shared", shared).where("shared >= need")
            .select("row", "number", "width", "template", "label", (F.col("shared") / F.col("n_t")).alias("containment"))
            .distinct())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 with a phrase,
    else the highest containment found, else 0) and blocks, an array of (first_word, n_words, template, label,
    containment) of what the join found."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    given = Templates(templates, phrases, threshold)
    ranked = given.ranked(_counts(rows, given.vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = byte_table(SEPARATORS, lower=True), pa.array(ranked.order, pa.string())
        for batch in batches:
            for part in slices(batch, 1):
                yield _of_slice(part, ranked, known, table)

    path = scratch_path(spark, "license-blocks")
    schema = (f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>, "
              "blocks array<struct<width: int, number: long, b: array<int>>>")
    rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    seen = spark.read.schema(f"{schema}, row long").parquet(path)
    blocks = seen.where(F.size("blocks") > 0).select("row", F.explode("blocks").alias("x")).select("row", "x.*")
    found = (contained(blocks, ranked.table(spark))
             .groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"),
                                 F.array_sort(F.collect_list(F.struct(
                                     (F.col("number") * F.col("width")).alias("first_word"), (2 * F.col("width")).alias("n_words"),
                                     "template", "label", "containment"))).alias("found")))
    empty = F.array().cast("array<string>")
    return seen.drop("blocks").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", empty))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.col("found").alias("blocks"))


def oracle_sql(templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> str:
    """DuckDB: every block of every text against every template, without filters."""
    t = Templates(templates, phrases, threshold)
    members = ", ".join(f"({i}, '{label}', {stride(len(ws))}, {len(set(ws))}, {needed(len(set(ws)), threshold)}, '{w}')"
                        for i, label, ws in t.rows for w in sorted(set(ws)))
    starts = " UNION ALL ".join(
        f"SELECT row, i, '{label}' AS label FROM p WHERE " + " AND ".join(f"ws[i + {j + 1}] = '{w}'" for j, w in enumerate(ws))
        for ws, label in t.phrases)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
p AS (SELECT row, ws, unnest(range(len(ws))) AS i FROM d),
base AS (SELECT row, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
        list_sort(list(DISTINCT label)) AS base FROM ({starts}) GROUP BY row),
t(template, label, width, n_t, need, word) AS (VALUES {members}),
hit AS (SELECT p.row, t.template, t.label, t.width, t.n_t, t.need, t.word, p.i // t.width - k AS block
        FROM p JOIN t ON p.ws[p.i + 1] = t.word, (VALUES (0), (1)) AS x(k)),
found AS (SELECT row, template, label, count(DISTINCT word) / any_value(n_t) AS containment FROM hit WHERE block >= 0
        GROUP BY row, template, label, block HAVING count(DISTINCT word) >= any_value(need)),
more AS (SELECT row, list(DISTINCT label) AS more, max(containment) AS best FROM found GROUP BY row)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    array_to_string(coalesce(base, []), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (row) LEFT JOIN more USING (row)
"""
