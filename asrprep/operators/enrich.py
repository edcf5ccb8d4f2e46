"""Keyed batch enrichment through a pluggable client (e.g. a URL signer).

The client is a picklable callable ``client(values: list[str]) -> list[str | None] | dict[str, str]``.
Each Spark task sends its rows in batches of ``batch_size`` (filled across Arrow batches) with
bounded retries; every input key comes back exactly once, either with a value or with an error. Answers
in a mapping, or in records that name their path, are attached by key; plain lists by their order. Task retries may call the client twice for a key, so it must be idempotent.
"""

from __future__ import annotations

import random
import time

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Field names of the signer's answers.
SIGNED_URL, SIGNED_URLS, SIGNED_PATH = "signedURL", "signedURLs", "path"


def _answers(got, values: list) -> list:
    """The answer per value, from any of the client's forms: ``{"signedURLs": answers}``, a mapping
    from value to answer, a list of records with ``signedURL`` (found by their ``path`` where all have one,
    otherwise in the order of the values), or a plain list in the order of the values."""
    if isinstance(got, dict) and SIGNED_URLS in got:
        return _answers(got[SIGNED_URLS], values)
    if isinstance(got, dict):
        return [got.get(v) for v in values]
    got = list(got)
    if got and all(isinstance(x, dict) for x in got):
        if all(x.get(SIGNED_PATH) is not None for x in got):
            by_path = {x[SIGNED_PATH]: x.get(SIGNED_URL) for x in got}
            return [by_path.get(v) for v in values]
        return [x.get(SIGNED_URL) for x in got]
    return got


def _call(client, values, max_retries, backoff):
    last = None
    for attempt in range(1, max_retries + 1):
        try:
            out = _answers(client(list(values)), values)
            if len(out) != len(values):
                raise ValueError(f"client returned {len(out)} values for {len(values)} inputs")
            return out, attempt, None
        except Exception as e:  # noqa: BLE001 - any client failure is retried, then recorded
            last = f"{type(e).__name__}: {e}"
            if attempt < max_retries and backoff:
                time.sleep(backoff[0] + random.random() * (backoff[1] - backoff[0]))
    return [None] * len(values), max_retries, last


def enrich(df: DataFrame, key_col: str, value_col: str, client, out_col: str = "result",
           batch_size: int = 1000, max_retries: int = 5, backoff: tuple[float, float] | None = (1.0, 3.0)) -> DataFrame:
    """Add ``out_col``, ``attempts`` and ``error`` to ``(key_col, value_col)`` rows."""
    key_type = df.schema[key_col].dataType.simpleString()
    schema = f"{key_col} {key_type}, {value_col} string, {out_col} string, attempts int, error string"

    def answered(keys, vals):
        todo = [j for j, v in enumerate(vals) if v is not None]
        out, a, e = [None] * len(vals), 0, None
        if todo:
            got, a, e = _call(client, [vals[j] for j in todo], max_retries, backoff)
            for j, g in zip(todo, got):
                out[j] = g
        err = ["value_missing" if v is None else (e or "no_result_for_key") if g is None else None for v, g in zip(vals, out)]
        att = [0 if v is None else a for v in vals]
        return pd.DataFrame({key_col: keys, value_col: vals, out_col: out, "attempts": pd.array(att, dtype="Int32"), "error": err})

    def run(batches):
        keys, vals = [], []
        for pdf in batches:
            keys += pdf[key_col].tolist()
            vals += pdf[value_col].tolist()
            while len(vals) >= batch_size:
                yield answered(keys[:batch_size], vals[:batch_size])
                keys, vals = keys[batch_size:], vals[batch_size:]
        if vals:
            yield answered(keys, vals)

    return df.select(key_col, F.col(value_col).cast("string").alias(value_col)).mapInPandas(run, schema)


class HashSigner:
    """Deterministic stand-in signer: ``<base>/<path>?token=<md5(path:expiry)[:16]>``."""

    def __init__(self, base: str = "https://storage.example/sign/", expiry: int = 604800):
        self.base, self.expiry = base, expiry

    def __call__(self, paths):
        import hashlib
        return [f"{self.base}{p}?token={hashlib.md5(f'{p}:{self.expiry}'.encode()).hexdigest()[:16]}"
                for p in paths]
