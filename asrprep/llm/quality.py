"""Quality classifier by positive-unlabelled learning.

Trusted positives (rows labelled 1) are set against unlabelled web text. With the share ``prior`` of
good text among the unlabelled, the risk on unseen negatives follows from both samples; the
non-negative estimator (Kiryo et al., 2017) keeps that part from falling below zero:
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).
It is minimised in numpy, with the sigmoid loss, for a small network over features of the whole text.
No negative label is used.

The class prior is estimated from the two samples alone (best bin estimation, Garg et al., 2021): a
first network tells positives from unlabelled text; over all score cuts c, the smallest ratio of
the unlabelled share above c to the positive share above c, with a confidence margin on both.

Features of a text: how often each word shape and pair of neighbouring shapes occurs (case, digits and
marks, not letters; hashed), lengths, and how much of the text repeats earlier words, word pairs and lines.

Defined cases: a null text counts as empty and has a score; without positives every score is 0;
repeated rows score alike; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm import samples

SHAPES, PAIRS, HIDDEN = 64, 192, 24
MAX_POSITIVE, MAX_UNLABELLED = 6000, 9000
EPOCHS, BATCH, RATE = 40, 500, 0.01
_LOWER, _UPPER = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+")
_DIGIT = re.compile(r"\d+")
N_FEATURES = SHAPES + PAIRS + 12
_CACHE_WORDS = 300_000


def _shape(word: str) -> int:
    s = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "x" if c.isalpha() else c for c in word)
    s = re.sub(r"(.)\1+", r"\1", s)[:6]
    return zlib.crc32(s.encode("utf-8", "replace")) % SHAPES


class Features:
    """Features of texts; shapes of words are kept in a bounded cache."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def one(self, text: str) -> np.ndarray:
        raw = text.encode("utf-8", "replace")
        words = raw.split()
        x = np.zeros(N_FEATURES, np.float32)
        n = len(words)
        if not n:
            return x
        known = self.known
        if len(known) > _CACHE_WORDS:
            known.clear()
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        shape_of = []
        for w in number:
            s = known.get(w)
            if s is None:
                s = known[w] = _shape(w.decode("utf-8", "replace"))
            shape_of.append(s)
        shapes = np.array(shape_of, np.int64)[ids]
        x[:SHAPES] = np.sqrt(np.bincount(shapes, minlength=SHAPES) / n)
        if n > 1:
            pairs = (shapes[:-1] * 31 + shapes[1:] * 7 + shapes[:-1] * shapes[1:]) % PAIRS
            x[SHAPES:SHAPES + PAIRS] = np.sqrt(np.bincount(pairs, minlength=PAIRS) / (n - 1))
        grams = ids[:-1] * (len(number) + 1) + ids[1:] if n > 1 else ids
        lines = [s for s in raw.split(b"\n") if s.strip()]
        counts = np.bincount(ids)
        marks = sum(raw.count(m) for m in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
        upper = sum(1 for c in raw if 65 <= c <= 90) if n < 200 else int(
            np.count_nonzero((b := np.frombuffer(raw, np.uint8)) >= 65) - np.count_nonzero(b > 90))
        x[SHAPES + PAIRS:] = [
            np.log1p(n) / 5, 1 if n < 10 else 0, np.log1p(len(raw) / n), len(number) / n, 1 - len(np.unique(grams)) / len(grams),
            counts.max() / n, 1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)) / 3,
            min(1, marks / n), min(1, raw.count(b"!") / n), upper / len(raw), np.count_nonzero(ids[1:] == ids[:-1]) / n]
        return x

    def many(self, texts: list[str]) -> np.ndarray:
        return np.stack([self.one(t) for t in texts]) if texts else np.zeros((0, N_FEATURES), np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(pos: np.ndarray, unl: np.ndarray, prior: float | None, seed: int, epochs: int = EPOCHS) -> Model:
    """Non-negative risk for a ``prior``; without one, plain positives against unlabelled (logistic loss)."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    m = Model(both.mean(0), np.maximum(both.std(0), 0.02), rng.normal(0, 0.05, (N_FEATURES, HIDDEN)).astype(np.float32),
              np.zeros(HIDDEN, np.float32), rng.normal(0, 0.3, HIDDEN).astype(np.float32), 0.0, prior or 0.0)
    p, u = [np.clip((x - m.mean) / m.scale, -8, 8).astype(np.float32) for x in (pos, unl)]
    theta = [m.w1, m.b1, m.w2, np.zeros(1, np.float32)]
    mom, var, step = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    steps = max(1, -(-len(u) // BATCH))
    for _ in range(epochs):
        pi, ui = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(steps):
            xp = p[pi[np.arange(k * len(p) // steps, max((k + 1) * len(p) // steps, k * len(p) // steps + 1)) % len(p)]]
            xu = u[ui[k * len(u) // steps:max((k + 1) * len(u) // steps, k * len(u) // steps + 1)]]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ theta[0] + theta[1])
            z = h @ theta[2] + theta[3][0]
            s, np_ = _sigmoid(z), len(xp)
            dz = np.zeros_like(z)
            if prior is None:
                dz[:np_], dz[np_:] = (s[:np_] - 1) / np_, s[np_:] / len(xu)
            else:
                # sigmoid loss: positive 1 - s, negative s
                slope = s * (1 - s)
                negative = s[np_:].mean() - prior * s[:np_].mean()
                if negative >= 0:
                    dz[:np_] = -2 * prior * slope[:np_] / np_
                    dz[np_:] = slope[np_:] / len(xu)
                else:  # the negative part is below its bound: step back out of it
                    dz[:np_] = prior * slope[:np_] / np_
                    dz[np_:] = -slope[np_:] / len(xu)
            dh = np.outer(dz, theta[2]) * (1 - h * h)
            grads = [x.T @ dh + 1e-4 * theta[0], dh.sum(0), h.T @ dz + 1e-4 * theta[2], np.array([dz.sum()])]
            step += 1
            for t, g, a, b in zip(theta, grads, mom, var):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                t -= (RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    m.b2 = float(theta[3][0])
    return m


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 3) -> float:
    """Share of positives among the unlabelled, from halves kept out of training."""
    first = _train(pos[::2], unl[::2], None, seed, epochs=15)
    p, u = np.sort(first.logits(pos[1::2])), np.sort(first.logits(unl[1::2]))
    if not len(p) or not len(u):
        return 0.5
    cuts = np.unique(np.concatenate([p, u]))
    above_p = 1 - np.searchsorted(p, cuts, "left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, "left") / len(u)
    margin = np.sqrt(np.log(20) / (2 * len(p))) + np.sqrt(np.log(20) / (2 * len(u)))
    seen = above_p > 0
    at = int(np.argmin((above_u[seen] + margin) / above_p[seen]))
    return float(np.clip(above_u[seen][at] / above_p[seen][at], 0.05, 0.98))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """Learns from at most ``max_positive`` rows labelled 1 and ``max_unlabelled`` rows of ``docs`` whose
    labels are not looked at; ``learnable`` must hold for both. Only feature vectors reach the driver."""
    known = samples.one_label(labels, label_col, id_col).where(learnable).where(F.col("label") == 1)
    pos_ids = samples.sample_ids(known, max_positive, id_col).withColumn("pos", F.lit(True))
    unl_ids = samples.sample_ids(docs.select(id_col).where(learnable), max_unlabelled, id_col).withColumn("unl", F.lit(True))
    ids = pos_ids.join(unl_ids, id_col, "full")

    @F.pandas_udf("binary")
    def feats(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = Features()
        for s in batches:
            yield pd.Series([f.one(t).tobytes() for t in s], dtype=object)

    rows = (docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), id_col)
            .select("pos", "unl", feats("text").alias("x"), F.xxhash64(F.col(id_col).cast("string")).alias("o"))
            .orderBy("o", "x").collect())
    x = [np.frombuffer(r["x"], np.float32) for r in rows]
    pos, unl = [v for v, r in zip(x, rows) if r["pos"]], [v for v, r in zip(x, rows) if r["unl"]]
    if len(pos) < 2 or len(unl) < 2:
        return None
    return learn(np.stack(pos), np.stack(unl))


def learn(pos: np.ndarray, unl: np.ndarray) -> Model:
    return _train(pos, unl, estimate_prior(pos, unl), seed=5)


def score(docs: DataFrame, model: Model | None, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; the model is a few tens of KB."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = Features()
        for s in batches:
            yield pd.Series(np.zeros(len(s)) if model is None else model.scores(f.many(s.tolist())), dtype=float)

    return samples.score_columns(scored, docs, id_col, text_col, held_out)
