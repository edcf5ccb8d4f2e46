"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings: one for the word, one for each of its prefixes of 4 and 5
letters (endings vary). Filters of widths 1, 2 and 3 slide over the words, each is max-pooled over
the whole text, and a linear layer gives the logit. Slots of the embedding table carry the 32-bit
fingerprint of the feature they belong to, so a feature not seen in training adds nothing and does
not borrow another's vector. Max-pooling sends each gradient to one position, so training is sparse.

The thresholds are calibrated by language, told from function words of the text itself: on a fifth of each class of the
training sample, kept aside from everything else (choice of features, log odds, gradients), each language gets the logit that
separates best, drawn to the common one where it has few toxic rows. With under five rows of a class none are kept aside, and
the thresholds are those of the training rows. The score is the sigmoid of the logit less its threshold, so 0.5 is the
threshold everywhere.

Defined cases: a null text counts as empty and scores like any text without a known word; without
any labelled row every score is 0; repeated rows score alike; an empty table gives an empty table;
columns other than id and text are not read. Texts of any length are scored whole; those over
``samples.MAX_BYTES`` are left out of training only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm import samples

SLOTS, DIM, FILTERS, WIDTHS = 1 << 17, 12, 12, (1, 2, 3)
MAX_TOXIC, MAX_OTHER, MAX_WORDS = 1800, 2600, 3_000_000
EPOCHS, BATCH, RATE = 6, 48, 0.01
_PAD = 0
_EDGE = ".,;:!?()[]{}<>\"'*#$%&|"

# Function words that tell the languages apart.
LANGUAGES = {
    "en": "the of and to in that is for it was with on be by this",
    "de": "der die und das den von zu mit ist nicht ein eine auf für sich dem",
    "fr": "le la les et des un une que est pour dans qui du sur pas au",
    "es": "el los y las del se por con una para al lo su no en",
}
_LANG_OF = {w: k for k in reversed(LANGUAGES) for w in LANGUAGES[k].split()}
_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGE) for x in _SPLIT.findall(text.lower())) if w]


def language(words: list[str]) -> str:
    seen = Counter(k for k in map(_LANG_OF.get, words) if k)
    return min(seen, key=lambda k: (-seen[k], k)) if seen else "other"


def features(word: str) -> list[int]:
    """64-bit keys of a word and its prefixes; the low bits are the slot, the high bits the fingerprint."""
    keys = ["w" + word] + [f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n]
    return [zlib.crc32(b"f" + k.encode("utf-8", "replace")) << 32 | zlib.crc32(k.encode("utf-8", "replace")) for k in keys]


@dataclass
class Model:
    prints: np.ndarray          # fingerprint of each slot's feature, 0: free
    table: np.ndarray           # SLOTS x DIM
    filters: list[np.ndarray]   # per width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]
    common: float

    def slots(self, words: list[str]) -> list[list[int]]:
        out = []
        for w in words:
            mine = []
            for f in features(w):
                s = f & (SLOTS - 1)
                if self.prints[s] == f >> 32 and self.prints[s]:
                    mine.append(s)
            out.append(mine)
        return out

    def vectors(self, slots: list[list[int]]) -> np.ndarray:
        """A vector per word; row 0 is padding."""
        v = np.zeros((len(slots) + 1, DIM), np.float32)
        owner = np.repeat(np.arange(1, len(slots) + 1), [len(s) for s in slots])
        np.add.at(v, owner, self.table[np.array([x for s in slots for x in s], np.int64)])
        return v

    def pooled(self, v: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Max-pooled filter values of word number sequences; also the flat sequence, where each document's windows begin and
        end in it, and the filter value of every window. The last window of a document holds padding only, so no value is below 0."""
        wide = max(WIDTHS)
        pad = np.zeros(wide, np.int64)
        flat = np.concatenate([x for d in docs for x in (d, pad)] + [pad])
        rooms = np.cumsum([len(d) + wide for d in docs])
        starts = np.concatenate([[0], rooms[:-1]])
        ends = rooms - wide + 1  # windows from here on would reach into the next document
        cuts = np.stack([starts, ends], axis=1).ravel()
        values, places = [], []
        for k, f in zip(WIDTHS, self.filters):
            by_word = [v @ f[j] for j in range(k)]  # a word's share is computed once, not at each place
            h = by_word[0][flat[:len(flat) - wide]]
            for j in range(1, k):
                h = h + by_word[j][flat[j:len(flat) - wide + j]]
            values.append(np.maximum.reduceat(h, cuts, axis=0)[::2])
            places.append(h)
        return flat, starts, ends, values, places

    def logits(self, texts: list[str]) -> tuple[np.ndarray, list[str]]:
        split = [words_of(t) for t in texts]
        index: dict[str, int] = {}
        docs = [np.array([index.setdefault(w, len(index) + 1) for w in ws], np.int64) for ws in split]
        v = self.vectors(self.slots(list(index)))
        _, _, _, values, _ = self.pooled(v, docs)
        h = np.maximum(np.concatenate(values, axis=1) + self.bias, 0)
        return h @ self.out + self.out_bias, [language(ws) for ws in split]

    def scores(self, texts: list[str]) -> np.ndarray:
        z, langs = self.logits(texts)
        t = np.array([self.thresholds.get(k, self.common) for k in langs])
        return 1 / (1 + np.exp(-np.clip(z - t, -30, 30)))


def _cut(z: np.ndarray, y: np.ndarray) -> float:
    """The logit with the fewest errors; the middle of the gap around it."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    edges = np.concatenate([[z[0] - 2], (z[:-1] + z[1:]) / 2, [z[-1] + 2]])
    return float(np.median(edges[best]))


def kept_aside(y: np.ndarray) -> np.ndarray:
    """Every fifth row of each class, for the thresholds alone; none if a class has no fifth row."""
    aside = np.zeros(len(y), bool)
    fifths = [np.flatnonzero(y == c)[4::5] for c in (0, 1)]
    if all(len(f) for f in fifths):
        aside[np.concatenate(fifths)] = True
    return aside


def gradients(m: Model, v: np.ndarray, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray):
    """Gradients of the mean weighted log loss plus 5e-5 |out|^2: by the identity of ``m``'s arrays, of the output's bias, and of
    the word vectors ``v``. A pooled value passes its gradient to the window it came from."""
    flat, starts, ends, values, places = m.pooled(v, docs)
    pre = np.concatenate(values, axis=1) + m.bias
    h = np.maximum(pre, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ m.out + m.out_bias, -30, 30)))
    g = ((p - y) * weight / len(docs)).astype(v.dtype)
    dh = np.outer(g, m.out) * (pre > 0)
    grads = {id(m.out): h.T @ g + 1e-4 * m.out, id(m.bias): dh.sum(0)}
    dv = np.zeros_like(v)
    for k, (f, place) in enumerate(zip(m.filters, places)):
        d = dh[:, k * FILTERS:(k + 1) * FILTERS]
        df_ = np.zeros_like(f)
        for r in range(len(docs)):
            live = np.flatnonzero(d[r])
            if not len(live):
                continue
            spot = starts[r] + place[starts[r]:ends[r]][:, live].argmax(0)
            for j in range(WIDTHS[k]):
                w = flat[spot + j]
                df_[j][:, live] += v[w].T * d[r, live]
                np.add.at(dv, w, (f[j][:, live] * d[r, live]).T)
        grads[id(f)] = df_
    dv[_PAD] = 0
    return grads, float(g.sum()), dv


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    aside = kept_aside(y)
    rows = np.flatnonzero(~aside)
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index) + 1) for w in words_of(t)], np.int64) for t in texts]
    keys = np.zeros((len(index) + 1, 3), np.uint64)  # features of each word, 0: none
    for w, i in index.items():
        f = features(w)
        keys[i, :len(f)] = f
    of_doc = {i: np.unique(keys[np.unique(docs[i])]) for i in rows}  # documents count once per feature
    found, n = np.unique(np.concatenate(list(of_doc.values())), return_counts=True)
    toxic = np.zeros(len(found), np.int64)
    hit, k = np.unique(np.concatenate([of_doc[i] for i in rows if labels[i]] or [found[:0]]), return_counts=True)
    toxic[np.searchsorted(found, hit)] = k
    del of_doc
    held = np.flatnonzero((n >= 2) & (found > 0))
    held = held[np.lexsort((found[held], -n[held], -toxic[held]))]  # a slot goes to its most toxic, then most frequent feature
    slot = (found[held] & np.uint64(SLOTS - 1)).astype(np.int64)
    slot, first = np.unique(slot, return_index=True)
    held = held[first]
    prints = np.zeros(SLOTS, np.uint64)
    prints[slot] = found[held] >> np.uint64(32)
    table = np.zeros((SLOTS, DIM), np.float32)
    table[slot] = rng.normal(0, 0.05, (len(slot), DIM))
    n1, n0 = max(1, int(y[rows].sum())), max(1, int((1 - y[rows]).sum()))
    # the first coordinate starts at the feature's log odds, the others at random
    a, b = toxic[held], n[held] - toxic[held]
    odds = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    table[slot, 0] = np.where(n[held] >= 3, np.clip(odds, -1, 4) / 2, 0.0)
    del keys, found, n, toxic
    filters = [rng.normal(0, 0.1, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    filters[0][0, 0, :] = np.abs(filters[0][0, 0, :]) + 0.3
    n_out = FILTERS * len(WIDTHS)
    m = Model(prints, table, filters, np.zeros(n_out, np.float32), rng.normal(0, 0.1, n_out).astype(np.float32), -1.0, {}, 0.0)
    m.out[:FILTERS] = np.abs(m.out[:FILTERS]) + 0.3
    slots = [None] + m.slots(list(index))
    weight = np.where(y > 0, max(1.0, n0 / n1) ** 0.5, 1.0)
    speed = {id(p): np.zeros_like(p) for p in [m.bias, m.out, *m.filters]}
    table_speed = np.zeros(SLOTS, np.float32)
    for _ in range(EPOCHS):
        for at in range(0, len(rows), BATCH):
            if at == 0:
                rng.shuffle(rows)
            take = rows[at:at + BATCH]
            used = np.unique(np.concatenate([docs[i] for i in take] + [np.array([_PAD])]))
            used = used[used > 0]
            local = np.zeros(len(index) + 1, np.int64)
            local[used] = np.arange(1, len(used) + 1)
            own = [slots[i] for i in used]
            v = m.vectors(own)
            grads, g, dv = gradients(m, v, [local[docs[i]] for i in take], y[take], weight[take])
            for q in [m.bias, m.out, *m.filters]:
                speed[id(q)] += grads[id(q)] ** 2
                q -= RATE * 2 * grads[id(q)] / (np.sqrt(speed[id(q)]) + 1e-6)
            m.out_bias -= RATE * g * 10
            hit = np.flatnonzero(np.abs(dv[1:]).sum(1))
            s = np.array([x for i in hit for x in own[i]], np.int64)
            if len(s):
                ds = np.repeat(dv[1:][hit], [len(own[i]) for i in hit], axis=0)
                uniq, inv = np.unique(s, return_inverse=True)
                total = np.zeros((len(uniq), DIM), np.float32)
                np.add.at(total, inv, ds)
                table_speed[uniq] += (total ** 2).mean(1)
                m.table[uniq] -= 5 * RATE * total / (np.sqrt(table_speed[uniq])[:, None] + 1e-6)
    hold = np.flatnonzero(aside) if aside.any() else rows
    z, langs = m.logits([texts[i] for i in hold])
    langs = np.array(langs)
    m.common = _cut(z, y[hold])
    for k in LANGUAGES:
        of = langs == k
        if 0 < y[hold][of].sum() < of.sum():
            trust = y[hold][of].sum() / (y[hold][of].sum() + 10)
            m.thresholds[k] = float(trust * _cut(z[of], y[hold][of]) + (1 - trust) * m.common)
    return m


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER,
        max_words: int = MAX_WORDS) -> Model | None:
    """Trains on at most ``max_toxic`` + ``max_other`` labelled rows for which ``learnable`` holds, whole texts of at most
    ``6 * max_words`` bytes in all, each class in proportion to its rows (one text of each class at least). None without both classes."""
    known = samples.one_label(labels, label_col, id_col).where(learnable)
    got: list = []
    for lab, n in ((1, max_toxic), (0, max_other)):
        ids = samples.sample_ids(known.where(F.col("label") == lab), n, id_col)
        room = 6 * max_words * n // (max_toxic + max_other)
        got += [(zlib.crc32(str(i).encode()), t, lab) for i, t in samples.texts(docs, ids, id_col, text_col, max_total=room)]
    got.sort()
    if len({lab for _, _, lab in got}) < 2:
        return None
    return train([t for _, t, _ in got], [lab for _, _, lab in got])


def scorer(spark, model: Model | None):
    """A pandas UDF from text to score. The model (a few MB, sizes fixed above) is broadcast."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        for s in batches:
            if m is None:
                yield pd.Series(np.zeros(len(s)))
                continue
            texts, out, at = s.tolist(), [], 0
            while at < len(texts):  # bounded memory: about a million characters at a time
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) < 1_000_000):
                    chars += len(texts[to])
                    to += 1
                out.append(m.scores(texts[at:to]))
                at = to
            yield pd.Series(np.concatenate(out) if out else np.zeros(0), dtype=float)

    return scored


def score(docs: DataFrame, model: Model | None, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    return samples.score_columns(scorer(docs.sparkSession, model), docs, id_col, text_col, held_out)


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with their own columns."""
    fn = scorer(docs.sparkSession, model)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), fn(F.coalesce(F.col(text_col), F.lit(""))).alias("_score"))
    return rows.where("_score < 0.5").select("_row.*")
