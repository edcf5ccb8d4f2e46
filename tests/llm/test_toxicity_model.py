"""The toxicity model against plain loops: convolution, gradients, rows kept aside, and scores that don't depend on neighbours."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from asrprep.llm import samples, toxicity
from asrprep.llm.toxicity import DIM, FILTERS, WIDTHS, Model


def small_model(rng, kind=np.float64):
    n_out = FILTERS * len(WIDTHS)
    return Model(np.zeros(toxicity.SLOTS, np.uint64), np.zeros((toxicity.SLOTS, DIM), kind),
                 [rng.normal(0, 0.5, (k, DIM, FILTERS)).astype(kind) for k in WIDTHS], rng.normal(0, 0.1, n_out).astype(kind),
                 rng.normal(0, 0.5, n_out).astype(kind), -0.2, {}, 0.0)


def plain_pooled(m, v, doc):
    out = []
    for f, width in zip(m.filters, WIDTHS):
        padded = list(doc) + [0] * max(WIDTHS)
        windows = [sum(v[padded[i + j]] @ f[j] for j in range(width)) for i in range(len(doc) + 1)]
        out.append(np.max(windows, axis=0))
    return np.concatenate(out)


def drawn(rng):
    v = rng.normal(0, 1, (9, DIM))
    v[0] = 0
    return v, [np.array(d, np.int64) for d in ([], [1], [2, 3], [4, 5, 6, 7, 8, 1], [1], [8, 8, 8])]


def test_pooled_values_equal_plain_convolution():
    rng = np.random.default_rng(3)
    m, (v, docs) = small_model(rng), drawn(rng)
    got = np.concatenate(m.pooled(v, docs)[3], axis=1)
    assert np.allclose(got, [plain_pooled(m, v, d) for d in docs])
    assert np.allclose(got[1], got[4])  # the same document, other neighbours


def loss(m, v, docs, y, weight):
    z = np.array([np.maximum(plain_pooled(m, v, d) + m.bias, 0) @ m.out + m.out_bias for d in docs])
    p = 1 / (1 + np.exp(-z))
    return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).mean() + 5e-5 * (m.out ** 2).sum())


def test_gradients_equal_differences_of_the_plain_loss():
    rng = np.random.default_rng(4)
    m, (v, docs) = small_model(rng), drawn(rng)
    y, weight = np.array([0, 1, 0, 1, 1, 0.0]), np.array([1, 2, 1, 2, 2, 1.0])
    grads, bias, dv = toxicity.gradients(m, v, docs, y, weight)

    def difference(change):
        change(1e-6)
        up = loss(m, v, docs, y, weight)
        change(-2e-6)
        down = loss(m, v, docs, y, weight)
        change(1e-6)
        return (up - down) / 2e-6

    for array, grad in [(m.out, grads[id(m.out)]), (m.bias, grads[id(m.bias)]), *[(f, grads[id(f)]) for f in m.filters], (v[1:], dv[1:])]:
        for at in rng.choice(array.size, 25, replace=False):
            place = np.unravel_index(at, array.shape)

            def change(d, array=array, place=place):
                array[place] += d
            assert abs(difference(change) - grad[place]) < 1e-5

    def change_bias(d):
        m.out_bias += d
    assert abs(difference(change_bias) - bias) < 1e-5


def test_rows_kept_aside_teach_nothing():
    """Random labels, and words that only rows kept aside hold: the model can't tell these rows apart."""
    rnd = random.Random(5)
    n = 600
    y = np.array([rnd.random() < 0.4 for _ in range(n)], np.float32)
    aside = toxicity.kept_aside(y)
    assert aside[y == 1].sum() == (y == 1).sum() // 5 and aside[y == 0].sum() == (y == 0).sum() // 5
    texts = [" ".join(("aside" if a else "train") + "".join(rnd.choice("bcdfg") for _ in range(3)) + str(int(lab) if a else "")
                      for _ in range(20)) for a, lab in zip(aside, y)]
    m = toxicity.train(texts, [int(x) for x in y])
    z, _ = m.logits([t for t, a in zip(texts, aside) if a])
    lab = y[aside]
    pairs = (z[lab == 1][:, None] - z[lab == 0][None, :])
    auc = ((pairs > 0) + 0.5 * (pairs == 0)).mean()
    assert abs(auc - 0.5) < 0.1
    assert not toxicity.kept_aside(np.array([1, 1, 0, 0, 0, 0, 0, 0], np.float32)).any()


def test_score_is_a_documents_own():
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(12))) + (" vilest" if i % 3 == 0 else "") for i in range(300)]
    m = toxicity.train(texts, [int(i % 3 == 0) for i in range(300)])
    together = m.scores(texts + [""])
    assert np.allclose(together, [m.scores([t])[0] for t in texts + [""]], atol=1e-6)


def test_sample_is_bounded_before_it_is_collected(spark):
    rows = [(i, "x" * 1000) for i in range(50)] + [(50, "y" * 300_000), (51, None), (3, "x" * 999)]
    docs = spark.createDataFrame(rows, "key long, text string").withColumn("id", F.lit("clash"))
    ids = samples.sample_ids(docs, 100, "key")
    got = samples.texts(docs, ids, "key", max_total=10_500)
    every = samples.texts(docs, ids, "key")
    assert len(every) == 51 and got == every[:len(got)] and 10 <= len(got) <= 11
    assert dict(every)[3] == "x" * 999 and dict(every)[51] == "" and 50 not in dict(every)
    order = [zlib.crc32(b"%d" % k) for k, _ in every]
    assert order != sorted(order)
    assert len(samples.texts(docs, ids, "key", max_total=1)) == 1 and samples.texts(docs.limit(0), ids, "key") == []
