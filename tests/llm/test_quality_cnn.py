"""The network: coverage of whole texts, exact gradients, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from diffloom.llm import quality_cnn as C
from diffloom.llm import queries as Q

SF = "/root/testdata/sf0.01"


def small_net(seed=1):
    rng = np.random.default_rng(seed)
    return C.Net(rng.normal(size=(256, C.DEPTH)), rng.normal(size=(C.FILTERS, C.WIDTH, C.DEPTH)), rng.normal(size=C.FILTERS),
                 rng.normal(size=(3, C.FILTERS)), rng.normal(size=1))


def test_chunks_cover_everything():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(1, 256, n).astype(np.uint8)) for n in (0, 1, 511, 512, 513, 1016, 1017, 5000, 20_000)]
    data, first = C.chunks(texts)
    for t, a, b in zip(texts, first, np.append(first[1:], len(data))):
        assert b - a >= 1
        seen = {bytes(c[k:k + C.WIDTH]) for c in data[a:b] for k in range(C.CHUNK - C.WIDTH + 1)}
        assert all(t[k:k + C.WIDTH] in seen for k in range(len(t) - C.WIDTH + 1))


def test_probability_is_plain():
    net = small_net()
    for text in (b"", b"abc", b"the quick brown fox " * 80):
        data, _ = C.chunks([text])
        vectors = []
        for chunk in data:
            best = [max(float((net.embedding[chunk[k:k + C.WIDTH]] * f).sum()) for k in range(0, C.CHUNK - C.WIDTH + 1, C.STRIDE))
                    for f in net.filters]
            vectors.append(np.maximum(np.array(best) + net.bias, 0))
        v = np.array(vectors)
        z = (np.stack([v.mean(0), v.max(0), v.min(0)]) * net.unit).sum() + net.offset[0]
        assert C.probability(net, [text])[0] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), rel=1e-3, abs=1e-9)


def test_gradient_is_a_difference(monkeypatch):
    net = small_net(5)
    net.unit *= 0.01
    net.filters *= 0.2
    texts, labels = [b"some words here " * 60, b"###$$$ other" * 3], np.array([1.0, 0.0])

    def loss():
        p = C.probability(net, texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    got = C.gradient(net, texts, labels)
    for part, g, at in ((net.unit, got[3], (0, 3)), (net.unit, got[3], (1, 7)), (net.offset, got[4], (0,)), (net.bias, got[2], (2,))):
        keep = part[at]
        part[at] = keep + 1e-2
        up = loss()
        part[at] = keep - 1e-2
        down = loss()
        part[at] = keep
        assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=1e-4)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.op2_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 1000
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.95 * len(good)
    assert np.mean([[g.score > b.score for b in bad] for g in good]) >= 0.85  # a few hundred training texts


def test_odd_rows(spark):
    texts = [(None, "no id"), (1, None), (2, ""), (3, "x" * 300_000), (4, "same"), (4, "same"), (5, "\x00\x00"), (6, "é" * 700)]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in texts], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame([(2, 1), (4, 0), (3, None), (None, 1), (99, 1), (4, 0)], "doc_id long, quality int")
    net = C.fit(df, labels)
    rows = df.select("doc_id", C.score(F.col("text"), net).alias("s")).collect()
    assert len(rows) == len(texts) and all(0 <= r.s <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.s)
    assert len(by[4]) == 1 and by[1] == by[2]
    none = C.fit(df, labels.limit(0))
    assert {r.s for r in df.select(C.score(F.col("text"), none).alias("s")).collect()} == {0.5}
    assert df.limit(0).select(C.score(F.col("text"), none)).count() == 0
