"""The vectorised trie against plain PPM with exclusion; the unigram base against plain counts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from diffloom.llm import ppm
from diffloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


def tables(texts, order):
    out = [{} for _ in range(order + 1)]
    for t in texts:
        data = b"\0" * order + t + b"\0"
        for at in range(order, len(data)):
            for k in range(order + 1):
                out[k].setdefault(data[at - k:at], Counter())[data[at]] += 1
    return out


def plain(text, counts, order):
    data, total = b"\0" * order + text + b"\0", 0.0
    for at in range(order, len(data)):
        barred = set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= math.log10(256 - len(barred))
                break
            seen = {s: n for s, n in counts[k].get(data[at - k:at], {}).items() if s not in barred}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[at] in seen:
                total += math.log10(seen[data[at]] / whole)
                break
            total += math.log10(len(seen) / whole)
            barred |= set(seen)
    return total


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def fold(i):
    return -1 if i is None else zlib.crc32(str(i).encode()) % 5


def expected(rows, order):
    train = [t for i, t in rows if fold(i) != 1]
    counts = Counter(w for t in train for w in [*words(t), ""])
    n, v = sum(counts.values()), len(counts)
    model = tables([(t or "").encode().lower() for t in train], order)
    out = []
    for i, t in rows:
        own = [*words(t), ""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((str(i), fold(i) == 1, len(own), sum(counts[w] > 0 for w in own), n, base,
                    plain((t or "").encode().lower(), model, order)))
    return sorted(out)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def rows_of(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect())


def test_trie_is_plain():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abcab \xc3\xa9\x00") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for order in (0, 2, 5):
        held, n = np.unique(np.concatenate([ppm.strings([t], order)[0] for t in texts]), return_counts=True)
        keys, counts = [], []
        for k in range(order + 1):
            key, place = np.unique(held & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            keys.append(key)
            counts.append(np.bincount(place, n, len(key)))
        trie, model = ppm.Trie(keys, counts), tables(texts, order)
        others = [bytes(rng.choice(b"abcd \xc3\xa9\x00") for _ in range(50)) for _ in range(20)]
        grams, begins = ppm.strings(texts + others, order)
        got = np.add.reduceat(trie.score(grams), begins)
        assert got == pytest.approx([plain(t, model, order) for t in texts + others])


def test_probabilities_sum_to_one():
    texts = [b"the cat sat on the mat", b"the hat", b""]
    order = 3
    held, n = np.unique(ppm.strings(texts, order)[0], return_counts=True)
    parts = [np.unique(held & ((1 << 8 * (k + 1)) - 1), return_inverse=True) for k in range(order + 1)]
    trie = ppm.Trie([p[0] for p in parts], [np.bincount(p[1], n) for p in parts])
    for context in (b"the", b"at ", b"xyz", b"\0\0\0", b"zat"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        assert (10.0 ** trie.score(grams)).sum() == pytest.approx(1.0)


def test_adaptive_learns():
    assert ppm.adaptive(b"abcabcabc" * 20, 3) / 180 > ppm.adaptive(bytes(range(97, 122)), 3) / 25
    assert ppm.adaptive(b"", 3) == pytest.approx(-math.log10(256))


ODD = [(None, "No id Here"), (1, None), (2, ""), (3, " \n"), (4, "Same text"), (4, "Same text"), (5, "É" * 500 + " È"),
       (6, "a b c " * 3000), (7, "never seen elsewhere qqq"), (8, "x" * 300_000), (9, "tab\x0bsep\x0c\x1cz"), (11, "Same text")]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, "w") for r in ODD], "doc_id long, text string, score int, words string")
    for head in (0, 3, 1000):
        same(rows_of(ppm.language_model(df, order=2, head_words=head)), expected(ODD, 2))
    assert ppm.language_model(df.limit(0)).count() == 0
    only = ppm.language_model(df.filter("doc_id in (1, 2, 7)").withColumn("doc_id", F.lit(10)))  # all held out
    assert fold(10) == 1
    rows = only.collect()
    assert {r.train_tokens for r in rows} == {0} and all(r.n_known == 0 and r.score < 0 for r in rows)


def test_bounded_trie_still_scores_everything(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    small = ppm.fit(df, 4, 2000)
    assert sum(map(len, small.keys)) <= 2000
    grams, begins = ppm.strings([b"some text that is scored whole"], 4)
    assert np.isfinite(small.score(grams)).all()
    for k in range(1, 5):  # what a longer context has seen, a shorter one has
        assert np.isin(small.keys[k] & ((1 << 8 * k) - 1), small.keys[k - 1]).all()


def test_every_count_is_used_whatever_is_broadcast(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(["abc", "ab", "ca", " ", "é", "x", f"{i}"]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100 + i, "new " + "".join(rng.choice("abqzw ") for _ in range(30))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for order, most in ((5, 40), (5, 0), (3, 40), (0, 3)):
        same(rows_of(ppm.language_model(df, order=order, most=most)), expected(rows, order))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(rows_of(ppm.language_model(df, order=3)), expected(rows, 3))
    got = Q.op7_language_model(spark, SF)
    assert got.count() == 200 and got.filter("score >= 0 or base_score >= 0").count() == 0
