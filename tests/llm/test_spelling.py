"""Near words against all pairs; the bound of each word against all its edits; odd tables."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from diffloom.llm import spelling as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def vocabulary(rng, n, letters="abé"):
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, 12))) for _ in range(n)}
    for w in list(words)[: n // 2]:  # near ones
        k = rng.randrange(len(w))
        words.add(rng.choice([w[:k] + w[k + 1:], w[:k] + "b" + w[k:], w[:k] + "c" + w[k + 1:]]))
    return sorted(w for w in words if len(w) >= 7)


def plain(words, times=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out, key=str)


@pytest.mark.parametrize("longest", [3, 4, 5])
def test_no_edit_takes_more_grams_than_the_bound(longest):
    rng = random.Random(longest)
    words = vocabulary(rng, 60)
    count = Counter(w[p:p + q] for w in words for q in range(2, longest) for p in range(len(w) - q + 1))
    for least in (0, 5, 20):
        frequent = {g: n for g, n in count.items() if n > least}
        endings = {g[k:] for g in frequent for k in range(1, len(g))}
        for w in words:
            grams = S.decompose(w, frequent, longest)
            bound = len(grams) - S.affected(w, grams, frequent, endings, longest)
            assert bound >= 1 or longest > 3
            edits = {w[:k] + x + w[k + d:] for k in range(len(w) + 1) for d in (0, 1) for x in ("", "a", "b", "é", "z")} - {w}
            for v in edits:
                own = {(side, w[p:e], p if side else len(w) - p) for p, e in grams for side in (0, 1)}
                other = {(side, v[p:e], p if side else len(v) - p) for p, e in S.decompose(v, frequent, longest) for side in (0, 1)}
                shared = {(side, g, k) for side, g, k in own & other}
                kept = sum(1 for p, e in grams if (1, w[p:e], p) in shared or (0, w[p:e], len(w) - p) in shared)
                assert kept >= bound, (w, v)


@pytest.mark.parametrize("least", [0, 3, 10_000])
def test_variants_against_all_pairs(spark, least):
    rng = random.Random(9)
    words = {w: rng.choice([2, 3, 25, 300, 4000]) for w in vocabulary(rng, 200)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = [tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in S.variants(df, least=least).collect()]
    assert sorted(found, key=str) == plain(words)
    assert any(r[3] for r in found)


def test_dictionary_is_bounded(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(w, 2) for w in vocabulary(rng, 500, "abcdefgh")], "word string, n long")
    found = S.frequent_grams(df, least=0, nodes=10)
    assert all(sum(len(g) == q for g in found) <= 10 for q in (2, 3, 4))


def test_words_of_odd_tables(spark):
    schema = "doc_id long, text string, word string, N long"
    rows = [(1, "Übergrößen Übergrößen ABCDEFG abcdefg short", "x", 1), (None, "abcdefg", "x", 1), (2, None, None, None), (3, "", "", 0),
            (4, "wörterbuch1wörterbuch ABCDEFG" + " zzzzzzzz" * 100_000, "x", 1)]
    df = spark.createDataFrame(rows, schema)
    assert {r.word: r.n for r in S.word_counts(df).collect()} == {"Übergrößen": 2, "abcdefg": 4, "wörterbuch": 2, "zzzzzzzz": 100_000}
    twice = S.word_counts(df.union(df)).filter("word = 'abcdefg'").first()
    assert twice.n == 8
    expected = Counter()
    for doc, text, *_ in rows:
        for run in (text or "").replace("1", " ").split():
            run = run.translate(S._LOWER)
            word = S.typo(doc, run)
            expected[word] += len(word) >= 7
    found = {r.word: r.n for r in S.word_counts(df, change=S.typo).collect()}
    assert found == {w: n for w, n in expected.items() if n >= 2}
    empty = S.word_counts(df.limit(0))
    assert S.variants(empty).collect() == []


def test_counts_are_handed_on(spark, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(S, "HELD", 3)
    batches = [pd.DataFrame({"w": list("abcabd")}), pd.DataFrame({"w": list("ab")})]
    parts = list(S._counted(iter(batches), lambda b: ((w, 1) for w in b["w"]), "w"))
    assert len(parts) > 1
    total = Counter()
    for part in parts:
        total.update(dict(zip(part["w"], part["n"])))
    assert total == Counter("abcabdab")


def test_chain_of_forms(spark):
    words = {"abcdefgh": 2, "abcdefgi": 30, "abcdefji": 400, "abcdekji": 5000, "zzzzzzzz": 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    roots = {r.word: r.root for r in S.variants(df).collect()}
    assert roots == {**{w: "abcdekji" for w in words}, "zzzzzzzz": "zzzzzzzz"}
    assert [one_edit(a, b) for a, b in itertools.pairwise(list(words)[:4])] == [True] * 3
