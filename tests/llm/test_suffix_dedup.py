"""Spans against all shared 50-word windows; minimisers; borders of partitions; odd rows."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from diffloom.llm import queries as Q
from diffloom.llm import suffix_dedup as S
from diffloom.llm.common import Words

SF = "/root/testdata/sf0.01"


def shared_words(rows):
    """{id: words that lie in a 50-word window that another document has too}, and the words' places."""
    texts = [(i, t, [(m.start(), m.end()) for m in re.finditer("[^\x20\x09-\x0D]+", t or "")]) for i, t in rows]
    where = defaultdict(set)
    windows = []
    for i, t, w in texts:
        key = i if i is not None else ("none", t)
        own = [" ".join(t[a:b] for a, b in w[k:k + 50]) for k in range(len(w) - 49)]
        windows.append(own)
        for x in own:
            where[x].add(key)
    out = defaultdict(set)
    for (i, t, w), own in zip(texts, windows):
        for k, x in enumerate(own):
            if len(where[x]) > 1:
                out[i, t] |= {w[j] for j in range(k, k + 50)}
    return out, {(i, t): w for i, t, w in texts}


def check(rows, got, least=0.995):
    """Spans hold nothing but shared words; every document with a shared passage of 51 words is there,
    and nearly all shared words are inside spans."""
    want, words = shared_words(rows)
    found = defaultdict(set)
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(t)
    for r in got:
        for t in texts[r.doc_id]:
            inside = [w for w in words[r.doc_id, t] if w[0] >= r.start and w[1] <= r.end]
            if inside and inside[0][0] == r.start and inside[-1][1] == r.end:
                found[r.doc_id, t] |= set(inside)
        assert r.n_words >= 50
    for k, v in found.items():
        assert v <= want[k]
    run = lambda v: max((b for _, b in stretches(v)), default=0)
    order = {k: {w: n for n, w in enumerate(ws)} for k, ws in words.items()}

    def stretches(places):
        out = []
        for p in sorted(places):
            out[-1:] = [(p, out[-1][1] + 1)] if out and out[-1][0] == p - 1 else out[-1:] + [(p, 1)]
        return out

    for k, v in want.items():
        if v and k not in found:
            assert run([order[k][w] for w in v]) < 51, k
    assert sum(map(len, found.values())) >= least * sum(map(len, want.values()))
    assert len(found) >= least * sum(bool(v) for v in want.values())


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Q.op5_suffix_dedup(spark, SF).collect()
    check(rows, got)
    assert all(r.other_doc_id != r.doc_id for r in got)


def made(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [say(rng.choice([30, 49, 50, 51, 60, 75, 200])) for _ in range(12)]
    out = []
    for i in range(docs):
        words = say(rng.randint(0, 40))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 3) if rng.random() < 0.3 else 0
            words += p[a:] + say(rng.randint(0, 30))
        out.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_made_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(S, "TASK_ROWS", 40)  # many partitions, so many borders
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, S.repeated_spans(df).collect(), 0.9)  # passages of 49 words and parts of others abound


def test_odd_rows(spark):
    rng = random.Random(9)
    long = " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(20_000))
    p = " ".join(f"é{k}" for k in range(60))
    rows = [(1, None), (2, ""), (3, "short text"), (4, p), (4, p), (5, "x " + p + " y"), (None, p + " z"), (None, p + " z"),
            (6, long), (7, long[:60_000]), (8, "the " * 3000), (9, "the " * 49), (10, "only once " + " ".join(map(str, range(99))))]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, start int, doc string")
    got = S.repeated_spans(df).collect()
    ids = {r.doc_id for r in got}
    assert ids == {4, 5, 6, 7, None}
    five = next(r for r in got if r.doc_id == 5)
    assert (five.start, five.end, five.n_words) == (2, 2 + len(p), 60) and five.other_doc_id in (4, None)
    seven = next(r for r in got if r.doc_id == 7)
    assert seven.start == 0 and seven.end >= 59_980 and seven.other_doc_id == 6
    alone = spark.createDataFrame([(4, p), (4, p), (8, "the " * 300)], "doc_id long, text string")
    assert S.repeated_spans(alone).count() == 0
    assert S.repeated_spans(df.limit(0)).count() == 0


def test_minimisers_are_chosen_by_content():
    rng = random.Random(3)
    text = [f"{rng.choice('abcdef')}{rng.randint(0, 30)}" for _ in range(400)]
    for cut in (0, 7, 100):
        whole, part = Words([" ".join(text).encode()]), Words([b"q", " ".join(text[cut:]).encode(), b"z"])
        a = {k - cut for k in S.minimisers(whole).tolist()}
        b = {k - 1 for k in S.minimisers(part).tolist()}
        inner = range(S.WINDOW, 400 - cut - S.WINDOW - 3)
        assert {k for k in a if k in inner} == {k for k in b if k in inner}
    at = S.minimisers(whole)
    assert at.min() < S.WINDOW and np.diff(at).max() <= S.WINDOW
