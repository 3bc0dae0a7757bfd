"""Fingerprints and components against plain Python; the ball join against all pairs."""

import itertools
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from diffloom.llm import queries as Q
from diffloom.llm.simhash import Bucket, ball, components, keep_one, near_duplicates, near_links

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def smallest(nodes, linked):
    """Union-find: each key of ``nodes`` (node -> id) to the smallest id it reaches."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        up[root(a)] = root(b)
    least = {}
    for n, i in nodes.items():
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return {n: least.get(root(n)) for n in nodes}


def expected(rows):
    prints = {k: (i, plain(t)) for k, (i, t) in enumerate(rows)}
    ids = {}
    for i, fp in prints.values():
        have = ids.get(fp)
        ids[fp] = i if have is None else have if i is None else min(i, have)
    linked = [(a, b) for a, b in itertools.combinations(ids, 2) if (a ^ b).bit_count() <= 4]
    owner = smallest(ids, linked)
    return sorted((str(i), f"{fp:016x}", owner[fp]) for i, fp in prints.values())


def test_query_matches_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = Q.op8_simhash(spark, SF).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == expected(map(tuple, rows))


def near(rng, fp, k):
    for bit in rng.sample(range(64), k):
        fp ^= 1 << bit
    return fp


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    fps = set(seeds) | {near(rng, s, rng.randint(1, 6)) for s in seeds for _ in range(8)} | {0, 1, 3, 2**64 - 1}
    fps |= {near(rng, 2**64 - 1, 4) for _ in range(50)}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    want = {frozenset(p) for p in itertools.combinations(fps, 2) if (p[0] ^ p[1]).bit_count() <= 4}
    for bits in (0, 3, 6, 9):
        links = [(r.a % 2**64, r.b % 2**64) for r in near_links(df, bits=bits).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert smallest({f: f for f in fps}, links) == smallest({f: f for f in fps}, map(tuple, want))


def test_slices_of_a_bucket_lose_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 50).astype(np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(0b1011), base ^ np.uint64(1 << 40)]))
    whole = [set(zip(*map(np.ndarray.tolist, Bucket(2, 2).links(b, fps, 4)))) for b in range(4)]
    monkeypatch.setattr("diffloom.llm.simhash.SLICE_VALUES", 500)
    assert [set(zip(*map(np.ndarray.tolist, Bucket(2, 2).links(b, fps, 4)))) for b in range(4)] == whole
    assert len(ball(2)) == 2081


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    loose = [(5000, 4000), (4000, 5000), (4500, 5000), (7, 7)]
    df = spark.createDataFrame(chain + star + loose, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[i] == 1000 for i in range(1001, 1400))
    assert got[5000] == got[4500] == 4000


ROWS = [(5, None), (3, ""), (9, " \n"), (1, "One two"), (2, "one TWO"), (2, "one two"), (None, "one two"), (None, None),
        (20, "x y z w " * 50), (21, "other words in this one " * 9), (30, "lone words of its own kind here " * 3),
        (40, "long " * 60_000), (None, "nothing else is like this null id text at all")]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "a", 1) for r in ROWS], "doc_id long, text string, fp string, component_id int")
    got = near_duplicates(df).collect()
    assert sorted((str(r.doc_id), f"{r.fp % 2**64:016x}", r.component_id) for r in got) == expected(ROWS)
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "20", "21", "3", "30", "40", "None"]
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0
    assert keep_one(df.union(df)).count() == kept.count()
    assert df.filter(F.col("doc_id") == 2).count() == 2
