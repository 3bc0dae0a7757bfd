"""Links against all pairs, large near-copy groups, and odd tables."""

import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from diffloom.llm import ngram_join as J


def plain_set(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2)))


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        i = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * i >= 90 * (len(sets[a]) + len(sets[b]) - i):
            up[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted(((doc, len(s), least.get(root(k)) if s else doc) for k, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def found(df):
    return sorted((tuple(r) for r in J.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def made(rng):
    """Texts with copies that differ by a few words, around the threshold, and passages that many share."""
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        texts.append(base)
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1, 4)):
                k = rng.randrange(len(copy))
                copy[k:k + 1] = rng.choice([[], [rng.choice(words)], [copy[k], rng.choice(words)]])
                copy = copy or ["x"]
            texts.append(copy)
    out = [" ".join(t).upper() if rng.random() < 0.1 else "\n ".join(t) for t in texts]
    return out + [passage, passage + " more", *(f"{passage} {t}" for t in out[:10])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = made(rng)
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    rows = [*zip(ids, texts), (7, None), (8, ""), (9, " \t\n"), (10, "one"), (11, "ONE"), (12, "one two"), (13, "two one"), (None, texts[0]), (None, "zz yy xx"),
            (100, "same id and other text of this row"), (100, "same id and other text of this row")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_large_group_of_near_copies(spark):
    """Each of 300 texts differs from the next in one word; all are connected, without all their pairs."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for k in range(300):
        text = list(base)
        text[k % 300] = f"change{k}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, " ".join(base[:290])) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(rows)
    members, linked = J.links(df)
    assert linked.count() < 10 * len(rows)


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "q r s t")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named = df.withColumn("id", F.lit("x")).withColumn("cls", F.lit(1)).withColumn("component_id", F.lit(5)).withColumn("SIZE", F.lit(0))
    assert found(named) == [(1, 2, 1), (2, 2, 1), (3, 2, 3)]
    assert found(df.limit(0)) == []


def test_long_text(spark):
    rng = random.Random(5)
    words = [f"x{rng.randrange(50_000)}" for _ in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:190_000])), (3, " ".join(words[:150_000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in found(df)] == [1, 1, 3]


def test_prefix_and_order():
    assert [J.prefix_length(n) for n in (1, 9, 10, 11, 100)] == [1, 1, 2, 2, 11]
    counters = np.zeros(1 << J.SKETCH_BITS, np.int64)
    s = np.array([1 << 50, 2 << 50, 3 << 50], np.uint64)
    counters[(s >> np.uint64(64 - J.SKETCH_BITS)).astype(int)] = [5, 1, 5]
    assert J.rare_first(s, counters).tolist() == [2 << 50, 1 << 50, 3 << 50]


def test_shared_shingles_come_in_one_order():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 200))) for _ in range(40)]
    counters = np.zeros((2, 1 << J.SKETCH_BITS), np.uint32)
    words = J.lower_words([t.encode() for t in texts])
    np.add.at(counters[0], J._slot(np.concatenate(J.shingle_sets([t.encode() for t in texts]))), 1)
    np.add.at(counters[1], J._slot(words.hash), 1)
    found = list(J._ordered_sets(texts, *J.rarity(counters)))
    for (a, x), (b, y) in itertools.combinations(found, 2):
        assert sorted(x.tolist()) == a.tolist()
        both = set(a.tolist()) & set(b.tolist())
        assert [t for t in x.tolist() if t in both] == [t for t in y.tolist() if t in both]


def test_parities_bound_the_distance():
    rng = np.random.default_rng(6)
    for n in (1, 2, 31, 32, 33, 500, 4000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[n // 10:], rng.integers(0, 1 << 63, n // 8).astype(np.uint64))))
        x, y = J.parities(a), J.parities(b)
        assert 2 * len(a) <= 64 * len(x) and (len(x) == 1 or 64 * len(x) < 4 * len(a))
        if len(x) != len(y):
            x, y = (x[:len(y)] ^ x[len(y):], y) if len(x) > len(y) else (x, y[:len(x)] ^ y[len(x):])
        unlike = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())  # of signed numbers it counts their absolute value
        distance = len(np.setxor1d(a, b))
        assert unlike <= distance
        assert n < 500 or unlike >= 0.7 * distance  # few collide in large sets


def test_percent_below_half(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:170])), (3, " ".join(words[:90])), (4, " ".join(words[300:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.near_duplicates(df, percent=40).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_counters_of_shingles_follow_the_table(spark, tmpdir_path, monkeypatch):
    assert J.sketch_bits(1) == J.sketch_bits(J.SKETCH_BYTES) == J.sketch_bits(1 << 62) == J.SKETCH_BITS
    assert J.sketch_bits(J.SKETCH_BYTES + 1) == J.SKETCH_BITS + 1
    assert J.sketch_bits(1 << 50) == J.MAX_SKETCH_BITS
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words)] * 2 + [" ".join(words[1:])] + [" ".join(words[:40])] + [" ".join(words[k:k + 30]) for k in range(8)] + ["", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmpdir_path}/documents")
    made, seen = J._counters, []
    monkeypatch.setattr(J, "SKETCH_BYTES", 1)
    monkeypatch.setattr(J, "_counters", lambda *args: seen.append(made(*args)) or seen[-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(spark.read.parquet(f"{tmpdir_path}/documents")).collect()}
    assert got == {0: (58, 0), 1: (58, 0), 2: (57, 0), 3: (38, 3), 12: (0, 12), 13: (0, 13)} | {k: (28, 4) for k in range(4, 12)}
    of_shingles, of_words = np.split(seen[0].value, [1 << J.MAX_SKETCH_BITS])
    assert of_words.size == 1 << J.SKETCH_BITS
    assert of_shingles.sum() == sum(n for n, _ in got.values())


@pytest.mark.parametrize("largest", [0, 1, 255, 256, 65_535, 65_536, (1 << 32) - 1])
def test_packed_counters(largest):
    counts = np.zeros(J.CHUNK, np.int64)
    counts[7::97] = largest
    assert (J.unpacked(J.packed(counts)) == counts).all()
    assert (J.unpacked(J.packed(counts + (1 << 32))) == (1 << 32) - 1).all()


def test_a_task_writes_its_counters_packed():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 80)) for _ in range(2000)]
    made = pd.concat(J._classes_and_counts(iter([pd.DataFrame({"id": range(len(texts)), "text": texts})]), J.MAX_SKETCH_BITS))
    counted = made[made["kind"] == 1].sort_values("chunk")
    # about 160,000 counts in five million counters: well below the counters' 20 MB, as plain numbers
    assert counted["counts"].map(len).sum() < 1 << 20
    twice = pd.concat([counted, counted]).sort_values("chunk")
    added = pd.concat(J._added(iter([twice.iloc[:5], twice.iloc[5:]])))
    assert sum(int(J.unpacked(c).sum()) for c in added["counts"]) == 2 * (sum(made["size"]) + 80 * len(texts))
