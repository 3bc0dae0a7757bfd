"""Budgets against a plain water level, selection against a plain prefix, and the query against SQL."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from diffloom.llm import catalog
from diffloom.llm import mixing as M
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


def share(budget, children):
    """{child: (cap, weight)} -> {child: tokens}: full children one after another, then by weight."""
    out, left = {}, dict(children)
    while left:
        total = sum(w for _, w in left.values())
        full = [c for c, (cap, w) in left.items() if cap * total <= budget * w]
        if not full:
            return out | {c: budget * w // total for c, (_, w) in left.items()}
        c = min(full, key=lambda x: (left[x][0] / left[x][1], x))
        out[c] = left.pop(c)[0]
        budget -= out[c]
    return out


def plain(rows, weights, seed, max_epochs, percent):
    """rows: (id, (a, b, c), tokens) -> sorted (id, epoch)."""
    have = defaultdict(int)
    for _, path, n in rows:
        for k in range(4):
            have[path[:k]] += n
    found = {(): have[()] * percent // 100}
    for depth in range(3):
        for node in [p for p in found if len(p) == depth]:
            kids = {p[depth]: (have[p] * max_epochs, weights[depth].get(p[depth], weights[depth].get("*", 1)))
                    for p in have if len(p) == depth + 1 and p[:depth] == node and has_tokens(have, p)}
            found |= {(*node, c): b for c, b in share(found[node], {c: v for c, v in kids.items() if v[1] > 0}).items()}
    out = []
    for leaf in [p for p in found if len(p) == 3]:
        epochs, rest = divmod(found[leaf], have[leaf])
        own = [(i, n) for i, p, n in rows if p == leaf]
        out += [(i, e) for i, _ in own for e in range(epochs)]
        by_key = defaultdict(list)
        for i, n in own:
            by_key[hashlib.md5(f"{seed}:{epochs}:{'null' if i is None else i}".encode()).hexdigest()].append((i, n))
        until = 0
        for key in sorted(by_key):
            until += sum(n for _, n in by_key[key])
            if until > rest or not rest:
                break
            out += [(i, epochs) for i, _ in by_key[key]]
    return sorted(out, key=str), found


def has_tokens(have, path):
    return have[path] > 0


W = [{"x": 70, "y": 20, "*": 5, "none": 0}, {"en": 3, "*": 1}, {"*": 1}]


@pytest.mark.parametrize("percent,max_epochs", [(30, 1), (60, 2), (150, 2), (90, 1), (200, 2), (500, 3)])
def test_against_plain(spark, percent, max_epochs):
    rng = random.Random(percent)
    rows = []
    for i in range(400):
        a = "y" if i % 3 else rng.choice(["x", "y", "z", None, "none"])
        rows.append((None if i == 77 else i // 2 if i < 20 else i, a, rng.choice(["en", "de", None]), rng.choice("pqr"),
                     None if i == 5 else rng.choice([0, 1, 10, 500])))
    df = spark.createDataFrame([(*r, 9, "c") for r in rows], "doc_id long, d string, l string, s string, n long, epoch int, cut string")
    got = M.mix(df, ["d", "l", "s"], {"d": W[0], "l": W[1], "s": W[2]}, "n", seed=3, max_epochs=max_epochs, percent=percent)
    assert sorted(got.columns) == sorted(df.columns)
    want, found = plain([(i, (a or "", b or "", c), n or 0) for i, a, b, c, n in rows], W, 3, max_epochs, percent)
    assert sorted(((r.doc_id, r.epoch) for r in got.collect()), key=str) == want
    spent = got.agg(F.sum("n")).first()[0] or 0
    assert spent <= found[()]


def test_shortage_stays_among_siblings(spark):
    rows = [("x", "en", "small", 10), ("x", "en", "big", 10_000), ("x", "de", "only", 10_000), ("y", "en", "other", 10_000)]
    leaves = spark.createDataFrame(rows, "a string, b string, c string, have long")
    weights = {"a": {"x": 1, "y": 1}, "b": {"en": 1, "de": 1}, "c": {}}
    got = {r.c: r.budget for r in M.budgets(leaves, ["a", "b", "c"], weights, F.lit(4000), 1).collect()}
    assert got == {"small": 10, "big": 990, "only": 1000, "other": 2000}
    got = {r.c: r.budget for r in M.budgets(leaves, ["a", "b", "c"], weights, F.lit(40_000), 1).collect()}
    assert got == {"small": 10, "big": 10_000, "only": 10_000, "other": 10_000}


def test_empty_and_tokenless(spark):
    df = spark.createDataFrame([(1, "x", "y", "z", 0), (2, None, None, None, None)], "doc_id long, d string, l string, s string, n long")
    assert M.mix(df, ["d", "l", "s"], {}, "n").count() == 0
    assert M.mix(df.limit(0), ["d", "l", "s"], {}, "n").count() == 0


def test_query_is_sql(spark):
    r = compare(catalog.queries()["op4_mixing"](spark, SF), catalog.oracle_sql()["op4_mixing"], duck(SF))
    assert r["cols_match"] and r["hash_match"], r


def test_native(spark):
    plan = catalog.queries()["op4_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
