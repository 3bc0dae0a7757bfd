"""Repairs against an exhaustive programme over rows; blocks and rounds against one piece; odd tables."""

import hashlib
import random
import re
from functools import lru_cache

from pyspark.sql import functions as F

from diffloom.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_fault(rows):
    """(initial, fault) for each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "k" if body[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((role[:1] if role[:1] in ("s", "u", "a") else "-", fault))
    return out


def plain_best(rows):
    """(cost, audit) of the cheapest edits by trying all, from the last row backwards."""
    next_state = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserted < 3:  # more in a row never help
            for x in "ua":
                if (state, x) in next_state and (rest := best(i, next_state[state, x], inserted + 1)):
                    found.append((rest[0] + 5, "I" + rest[1]))
        if i < len(rows):
            initial, fault = rows[i]
            if rest := best(i + 1, state, 0):
                found.append((rest[0] + 2, "D" + rest[1]))
            if fault not in "bd":
                for x in "sua":
                    if (state, x) in next_state and (rest := best(i + 1, next_state[state, x], 0)):
                        more = 5 if fault == "t" else 0
                        if x == initial:
                            found.append((rest[0] + more, "K" + rest[1]))
                        elif x != "s":
                            found.append((rest[0] + 1 + more, "R" + rest[1]))
        return min(found) if found else None

    return best(0, 0, 0)


def plain_messages(rows, audit):
    out, k = [], 0
    place = -(len(audit.replace("D", "")) % 2)
    for e in audit:
        role, text = rows[k] if e != "I" else ("", "")
        k += e != "I"
        if e != "D":
            out.append(f"{role if e == 'K' else ('user', 'assistant')[place % 2]}:{text}")
            place += 1
    return out


def made(rng, n):
    texts = ["Yes.", "no", "", " ", "What?", "Go on", "Fine! ", "It is\n", "end.\t"]
    return [(rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]), rng.choice(texts) + rng.choice(["", "", "x.", " y"])) for _ in range(n)]


def test_block_spans_are_lightest():
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 5, 8, 12]:
        for _ in range(60):
            rows = plain_fault(made(rng, n))
            found = C.goal(C.block_spans("".join(i + f for i, f in rows)))
            assert found == plain_best(tuple(rows)), rows


def test_joined_spans_are_those_of_one_block():
    rng = random.Random(6)
    for _ in range(40):
        signature = "".join(i + f for i, f in plain_fault(made(rng, 12)))
        cuts = sorted(rng.sample(range(1, 12), 3))
        parts = [signature[2 * a:2 * b] for a, b in zip([0, *cuts], [*cuts, 12])]
        assert sorted(C.joined_spans([C.block_spans(p) for p in parts])) == sorted(C.block_spans(signature))


def test_agenda_pops_in_order():
    popped = []

    def deduce(item, done):
        popped.append(done[item])
        if item[0] < 3:
            yield (item[0] + 1,), done[item], (1, "x")

    done = C.lightest([((0,), (0, "")), ((2,), (9, "z"))], deduce, lambda item: item[0])
    assert done[(2,)] == (2, "xx") and popped == sorted(popped)


def check(spark, tables, **named):
    rows = [(conv, turn, *r) for conv, own in tables.items() for turn, r in enumerate(own)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    report = C.repair(df).cache()
    shas = {r[0]: r[1] for r in C.digests(df, report).collect()}
    messages = {}
    for r in sorted(C.repaired(df, report).collect(), key=lambda r: r.place):
        messages.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    found = {r.conv: r for r in report.collect()}
    assert set(found) == set(tables)
    for conv, own in tables.items():
        faults = plain_fault(own)
        cost, audit = plain_best(tuple(faults))
        r = found[conv]
        assert (r.cost, r.audit) == (cost, audit)
        assert (r.blank, r.duplicate, r.truncated) == tuple(sum(f == c for _, f in faults) for c in "bdt")
        pairs = [a + b for (a, _), (b, _) in zip(faults, faults[1:])]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        assert messages.get(conv, []) == plain_messages(own, audit)
        assert shas[conv] == hashlib.sha256("\n".join(plain_messages(own, audit)).encode()).hexdigest()
        initials = "".join(m[0] for m in messages.get(conv, []))
        assert re.fullmatch("(s?(ua)+)?", initials)
    report.unpersist()


def test_conversations_against_plain(spark):
    rng = random.Random(7)
    check(spark, {c: made(rng, rng.randrange(1, 14)) for c in range(40)})


def test_long_conversations_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 4)
    monkeypatch.setattr(C, "FAN", 2)
    rng = random.Random(8)
    check(spark, {0: made(rng, 150), 1: made(rng, 3), 2: made(rng, 41)})


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, None), (None, 3, "user", "Hi."), (1, 5, "user", "A."), (1, 5, "user", "A."),
                                (1, None, "assistant", "B."), (2, 1, "", "é" * 200_000 + "."), (3, -4, "sys", "?"), (3, 9, "user", "x")], SCHEMA)
    df = df.withColumn("conv", F.lit("extra")).withColumn("audit", F.lit(1)).withColumn("CLS", F.lit(2))
    report = {r.conv: r for r in C.repair(df).collect()}
    assert set(report) == {None, 1, 2, 3}
    assert report[None].blank == 1 and report[None].gaps == 0 and report[None].illegal == 1  # " " before "u"
    assert (report[1].duplicate, report[1].gaps, report[1].illegal) == (1, 0, 1)  # a, u, u: the null turn is first
    assert report[1].cost == plain_best((("a", "k"), ("u", "k"), ("u", "d")))[0]
    assert report[2].audit == plain_best((("-", "k"),))[1]
    assert report[3].gaps == 12 and report[3].truncated == 1
    empty = df.limit(0)
    assert C.repair(empty).collect() == [] and C.digests(empty, C.repair(empty)).collect() == []


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "A. b!") for c in range(30) for t in range(4)] + [(None, None, None, None)], SCHEMA)
    import zlib

    expected = []
    for c, t, role, text in rows.collect():
        words = [" " if v is None else str(v) for v in (c, t, role, text)]
        k = zlib.crc32(f"{words[0]}:{words[1]}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", words[3])}.get(k, words[3])
        expected += [(str(c), str(t), "user" if k == 4 else words[2], text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in C.damaged(rows).collect()) == sorted(expected)
