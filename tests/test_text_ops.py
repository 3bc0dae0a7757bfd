"""Filters, issue references, hints, as-of, sampling, packing, recall, tokens (FIXTURES §8)."""

import datetime as dt

from pyspark.sql import functions as F

from diffloom.functions.filters import (contains_commit_hash, contains_hyperlinks, contains_media, is_test_path_words,
                                        max_words, statement_gate)
from diffloom.operators.issues import hints_before_first_commit, resolved_issues, take_until_cutoff
from diffloom.operators.prompts import code_text, pack_context
from diffloom.operators.retrieval import retrieval_recall
from diffloom.operators.sampling import split_even, stop_at_budget
from diffloom.operators.tokens import repetition_flag, train_tokens
from diffloom.operators.versions import asof_join, asof_version_by_order


def col1(spark, rows, expr, schema="t string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(expr).collect()]


def test_gates(spark):
    h = "a" * 0 + "0123456789abcdef0123456789abcdef01234567"
    assert col1(spark, [f"see {h} x", f"url/{h}", f"{h}8", "[0123456789abcdef0123456]"], contains_commit_hash(F.col("t"))) == [True, False, False, True]
    assert col1(spark, ["a .png b", "shot.PNG here", "x.pngs"], contains_media(F.col("t"))) == [False, True, False]
    assert col1(spark, ["go to https://x.y/z", "www.q"], contains_hyperlinks(F.col("t"))) == [True, False]
    w40, w41 = " ".join(["w"] * 40), " ".join(["w"] * 41)
    assert col1(spark, [w40, w41], max_words(F.col("t"), 40)) == [True, False]
    assert col1(spark, [w40, w41], statement_gate(F.col("t"))) == [False, True]
    assert col1(spark, ["src/testing/a.py", "src/latest.py", "testsx/a.py"], is_test_path_words(F.col("t"))) == [True, False, False]


def test_closing_keywords(spark):
    rows = ["fixes #1 and later fixes #2", "Fixes #1 fixes #2", "fixes: #3", "<!-- fixes #4 -->", "héfixes #5",
            "resolves #7\nCloses #8"]
    out = col1(spark, rows, F.array_join(resolved_issues(F.col("t")), ","))
    assert out == ["2", "1,2", "", "", "", "7,8"]


def test_hints_prefix(spark):
    com = spark.createDataFrame([(1, 1, 5, "early"), (1, 2, 20, "late"), (1, 3, 6, "early again"),
                                 (2, 1, 5, "no commit"), (3, 1, 10, "equal")],
                                "pull int, pos int, updated_at int, body string")
    first = spark.createDataFrame([(1, 10), (3, 10)], "pull int, first_commit_at int")
    h = hints_before_first_commit(com, first, keys=("pull",))
    assert sorted((r.pull, r.body) for r in h.collect()) == [(1, "early")]


def test_cutoff(spark):
    rows = [("r", dt.datetime(2024, 1, d)) for d in (10, 9, 8, 1)]
    df = spark.createDataFrame(rows, "repo string, created_at timestamp")
    got = take_until_cutoff(df, dt.datetime(2024, 1, 9), max_rows=None).count()
    assert got == 3  # 10, 9 and the first older row (8)
    assert take_until_cutoff(df, None, max_rows=1).count() == 2  # compat: max_pulls + 1


def test_asof(spark):
    rel = spark.createDataFrame([("r", dt.datetime(2024, 1, 10), "1.9"), ("r", dt.datetime(2024, 2, 5), "1.10")],
                                "repo string, date timestamp, version string")
    inst = spark.createDataFrame([(1, "r", dt.datetime(2024, 1, 10)), (2, "r", dt.datetime(2024, 1, 11)),
                                  (3, "r", dt.datetime(2023, 12, 1)), (4, "r", dt.datetime(2024, 5, 1))],
                                 "id int, repo string, created_at timestamp")
    a = {r.id: r.version for r in asof_join(inst, rel, ["repo"], "created_at", "date", ["version"]).collect()}
    assert a == {1: None, 2: "1.9", 3: None, 4: "1.10"}
    o = {r.id: r.version for r in asof_join(inst, rel, ["repo"], "created_at", "date", ["version"], fallback="oldest").collect()}
    assert o[3] == "1.9"
    v = {r.id: r.version for r in asof_version_by_order(inst, rel, ["repo"], "created_at", "version", "date").collect()}
    # string order: '1.9' > '1.10'; before any cutoff -> lowest ('1.10')
    assert v == {1: "1.10", 2: "1.9", 3: "1.10", 4: "1.9"}
    n = {r.id: r.version for r in asof_version_by_order(inst, rel, ["repo"], "created_at", "version", "date", numeric=True).collect()}
    assert n[4] == "1.10"
    # two versions with the same cutoff: the greater one (numerically) wins
    tie = rel.union(spark.createDataFrame([("r", dt.datetime(2024, 2, 5), "1.2")], "repo string, date timestamp, version string"))
    t = {r.id: r.version for r in asof_version_by_order(inst, tie, ["repo"], "created_at", "version", "date", numeric=True).collect()}
    assert t[4] == "1.10"


def test_budget_and_split(spark):
    df = spark.createDataFrame([("m", i, c) for i, c in enumerate([5, 5, 5, 5])], "m string, i int, cost int")
    assert stop_at_budget(df, "cost", 8, ["m"], ["i"]).count() == 2  # the crossing row is kept
    assert stop_at_budget(df, "cost", 0, ["m"], ["i"]).count() == 1  # first row always runs
    ten = spark.range(10).withColumnRenamed("id", "k")
    sizes = sorted(r[1] for r in split_even(ten, ["k"], 3).groupBy("part").count().collect())
    assert sizes == [3, 3, 4]


def test_packing(spark):
    items = spark.createDataFrame([([(1, 10, 60), (2, 11, 30), (3, 12, 10)],)],
                                  "items array<struct<rank:int,doc_id:bigint,tokens:bigint>>")
    r = items.select(pack_context(F.col("items"), F.lit(0), F.lit(40)).alias("p")).collect()[0].p
    assert list(r.kept) == [11] and r.used == 30   # 60 skipped; 30+10 == 40 is not < 40
    ct = spark.createDataFrame([([("b.py", "x"), ("a.py", "y")],)], "f array<struct<path:string,content:string>>") \
        .select(code_text(F.col("f"), add_line_numbers=True)).collect()[0][0]
    assert ct == "[start of a.py]\n1 y\n[end of a.py]\n[start of b.py]\n1 x\n[end of b.py]"


def test_recall(spark):
    ret = spark.createDataFrame([("a", 1, "README.md"), ("a", 2, "x.py"), ("b", 1, "y.py"), ("c", 1, "q-r.s.py")],
                                "instance_id string, rank int, file string")
    gold = spark.createDataFrame([("a", "x.py"), ("a", "z.py"), ("c", "q-r.s.py"), ("d", "w.py")], "instance_id string, file string")
    r = {x.instance_id: x.recall for x in retrieval_recall(ret, gold).collect()}
    assert r == {"a": 0.5, "c": 1.0}  # b: no gold, d: nothing retrieved -> left out


def test_tokens(spark):
    df = spark.createDataFrame([("hi", "x y"), ("hi", None)], "t string, p string")
    out = df.select(train_tokens(F.col("t"), F.col("p")).alias("k")).collect()
    # ids("hi\n") = 1 token, labels = 2 tokens + end: inputs 1 + 2, labels 0 masked + 3
    assert len(out[0].k.input_ids) == len(out[0].k.labels) == 3
    assert out[1].k.input_ids == [] and out[1].k.labels == []
    ids = spark.createDataFrame([([1] * 95 + list(range(5)) ,), (list(range(100)),)], "a array<int>")
    assert [r[0] for r in ids.select(repetition_flag(F.col("a"))).collect()] == [True, False]


def test_strip_ansi_two_character_forms(spark):
    from pyspark.sql import functions as F

    from diffloom.functions.text import strip_ansi
    df = spark.createDataFrame([("a\x1b]b\x1b^c\x1b_d\x1b\\e\x1bMf\x1b-g\x1b[1;31mh",)], "t string")
    assert df.select(strip_ansi(F.col("t"))).first()[0] == "abcdef\x1b-gh"
