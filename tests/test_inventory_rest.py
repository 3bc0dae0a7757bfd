"""B7(c), C2b, C17, C20, C21, C22, C25, D6, D9, D13, D15, G2, J5."""

import datetime as dt

from pyspark.sql import functions as F

from diffloom.functions.text import issue_url_parts
from diffloom.operators.issues import live_statement, with_issue_reference
from diffloom.operators.patches import keep_test_sections
from diffloom.operators.prompts import select_files
from diffloom.operators.reports import keep_valid_ids, lookup_spec, order_by_id, package_rank, unresolved_pairs
from diffloom.operators.retrieval import attach_hits
from diffloom.operators.versions import release_table, version_from_files


def test_issue_refs_and_statements(spark):
    df = spark.createDataFrame([("see #3", "o/r"), ("see #4", "o/r"), ("fixes #9", "o/r"), ("plain", "o/r")],
                               "t string, repo string")
    known = spark.createDataFrame([("o/r", "3")], "repo string, issue_number string")
    got = {r.t: r.has_issue_reference for r in with_issue_reference(df, "t", "repo", known, id_col="t").collect()}
    assert got == {"see #3": True, "see #4": False, "fixes #9": True, "plain": False}
    s = spark.createDataFrame([("T", None, ["a", "b"])], "t string, b string, c array<string>")
    assert s.select(live_statement(F.col("t"), F.col("b"))).collect()[0][0] == "T\n"
    assert s.select(live_statement(F.col("t"), F.col("b"), F.col("c"))).collect()[0][0] == "T\n\nComment: a\nComment: b"
    u = spark.createDataFrame([("https://github.com/o/r/issues/12",), ("https://x.org/1",)], "u string") \
        .select(issue_url_parts(F.col("u")).alias("p")).collect()
    assert (u[0].p.owner, u[0].p.repo, u[0].p.number) == ("o", "r", 12) and u[1].p is None


def test_versions_from_files_and_pages(spark):
    inst = spark.createDataFrame([("i1", "o/r", "c1")], "instance_id string, repo string, corpus_id string")
    files = spark.createDataFrame([("c1", "setup.py", '"""version = 9.9"""\nversion = "1.2.3"\n'),
                                   ("c1", "pkg/__init__.py", '__version__ = "4.5"')], "corpus_id string, path string, content string")
    paths = spark.createDataFrame([("o/r", "pkg/__init__.py", 2), ("o/r", "setup.py", 1)], "repo string, path string, rank int")
    pats = spark.createDataFrame([("o/r", r"version = \"([0-9. ]+)\"", 1), ("o/r", r"__version__ = \"([0-9.]+)\"", 2)],
                                 "repo string, pattern string, rank int")
    v = version_from_files(inst, files, paths, pats).collect()[0].version
    assert v == "1.2"
    pages = spark.createDataFrame([("o/r", "<li>v1.2.0 (2020-01-05)</li><li>v1.3.1 (no date)</li><li>v1.2.0 (2020-01-05)</li>")],
                                  "repo string, html string")
    rel = release_table(pages, r"v([0-9.]+) \(([^)]*)\)", ["yyyy-MM-dd"]).collect()
    assert [(r.version, r.date) for r in rel] == [("1.2", dt.date(2020, 1, 5))]


def test_joins_and_selection(spark):
    df = spark.createDataFrame([("a",), ("b",)], "instance_id string")
    kept, rej = keep_valid_ids(df, spark.createDataFrame([("a",)], "instance_id string"))
    assert [r[0] for r in kept.collect()] == ["a"] and [r[0] for r in rej.collect()] == ["b"]
    rows = spark.createDataFrame([("a", "o/r", "1.0"), ("b", "o/r", "9.9")], "instance_id string, repo string, version string")
    specs = spark.createDataFrame([("o/r", "1.0", "pytest")], "repo string, version string, test_cmd string")
    ok, bad = lookup_spec(rows, specs)
    assert [r.test_cmd for r in ok.collect()] == ["pytest"] and [r.instance_id for r in bad.collect()] == ["b"]
    up = unresolved_pairs(rows, rows.where("instance_id = 'a'"))
    assert [(r.instance_id, r.version) for r in up.collect()] == [("b", "9.9")]
    assert [r.instance_id for r in order_by_id(df.union(spark.createDataFrame([("10",)], "instance_id string"))).collect()] == ["10", "a", "b"]
    inst = spark.createDataFrame([("a", "c1"), ("b", "c1")], "instance_id string, corpus_id string")
    snap = spark.createDataFrame([("c1", "x.py"), ("c1", "y.py")], "corpus_id string, path string")
    assert select_files(inst, "all", snapshot=snap).count() == 4
    assert select_files(inst, "none").count() == 0
    h = spark.createDataFrame([("a", [("d1", 2.0), ("d2", 1.0)], 0), ("a", [("d3", 3.0)], 1)],
                              "instance_id string, hits array<struct<docid:string,score:double>>, pos int")
    att = {r.instance_id: [x.docid for x in r.hits] for r in attach_hits(inst, h, 1).collect()}
    assert att == {"a": ["d3"], "b": []}


def test_package_rank_and_test_sections(spark):
    pk = spark.createDataFrame([(1, "p1", "u1"), (2, "p2", "u2"), (3, "p3", "u3")], "rank int, name string, url string")
    links = spark.createDataFrame([("p1", 2, "Source Code", "https://github.com/a/p1"), ("p1", 1, "Homepage", "https://p1.org"),
                                   ("p2", 1, "Docs", "https://github.com/a/p2")], "name string, pos int, label string, href string")
    stats = spark.createDataFrame([("https://github.com/a/p1", 10, 3)], "github string, stars int, pulls int")
    written = spark.createDataFrame([("p3",)], "name string")
    r = {x.name: (x.github, x.stars) for x in package_rank(pk, links, stats, written).collect()}
    assert r == {"p1": ("https://github.com/a/p1", 10), "p2": (None, None)}
    p = "diff --git a/tests/t.py b/tests/t.py\n+x\ndiff --git a/src/a.py b/src/a.py\n+y\n"
    out = spark.createDataFrame([(p,)], "p string").select(keep_test_sections(F.col("p"))).collect()[0][0]
    assert out == "diff --git a/tests/t.py b/tests/t.py\n+x\n"
