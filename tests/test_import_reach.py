"""The import closure runs over one repository for each part, in rounds that grow with the logarithm of the chains."""

import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from diffloom.operators import files as R
from diffloom.plans import report_queries as Q

SF = "/root/testdata/sf0.001"
SCHEMA = "corpus_id string, path string, content string"


def test_a_repository_for_each_part(spark):
    sizes = dict(spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_size").collect())
    want = {(p, f"m{k}/f.py") for p, s in sizes.items() for k in range((s * 8 if p % 40 == 0 else s % 6) + 1)}
    got = [tuple(r) for r in Q.import_reach(spark, SF).collect()]
    assert sorted(got) == sorted(want) and max(sizes[p] * 8 for p in sizes if p % 40 == 0) > 100


def test_rounds_of_a_long_chain(spark, monkeypatch):
    rounds = []
    write = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: rounds.append(name) or write(df, name))
    files = spark.createDataFrame([("c", f"m{k}/f.py", f"import m{k + 1}\n" if k < 300 else "x = 1\n") for k in range(301)], SCHEMA)
    got = R.import_closure(files, files.where("path = 'm0/f.py'").select("corpus_id", "path"))
    assert got.count() == 301
    assert rounds.count("import-jumps") <= 10


def test_graphs_against_a_search(spark):
    rng = random.Random(3)
    rows, edges = [], {}
    for c in range(6):
        for k in range(25):
            to = sorted({rng.randrange(25) for _ in range(rng.choice([0, 1, 1, 2, 3]))})
            edges[str(c), k] = to
            rows.append((str(c), f"m{k}/f.py", "".join(f"import m{j}\n" for j in to)))
    files = spark.createDataFrame(rows, SCHEMA)
    targets = files.where("path in ('m0/f.py', 'm7/f.py')").select("corpus_id", "path")
    want = set()
    for c in map(str, range(6)):
        for root in (0, 7):
            seen, todo = {root}, [root]
            while todo:
                for j in edges[c, todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            want |= {(c, f"m{root}/f.py", f"m{k}/f.py") for k in seen}
    assert {tuple(r) for r in R.import_closure(files, targets).collect()} == want


def test_no_side_of_a_join_goes_through_the_driver(spark, monkeypatch):
    plans = []
    write = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    files = spark.createDataFrame([("c", f"m{k}/f.py", f"import m{k + 1}\n") for k in range(5)], SCHEMA)
    assert R.import_closure(files, files.where("path = 'm0/f.py'").select("corpus_id", "path")).count() == 5
    assert sum("Join" in p for p in plans) > 5
    assert not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)


def closure_by_search(rows, targets, edges):
    """edges: (corpus, path) -> paths. Targets reach themselves, whether or not they are files."""
    found = set()
    for c, root in targets:
        seen, todo = {root}, [root]
        while todo:
            for j in edges.get((c, todo.pop()), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        found |= {(c, root, f) for f in seen}
    return found


def test_rounds_hold_numbers_and_not_names(spark, monkeypatch):
    written = {}
    write = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: written.setdefault(name, []).append(df) or write(df, name))
    files = spark.createDataFrame([("c", f"m{k}/f.py", f"import m{k + 1}\n") for k in range(5)], SCHEMA)
    assert R.import_closure(files, files.where("path = 'm0/f.py'").select("corpus_id", "path")).count() == 5
    assert {kind for name in ("import-jumps", "import-reached") for df in written[name] for _, kind in df.dtypes} == {"bigint"}
    # names and import lines are written once, contents never
    assert [sorted(c for c, kind in df.dtypes if kind == "string") for df in written["import-files"]] == [["corpus_id", "path"]]


def test_a_repository_that_is_done_takes_no_part(spark, monkeypatch):
    tables = []
    write = R.materialize

    def kept(df, name):
        out = write(df, name)
        if name == "import-jumps":
            tables.append(out)
        return out

    monkeypatch.setattr(R, "materialize", kept)
    # the root of "done" imports nothing; a chain beside it is never reached
    rows = [("long", f"m{k}/f.py", f"import m{k + 1}\n") for k in range(40)] + [("done", "m0/f.py", "x = 1\n")]
    rows += [("done", f"m{k}/f.py", f"import m{k + 1}\n") for k in range(1, 41)]
    files = spark.createDataFrame(rows, SCHEMA)
    got = R.import_closure(files, files.where("path = 'm0/f.py'").select("corpus_id", "path"))
    assert got.groupBy("corpus_id").count().orderBy("corpus_id").collect() == [("done", 1), ("long", 40)]
    assert [t.select("corpus").distinct().count() for t in tables[:2]] == [2, 1]


def test_many_jumps_are_checked_against_all_shorter_ones(spark, monkeypatch):
    names = []
    write = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: names.append(name) or write(df, name))
    rng, edges = random.Random(5), {}
    for k in range(24):  # a chain that is reached, beside 30 files that import each other at random and are not
        edges["c", f"m{k}/f.py"] = [f"m{k + 1}/f.py"] if k < 23 else []
    for k in range(100, 130):
        edges["c", f"m{k}/f.py"] = sorted({f"m{rng.randrange(100, 130)}/f.py" for _ in range(3)})
    rows = [(c, p, "".join(f"import {x.split('/')[0]}\n" for x in to)) for (c, p), to in edges.items()]
    files = spark.createDataFrame(rows, SCHEMA)
    targets = [("c", "m0/f.py"), ("c", "m100/f.py")]
    got = R.import_closure(files, spark.createDataFrame(targets[:1], "corpus_id string, path string"))
    assert {tuple(r) for r in got.collect()} == closure_by_search(rows, targets[:1], edges)
    assert "import-fewer-jumps" in names
    got = R.import_closure(files, spark.createDataFrame(targets, "corpus_id string, path string"))
    assert {tuple(r) for r in got.collect()} == closure_by_search(rows, targets, edges)


def test_repeated_rows_nulls_and_targets_that_are_no_files(spark):
    rows = [("c", "a/f.py", "import b\n"), ("c", "a/f.py", "import b\n"), ("c", "a/f.py", "  import d\nimport b\n"), ("c", "b/f.py", "from c import x\n"),
            ("c", "b/notes.txt", "import a\n"), ("c", "c/f.py", None), ("c", "d/f.py", "import d\n"), (None, "a/f.py", "import b\n"),
            (None, "b/f.py", ""), ("e", None, "import a\n"), ("e", "a/f.py", "x = 1\n")]
    files = spark.createDataFrame(rows, SCHEMA)
    targets = [("c", "a/f.py"), ("c", "a/f.py"), ("c", "b/notes.txt"), ("c", "none.py"), (None, "a/f.py"), ("e", None), ("e", "a/f.py")]
    edges = {("c", "a/f.py"): ["b/f.py", "d/f.py"], ("c", "b/f.py"): ["c/f.py"], ("c", "b/notes.txt"): ["a/f.py"]}
    got = R.import_closure(files, spark.createDataFrame(targets, "corpus_id string, path string"))
    assert sorted(map(str, got.collect())) == sorted(str(Row(corpus_id=c, root=r, file=f)) for c, r, f in closure_by_search(rows, targets, edges))


def test_directories_of_odd_paths(spark):
    """The directory is what stands before the last slash; a file at the root is in the directory ""."""
    rows = [("c", "top.py", "import x\nimport y\nimport z.w\n"), ("c", "x/f.py", ""), ("c", "q//y/f.py", ""), ("c", "z/w/g.py", ""), ("c", "long/z/w/h.py", ""), ("c", "x/", "import x\n")]
    files = spark.createDataFrame(rows, SCHEMA)
    got = R.resolve_edges(files).where("src <> dst").collect()
    assert sorted(tuple(r)[1:] for r in got) == [("top.py", "q//y/f.py"), ("top.py", "x/f.py"), ("top.py", "z/w/g.py"), ("x/", "x/f.py")]


def test_an_import_line_is_read_as_in_the_whole_content(spark):
    text = "import os\n\n   from ..a.b import c\nfrom . import d\nimport os\nx = 1\n\timport p.q, r\nfrom e import(f)\nimport .g\nfromm h import i\n"
    files = spark.createDataFrame([("c", "f.py", text)], SCHEMA)
    got = [tuple(r)[2:] for r in R.import_edges(files).collect()]
    assert sorted(set(got)) == [(0, ".g"), (0, "os"), (0, "p.q"), (1, ""), (2, "a.b")]


def test_tasks_follow_the_files(spark, tmpdir_path, monkeypatch):
    spark.range(400).select(F.col("id").alias("p_partkey"), F.lit(3).alias("p_size")).write.parquet(f"{tmpdir_path}/part.parquet")
    monkeypatch.setattr(Q, "PART_BYTES", 64)
    assert Q.part_repositories(spark, tmpdir_path).select("corpus_id").distinct().count() == 400
    plan = Q.part_repositories(spark, tmpdir_path)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    files = spark.createDataFrame([("c", f"m{k}/f.py", f"import m{k + 1}\n") for k in range(5)], SCHEMA)
    files.write.parquet(f"{tmpdir_path}/files")
    files = spark.read.parquet(f"{tmpdir_path}/files")
    want = sorted(map(tuple, R.resolve_edges(files).collect()))
    monkeypatch.setattr(R, "SUFFIX_BYTES", 32)
    edges = R.resolve_edges(files)
    plan = edges._jdf.queryExecution().executedPlan().toString()
    counts = [int(x.split(")")[0].split()[-1]) for x in plan.split("hashpartitioning(corpus_id")[1:] if "REPARTITION_BY_NUM" in x.splitlines()[0]]
    assert counts and min(counts) > 20
    assert len(want) == 4 and sorted(map(tuple, edges.collect())) == want
