"""Remaining operators on literal fixtures: C2, C4, C9, C16, C18, C19, J2, J6, J9, J12, D3,
D5, A2, A7-A13, G3, G4, B20, L4."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators.costs import fits_model_context
from diffloom.operators.files import doc_docstrings, edits_only_text, import_closure, parse_test_ids
from diffloom.operators.issues import clean_tracker_body, problem_statement, tracker_time
from diffloom.operators.patches import oracle_files
from diffloom.operators.prompts import chat_rows, readme_files
from diffloom.operators.reports import require_known_ids, with_outputs_only
from diffloom.operators.sampling import sample_n, train_valid_split
from diffloom.operators.tokens import eval_tokens
from diffloom.sources.readers import (append_rows, merge_parts, output_name, read_dataset, read_hits, read_snapshot,
                                      write_hits, write_splits)
from diffloom.streaming.incremental import regrade


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_problem_statement_and_tracker(spark):
    pulls = spark.createDataFrame([("o/r", 1, ["5", "9", "6"]), ("o/r", 2, [])],
                                  "repo string, pull_number int, resolved_issues array<string>")
    issues = spark.createDataFrame([("o/r", "5", "T5", "B5"), ("o/r", "6", "T6", None)],
                                   "repo string, issue_number string, title string, body string")
    ps = {r.pull_number: r.problem_statement for r in problem_statement(pulls, issues).collect()}
    assert ps == {1: "T5\nB5\nT6\n\n", 2: ""}
    df = spark.createDataFrame([("a\n\n\nb    c  d  ",)], "t string")
    assert df.select(clean_tracker_body(F.col("t"))).collect()[0][0] == "a\nb\tc d"
    ts = spark.createDataFrame([("01/02/24 10:00:00",), ("See timeline at Jan 2, 2024, 1:00:00 PM",), ("bad",)], "t string") \
        .select(tracker_time(F.col("t"))).collect()
    assert ts[0][0] == dt.datetime(2024, 1, 2, 10) and ts[1][0] == dt.datetime(2024, 1, 2, 13) and ts[2][0] is None


def test_oracle_files_and_test_ids(spark):
    p = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-a\n+b\n" \
        "diff --git a/n.py b/n.py\n--- /dev/null\n+++ b/n.py\n@@ -0,0 +1 @@\n+c\n"
    df = spark.createDataFrame([(p,)], "p string")
    assert sorted(df.select(oracle_files(F.col("p"))).collect()[0][0]) == ["x.py"]
    assert sorted(df.select(oracle_files(F.col("p"), compat=True)).collect()[0][0]) == ["/dev/null", "x.py"]
    inst = spark.createDataFrame([("i", "c", json.dumps(["t/test_a.py::T.test_x", "test_y (pkg.mod.Klass)", "junk"]),
                                   json.dumps(["test_z (other.Kl)"]))],
                                 "instance_id string, corpus_id string, FAIL_TO_PASS string, PASS_TO_PASS string")
    snap = spark.createDataFrame([("c", "t/test_a.py"), ("c", "tests/pkg/mod.py")], "corpus_id string, path string")
    got = sorted((r.test_file, r.test_case, r.test_type) for r in parse_test_ids(inst, snap).collect())
    assert got == [("pkg/mod.py", "Klass.test_y", K.FAIL_TO_PASS), ("t/test_a.py", "T.test_x", K.FAIL_TO_PASS)]


def test_import_closure_and_docstrings(spark):
    snap = spark.createDataFrame([
        ("c", "app/main.py", "import lib\n"),
        ("c", "lib/x.py", "from ..util import z\n"),
        ("c", "lib/y.py", "x = 1\n"),
        ("c", "setup.py", "import os\n"),
        ("c", "pkg/b.py", "from pkg.b import f\n"),
        ("c", "other/q.py", '"""Doc of q."""\ndef g():\n    """G doc."""\n'),
    ], "corpus_id string, path string, content string")
    targets = spark.createDataFrame([("c", "app/main.py"), ("c", "pkg/b.py")], "corpus_id string, path string")
    reached = {}
    for r in import_closure(snap, targets).collect():
        reached.setdefault(r.root, set()).add(r.file)
    # import lib -> the lib directory; from ..util -> no parts left -> the root directory
    assert reached["app/main.py"] == {"app/main.py", "lib/x.py", "lib/y.py", "setup.py"}
    # "pkg/b" is not a directory: nothing is added
    assert reached["pkg/b.py"] == {"pkg/b.py"}
    enc = {r.path: r.text for r in doc_docstrings(snap).collect()}
    assert enc["other/q.py"] == "other/q.py\nDoc of q.\n\ng\nG doc."
    assert enc["lib/y.py"] == "lib/y.py\n"


def test_docstrings_of_odd_files(spark):
    nested = 'class A:\n    def f(self, x=")", y={"a:": 1}):  # def g():\n        r"""F\n\n          in.\n        out.\n        """\n        def h():\n            "H"\n\nasync def b():\n    """B"""\n'
    files = {
        "string.py": 'T = """\ndef fake():\n    \'\'\'no\'\'\'\n"""\n',  # a definition inside a string is none
        "nested.py": nested,  # outer levels first
        "broken.py": '"""doc"""\ndef (:\n',
        "null.py": None, "empty.py": "", "zero.py": "x = 1\0", "escape.py": '"""a"""\ny = "\\d"\n',
    }
    df = spark.createDataFrame([("c", k, v, "more") for k, v in files.items()], "corpus_id string, path string, content string, text string")
    got = {r.path: r.text for r in doc_docstrings(df).collect()}
    assert got == {"string.py": "string.py\n", "nested.py": "nested.py\n\n\nb\nB\n\nf\nF\n\n  in.\nout.\n\nh\nH", "broken.py": "broken.py\n" + files["broken.py"],
                   "null.py": "null.py\n", "empty.py": "empty.py\n", "zero.py": "zero.py\nx = 1\0", "escape.py": "escape.py\na"}
    assert doc_docstrings(df.limit(0)).collect() == []


def test_edits_only_and_readmes_and_chat(spark):
    content = "\n".join(f"l{i}" for i in range(1, 41))
    df = spark.createDataFrame([(content, [(20, 2)])], "c string, h array<struct<old_start:int,old_len:int>>")
    txt = df.select(edits_only_text(F.col("c"), F.col("h"))).collect()[0][0]
    lines = txt.split("\n")
    assert lines[0] == "..." and lines[1] == "6 l6" and lines[-1] == "..." and lines[-2] == "22 l22"
    # a hunk near the top: clamped by default, counted from the end in compat mode (Python slice)
    top = spark.createDataFrame([(content, [(3, 2)])], "c string, h array<struct<old_start:int,old_len:int>>")
    clamped = top.select(edits_only_text(F.col("c"), F.col("h"))).collect()[0][0].split("\n")
    assert clamped[0] == "1 l1" and clamped[-2] == "5 l5"
    compat = top.select(edits_only_text(F.col("c"), F.col("h"), compat=True)).collect()[0][0]
    assert compat == "..."  # [-12:5] is empty for 40 lines; only the trailing marker remains
    files = spark.createDataFrame([("c", "README.md"), ("c", "readme.rst"), ("c", "docs/README.md"), ("c", "x.py")],
                                  "corpus_id string, path string")
    assert sorted(r.path for r in readme_files(files).collect()) == ["README.md", "readme.rst"]
    assert [r.path for r in readme_files(files, shortest=True).collect()] == ["README.md"]
    cr = spark.createDataFrame([("sys\nuser a\nuser b",), ("only",)], "t string").select(chat_rows(F.col("t")).alias("c")).collect()
    assert (cr[0].c.system, cr[0].c.user, cr[1].c.user) == ("sys", "user a\nuser b", "")


def test_ids_tokens_costs_sampling(spark):
    known = spark.createDataFrame([("a",), ("b",)], "instance_id string")
    with pytest.raises(ValueError):
        require_known_ids(spark.createDataFrame([("a",), ("z",)], "instance_id string"), known)
    logs = spark.createDataFrame([("a",)], "instance_id string")
    preds = spark.createDataFrame([("a",), ("b",)], "instance_id string")
    assert [r[0] for r in with_outputs_only(known, logs, preds).collect()] == ["a"]
    et = spark.createDataFrame([("a b", "c")], "t string, p string").select(eval_tokens(F.col("t"), F.col("p")).alias("e")).collect()[0].e
    assert (len(et.input_ids), len(et.labels)) == (2, 2)  # the label ids end with the end token
    limits = spark.createDataFrame([("m", 10)], "model string, context_limit int")
    calls = spark.createDataFrame([("m", 10), ("m", 11), ("x", 1)], "model string, n int")
    assert fits_model_context(calls, limits, "model", "n").count() == 1
    ids = spark.range(100).withColumnRenamed("id", "k")
    s1 = [r.k for r in sample_n(ids, "k", 10, seed=1).collect()]
    assert len(s1) == 10 and s1 == [r.k for r in sample_n(ids, "k", 10, seed=1).collect()]
    assert sample_n(ids, "k", 1000).count() == 100
    sp = train_valid_split(ids, "k", ratio=0.2).groupBy("split").count().collect()
    assert {r.split for r in sp} == {"train", "validation"}


def test_file_sinks(spark, tmpdir_path):
    ds = spark.createDataFrame([("a", "test"), ("b", "test"), ("c", "dev")], "instance_id string, split string")
    write_splits(ds, f"{tmpdir_path}/ds")
    with pytest.raises(Exception):
        write_splits(ds, f"{tmpdir_path}/ds")  # an existing output stops the job
    assert read_dataset(spark, f"{tmpdir_path}/ds", split="test").count() == 2
    with pytest.raises(ValueError):
        read_dataset(spark, f"{tmpdir_path}/ds", ids=["a", "zz"])
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "instance_id string, v int")
    append_rows(rows, f"{tmpdir_path}/out")
    append_rows(rows.union(spark.createDataFrame([("c", 3)], "instance_id string, v int")), f"{tmpdir_path}/out")
    assert spark.read.json(f"{tmpdir_path}/out").count() == 3  # rerun appends only the new id
    h = spark.createDataFrame([("a", [("d1", 1.5)])], "instance_id string, hits array<struct<docid:string,score:double>>")
    write_hits(h, f"{tmpdir_path}/hits")
    assert read_hits(spark, f"{tmpdir_path}/hits").collect()[0].hits[0].docid == "d1"
    _w(f"{tmpdir_path}/parts/r_versions_0.json", json.dumps({"instance_id": "a"}))
    _w(f"{tmpdir_path}/parts/r_versions_1.json", json.dumps({"instance_id": "b"}))
    known = spark.createDataFrame([("a",), ("b",)], "instance_id string")
    assert merge_parts(spark, f"{tmpdir_path}/parts/r_versions_*.json", known).count() == 2
    assert output_name("x/SWE-set", "style-3", "bm25", k=5) == "SWE-set__style-3__fs-bm25__k-5"
    _w(f"{tmpdir_path}/snap/pkg/mod.py", "print(1)\n")
    _w(f"{tmpdir_path}/snap/pkg/tests/test_mod.py", "assert 1\n")
    with open(f"{tmpdir_path}/snap/pkg/bad.py", "wb") as f:
        f.write(b"\xff\xfe\x00bad")
    snap = {r.path: r.content for r in read_snapshot(spark, f"{tmpdir_path}/snap", "c").collect()}
    assert snap == {"pkg/mod.py": "print(1)\n", "pkg/bad.py": "[could not decode file contents]"}


def test_regrade_overwrites_run_partition(spark, tmpdir_path):
    log = "\n".join([K.START_TEST_OUTPUT, "PASSED t1", K.END_TEST_OUTPUT])
    logs = spark.createDataFrame([("run1", "m", "a", "pytest-dev/pytest", log)],
                                 "run_id string, model string, instance_id string, repo string, log string")
    gold = spark.createDataFrame([("a", K.FAIL_TO_PASS, "t1")], "instance_id string, category string, test string")
    regrade(logs, gold, f"{tmpdir_path}/g")
    regrade(logs, gold, f"{tmpdir_path}/g")
    out = spark.read.parquet(f"{tmpdir_path}/g").collect()
    assert len(out) == 1 and out[0].resolution == K.RESOLVED_FULL
