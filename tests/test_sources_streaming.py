"""File sources (A1, A3, A5, A6, A14) and the streaming collection (L2) against its batch form."""

import json
import os
import time

import pytest

from diffloom.sources.readers import read_instances, read_logs, read_patch_dir, read_predictions, read_result_files
from diffloom.streaming.incremental import collect_batch, collect_stream


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_instances_and_predictions(spark, tmpdir_path):
    rows = [{"repo": "o/r", "instance_id": "o__r-1", "patch": "p"}, {"repo": "o/r", "instance_id": "o__r-2", "patch": "q"}]
    _w(f"{tmpdir_path}/i.jsonl", "\n".join(json.dumps(r) for r in rows))
    _w(f"{tmpdir_path}/i.json", json.dumps(rows))
    assert read_instances(spark, f"{tmpdir_path}/i.jsonl").count() == 2
    assert read_instances(spark, f"{tmpdir_path}/i.json").count() == 2
    preds = [{"instance_id": "o__r-1", "model_name_or_path": "m", "model_patch": "x"}]
    _w(f"{tmpdir_path}/p.json", json.dumps(preds))
    _w(f"{tmpdir_path}/d.json", json.dumps({"o__r-1": preds[0]}))
    _w(f"{tmpdir_path}/p.jsonl", json.dumps(preds[0]))
    for name in ("p.json", "d.json", "p.jsonl"):
        assert [r.instance_id for r in read_predictions(spark, f"{tmpdir_path}/{name}").collect()] == ["o__r-1"]
    inst = read_instances(spark, f"{tmpdir_path}/i.jsonl")
    assert read_predictions(spark, "gold", inst).where("model_patch = 'q'").count() == 1


def test_logs_results_patches(spark, tmpdir_path):
    _w(f"{tmpdir_path}/logs/run1/org__model/o__r-1/test_output.txt", "hello")
    lg = read_logs(spark, f"{tmpdir_path}/logs").collect()[0]
    assert (lg.run_id, lg.model, lg.instance_id, lg.log) == ("run1", "org/model", "o__r-1", "hello")
    _w(f"{tmpdir_path}/results/result_scikit-learn__scikit-learn-10297.json",
       json.dumps({"instance_id": "scikit-learn__scikit-learn-10297", "results": []}))
    r = read_result_files(spark, f"{tmpdir_path}/results/*.json").collect()[0]
    assert r.repo_key_compat == "scikit" and r.repo_key == "scikit-learn__scikit-learn"
    _w(f"{tmpdir_path}/patches/o__r-1.diff", "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1 @@\n-a\n+b\n")
    _w(f"{tmpdir_path}/patches/o__r-2.diff", "not a diff")
    p = {x.instance_id: x.well_formed for x in read_patch_dir(spark, f"{tmpdir_path}/patches/*.diff", "m").collect()}
    assert p == {"o__r-1": True, "o__r-2": False}


def _pull(n, merged=True, test=True):
    diff = f"diff --git a/src/m{n}.py b/src/m{n}.py\n--- a/src/m{n}.py\n+++ b/src/m{n}.py\n@@ -1 +1 @@\n-a\n+b\n"
    if test:
        diff += f"diff --git a/tests/test_m{n}.py b/tests/test_m{n}.py\n--- a/tests/test_m{n}.py\n+++ b/tests/test_m{n}.py\n@@ -1 +1 @@\n-a\n+b\n"
    return {"number": n, "title": f"Fix {n}", "body": f"fixes #{n}", "created_at": f"2024-01-0{n}T00:00:00Z",
            "merged_at": "2024-02-01T00:00:00Z" if merged else None, "diff_url": "",
            "base": {"sha": "abc", "repo": {"full_name": "o/r"}}, "resolved_issues": [str(n)], "diff": diff}


def test_collect_stream_equals_batch(spark, tmpdir_path):
    src = f"{tmpdir_path}/pulls"
    os.makedirs(src)
    # three one-file batches, newest pull first; the third repeats the first pull
    batches = [[_pull(3)], [_pull(2), _pull(1, merged=False)], [_pull(3), _pull(1)]]
    for i, b in enumerate(batches):
        _w(f"{src}/b{i}.json", "\n".join(json.dumps(x) for x in b))
        os.utime(f"{src}/b{i}.json", (time.time() + i, time.time() + i))
    q = collect_stream(spark, src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt")
    q.awaitTermination(120)
    got = sorted(r.instance_id for r in spark.read.parquet(f"{tmpdir_path}/out").collect())
    want = sorted(r.instance_id for r in collect_batch(spark, src).collect())
    assert got == want == ["o__r-1", "o__r-2", "o__r-3"]


def test_collect_with_issues_hints_and_both_outputs(spark, tmpdir_path):
    src = f"{tmpdir_path}/pulls"
    os.makedirs(src)
    _w(f"{src}/a.json", "\n".join(json.dumps(x) for x in [_pull(1), _pull(2, test=False), _pull(3)]))
    issues = spark.createDataFrame([("o/r", "1", "Bug", "it breaks"), ("o/r", "2", "Two", None)], "repo string, issue_number string, title string, body string")
    hints = spark.createDataFrame([("o/r", 1, "try this")], "repo string, pull_number int, hints_text string")
    for _ in range(2):  # the second run adds nothing
        q = collect_stream(spark, src, f"{tmpdir_path}/all", f"{tmpdir_path}/ckpt", issues=issues, hints=hints, tests_dir=f"{tmpdir_path}/main")
        q.awaitTermination(120)
    got = {r.instance_id: r for r in spark.read.parquet(f"{tmpdir_path}/all").collect()}
    assert set(got) == {"o__r-1", "o__r-2"}  # no known issue, no statement: o__r-3 is not valid
    assert got["o__r-1"].problem_statement == "Bug\nit breaks\n" and got["o__r-1"].hints_text == "try this"
    assert got["o__r-2"].problem_statement == "Two\n\n" and got["o__r-2"].hints_text == ""
    assert [r.instance_id for r in spark.read.parquet(f"{tmpdir_path}/main").collect()] == ["o__r-1"]
    assert spark.read.parquet(f"{tmpdir_path}/all").count() == 2
    batch = {r.instance_id: r.problem_statement for r in collect_batch(spark, src, issues, hints).collect()}
    assert batch == {i: r.problem_statement for i, r in got.items()}


def test_unreadable_output_is_an_error(spark, tmpdir_path):
    from diffloom.sources.readers import append_rows
    df = spark.createDataFrame([("a", 1), ("b", 2)], "instance_id string, n int")
    assert append_rows(df, f"{tmpdir_path}/rows", fmt="parquet").count() == 2
    assert append_rows(df, f"{tmpdir_path}/rows", fmt="parquet").count() == 0
    with open(f"{tmpdir_path}/broken", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        append_rows(df, f"{tmpdir_path}/broken", fmt="parquet")


def test_regrade_of_a_missing_log_raises(spark, tmpdir_path):
    from diffloom.streaming.incremental import regrade
    logs = spark.createDataFrame([("r", "m", "a", "x/y", "log")], "run_id string, model string, instance_id string, repo string, log string")
    gold = spark.createDataFrame([("a", "FAIL_TO_PASS", "t")], "instance_id string, category string, test string")
    wanted = spark.createDataFrame([("a",), ("b",)], "instance_id string")
    with pytest.raises(ValueError):
        regrade(logs, gold, f"{tmpdir_path}/graded", expected=wanted)


def _log(status, end=True):
    from diffloom import constants as K
    lines = [K.INSTALL_PASS, K.APPLY_PATCH_PASS, K.START_TEST_OUTPUT, f"{status} t.py::a", *([K.END_TEST_OUTPUT] if end else [])]
    return "\n".join(lines) + "\n"


def test_log_stream_grades_once_and_regrade_keeps_other_runs(spark, tmpdir_path):
    import glob

    from diffloom.streaming.incremental import grade_log_stream, graded_schema, regrade
    schema = "run_id string, model string, instance_id string, repo string, log string"
    rows = [(run, "m", i, "pytest-dev/pytest", _log(s)) for run, s in (("1", "PASSED"), ("2", "FAILED"), ("3", "ERROR")) for i in ("a", "b")]
    gold = spark.createDataFrame([("a", "FAIL_TO_PASS", "t.py::a"), ("b", "FAIL_TO_PASS", "t.py::a")], "instance_id string, category string, test string")
    out = f"{tmpdir_path}/graded"
    for drop in (rows[:3] + rows[:1], rows[3:], rows[:2]):  # twice in a drop, and again in a later one
        spark.createDataFrame(drop, schema).write.mode("append").parquet(f"{tmpdir_path}/logs")
        arriving = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/logs")
        grade_log_stream(arriving, gold, out, f"{tmpdir_path}/ckpt").awaitTermination(120)
    read = lambda: {(r.run_id, r.instance_id): r.resolution for r in spark.read.schema(graded_schema(spark, gold)).parquet(out).collect()}
    first = read()
    assert spark.read.parquet(out).count() == 6 and first["1", "a"] == "RESOLVED_FULL" and first["3", "a"] == "RESOLVED_NO"
    files = {run: sorted(glob.glob(f"{out}/run_id={run}/*.parquet")) for run in "123"}
    modes = spark.createDataFrame([("a", "fail_only"), ("b", "fail_only")], "instance_id string, eval_type string")
    regrade(spark.createDataFrame(rows, schema).where("run_id in ('2', '3')"), gold, out, modes=modes)
    second = read()
    assert second["3", "a"] == "RESOLVED_FULL" and second["2", "a"] == "RESOLVED_NO" and len(second) == 6
    assert sorted(glob.glob(f"{out}/run_id=1/*.parquet")) == files["1"]
    assert not set(glob.glob(f"{out}/run_id=3/*.parquet")) & set(files["3"])
