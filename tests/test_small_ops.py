"""Small operators: B15, B24, C24, A12, E8, E13, G6, H4."""

import json
import os

from pyspark.sql import functions as F

from diffloom.functions.filters import has_import_or_attribute_error, patch_defines_gold_test
from diffloom.functions.text import blank_line_normalise, make_instance_id
from diffloom.operators.reports import collection_stats, write_report
from diffloom.operators.sampling import from_id_limit, group_by_version, union_distinct


def test_row_helpers(spark):
    df = spark.createDataFrame([("E   ImportError: x\nok",), ("attribute set\nall good",), ("ok",)], "l string")
    assert [r[0] for r in df.select(has_import_or_attribute_error(F.col("l"))).collect()] == [True, False, False]
    g = spark.createDataFrame([(["t/test_a.py::x"], "diff --git a/t/test_a.py b/t/test_a.py\n"), (["t/b.py::y"], "diff --git a/t/c.py b/t/c.py")],
                              "f2p array<string>, tp string")
    assert [r[0] for r in g.select(patch_defines_gold_test(F.col("f2p"), F.col("tp"))).collect()] == [True, False]
    b = spark.createDataFrame([("a\n   \nb",), ("c\n",)], "t string").select(blank_line_normalise(F.col("t"))).collect()
    assert [r[0] for r in b] == ["a\n\nb\n", "c\n"]
    i = spark.createDataFrame([("o/r", 12)], "repo string, n int").select(make_instance_id(F.col("repo"), F.col("n"))).collect()
    assert i[0][0] == "o__r-12"


def test_reports_and_ordering(spark, tmpdir_path):
    pulls = spark.range(5)
    inst = spark.createDataFrame([("a", "t"), ("b", ""), ("c", None)], "instance_id string, test_patch string")
    written = spark.createDataFrame([("a",)], "instance_id string")
    st = collection_stats(pulls, inst, written).collect()[0]
    assert (st.total_pulls, st.completed, st.with_tests, st.skipped) == (5, 3, 1, 1)
    write_report(spark.createDataFrame([(3, 2)], "total_instances int, schema_version int"), f"{tmpdir_path}/rep")
    txt = "".join(open(os.path.join(f"{tmpdir_path}/rep", f)).read() for f in os.listdir(f"{tmpdir_path}/rep") if f.startswith("part"))
    assert json.loads(txt) == {"total_instances": 3, "schema_version": 2}
    ids = spark.range(10).withColumnRenamed("id", "k")
    assert [r.k for r in from_id_limit(ids, ["k"], "k", start_id=4, limit=3).orderBy("k").collect()] == [4, 5, 6]
    u = union_distinct(spark.createDataFrame([("a",), ("b",)], "i string"), spark.createDataFrame([("b",), ("c",)], "i string"))
    assert sorted(r.i for r in u.collect()) == ["a", "b", "c"]
    assert group_by_version(spark.createDataFrame([("1.0", 1), ("1.1", 2)], "version string, x int"), n_partitions=2).count() == 2


def test_gate_variants(spark):
    from diffloom.functions.filters import contains_hyperlinks, has_error_message_check
    df = spark.createDataFrame([("see https://github.com/o/r/issues/1", "o/r"), ("see https://x.org/a", "o/r")],
                               "t string, repo string")
    compat = [r[0] for r in df.select(contains_hyperlinks(F.col("t"), F.col("repo"))).collect()]
    strict = [r[0] for r in df.select(contains_hyperlinks(F.col("t"), F.col("repo"), strict=True)).collect()]
    assert compat == [True, True] and strict == [False, True]
    tp = spark.createDataFrame([("with pytest.raises(E, match='x')",), ("with pytest.raises(E):",),
                                ("self.assertRaises(E)",), ("plain",)], "t string")
    assert [r[0] for r in tp.select(has_error_message_check(F.col("t"))).collect()] == [True, False, True, False]


def test_candidate_and_export_sinks(spark, tmpdir_path):
    from diffloom.sources.readers import export_jsonl, write_candidates
    df = spark.createDataFrame([("a", "diff", "test"), ("b", "diff", "")], "instance_id string, patch string, test_patch string")
    write_candidates(df, f"{tmpdir_path}/all", f"{tmpdir_path}/main")
    assert spark.read.json(f"{tmpdir_path}/all").count() == 2 and spark.read.json(f"{tmpdir_path}/main").count() == 1
    export_jsonl(df.withColumn("split", F.lit("test")), f"{tmpdir_path}/exp", split="test")
    assert spark.read.json(f"{tmpdir_path}/exp").count() == 2


def test_grade_stream_equals_batch(spark, tmpdir_path):
    from diffloom import constants as K
    from diffloom.sources.readers import read_logs
    from diffloom.streaming.incremental import grade_batch, grade_stream
    logs = {("run1", "org__m", "a"): ["PASSED t1", "FAILED t2 - x"], ("run1", "org__m", "b"): ["PASSED t1"],
            ("run2", "org__m", "a"): ["PASSED t1", "PASSED t2"]}
    for (run, model, iid), lines in logs.items():
        path = f"{tmpdir_path}/logs/{run}/{model}/{iid}/test_output.txt"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("\n".join([K.START_TEST_OUTPUT, *lines, K.END_TEST_OUTPUT]))
    gold = spark.createDataFrame([("a", K.FAIL_TO_PASS, "t2"), ("a", K.PASS_TO_PASS, "t1"), ("b", K.FAIL_TO_PASS, "t1")],
                                 "instance_id string, category string, test string")
    q = grade_stream(spark, f"{tmpdir_path}/logs", gold, f"{tmpdir_path}/graded", f"{tmpdir_path}/ck")
    q.awaitTermination(120)
    got = sorted((r.run_id, r.instance_id, r.resolution) for r in spark.read.parquet(f"{tmpdir_path}/graded").collect())
    batch = grade_batch(read_logs(spark, f"{tmpdir_path}/logs").withColumn("repo", F.lit(None).cast("string")), gold)
    want = sorted((r.run_id, r.instance_id, r.resolution) for r in batch.collect())
    assert got == want == [("run1", "a", K.RESOLVED_NO), ("run1", "b", K.RESOLVED_FULL), ("run2", "a", K.RESOLVED_FULL)]
