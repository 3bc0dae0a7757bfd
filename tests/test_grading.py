"""Grading edge cases (FIXTURES §8: grading, run report)."""

from diffloom import constants as K
from diffloom.operators.grading import grade_tests, refresh_gold_tests, refreshed_gold_long
from diffloom.operators.reports import report_ids, report_name, run_buckets, run_report, write_report_ids

KEYS = ["run_id", "instance_id"]


def _grade(spark, statuses, gold, modes=None):
    ids = sorted({g[0] for g in gold} | {s[0] for s in statuses} | {"none"})
    parsed = spark.createDataFrame([("r", i, True, None, {t: x for j, t, x in statuses if j == i}) for i in ids],
                                   "run_id string, instance_id string, applied boolean, reject_reason string, tests map<string,string>")
    gd = spark.createDataFrame(gold or [("zz", K.FAIL_TO_PASS, "zz")], "instance_id string, category string, test string")
    md = spark.createDataFrame(modes, "instance_id string, eval_type string") if modes else None
    return {r["instance_id"]: r.asDict() for r in grade_tests(parsed, gd, KEYS, modes=md).collect()}


def test_lists_and_rejected_logs(spark):
    parsed = spark.createDataFrame([("r", "a", True, None, {"t1": "PASSED", "p1": "FAILED"}), ("r", "b", True, "unknown dialect", None),
                                    ("r", "c", False, None, None)],
                                   "run_id string, instance_id string, applied boolean, reject_reason string, tests map<string,string>")
    gold = spark.createDataFrame([("a", K.FAIL_TO_PASS, "t1"), ("a", K.PASS_TO_PASS, "p1"), ("c", K.FAIL_TO_PASS, "t1")],
                                 "instance_id string, category string, test string")
    got = {r.instance_id: r for r in grade_tests(parsed, gold, KEYS, with_lists=True).collect()}
    assert set(got) == {"a", "c"}  # a log that nothing can read is not a failure
    assert got["a"].f2p_success_tests == ["t1"] and got["a"].p2p_failure_tests == ["p1"]
    assert got["c"].f2p_success is None and got["c"].resolution == K.RESOLVED_NO


def test_refresh_keeps_pairs_without_passed_tests(spark):
    st = spark.createDataFrame([(0, "a", "t1", "PASSED"), (0, "a", "p1", "PASSED"), (0, "a", "new", "PASSED"), (0, "b", "t1", "FAILED")],
                               "config int, instance_id string, test string, status string")
    gold = spark.createDataFrame([("a", K.FAIL_TO_PASS, "t1"), ("a", K.PASS_TO_PASS, "p1"), ("b", K.FAIL_TO_PASS, "t1")],
                                 "instance_id string, category string, test string")
    expected = spark.createDataFrame([(0, "a"), (0, "b"), (1, "a")], "config int, instance_id string")
    got = {(r.config, r.instance_id): r for r in refresh_gold_tests(st, gold, expected=expected).collect()}
    assert set(got) == {(0, "a"), (0, "b"), (1, "a")}
    assert got[0, "a"].reproduced and got[0, "b"].not_reproduced and got[1, "a"].no_log and not got[1, "a"].not_reproduced
    long = {tuple(r) for r in refreshed_gold_long(st, gold).select("instance_id", "category", "test").collect()}
    assert long == {("a", K.FAIL_TO_PASS, "t1"), ("a", K.PASS_TO_PASS, "p1"), ("a", K.PASS_TO_PASS, "new")}


def test_no_gold_tests_is_full(spark):
    g = _grade(spark, [], [])
    assert g["none"]["resolution"] == K.RESOLVED_FULL and g["none"]["f2p_rate"] == 1.0


def test_partial_and_skipped(spark):
    gold = [("a", K.FAIL_TO_PASS, "t1"), ("a", K.FAIL_TO_PASS, "t2"), ("a", K.PASS_TO_PASS, "p1"),
            ("a", K.PASS_TO_PASS, "p2")]
    st = [("a", "t1", "PASSED"), ("a", "t2", "FAILED"), ("a", "p1", "XFAIL"), ("a", "p2", "SKIPPED")]
    g = _grade(spark, st, gold)["a"]
    # SKIPPED p2 is in neither list: p2p = 1/1
    assert (g["f2p_success"], g["f2p_failure"], g["p2p_success"], g["p2p_failure"]) == (1, 1, 1, 0)
    assert g["resolution"] == K.RESOLVED_PARTIAL


def test_absent_counts_as_failure_except_fail_only(spark):
    gold = [("a", K.FAIL_TO_PASS, "t1"), ("b", K.FAIL_TO_PASS, "t1")]
    g = _grade(spark, [], gold, modes=[("a", K.PASS_AND_FAIL), ("b", K.FAIL_ONLY)])
    assert g["a"]["resolution"] == K.RESOLVED_NO and g["a"]["f2p_failure"] == 1
    assert g["b"]["resolution"] == K.RESOLVED_FULL and g["b"]["f2p_success"] == 1


def test_report_lists_and_repeated_predictions(spark, tmpdir_path):
    ds = spark.createDataFrame([(i,) for i in "abc"], "instance_id string")
    preds = spark.createDataFrame([("a", "old", 1), ("a", "", 2), ("b", "x", 3), ("b", "x", 4)], "instance_id string, model_patch string, pos int")
    reps = spark.createDataFrame([("b", False), ("b", True)], "instance_id string, resolved boolean")
    buckets = run_buckets(ds, preds, reps)
    assert sorted(map(tuple, buckets.collect())) == [("a", "empty_patch"), ("b", "resolved"), ("c", "incomplete")]
    ids = report_ids(buckets, preds)
    assert sorted(map(tuple, ids.collect())) == [("completed_ids", "b"), ("empty_patch_ids", "a"), ("incomplete_ids", "c"),
                                                 ("resolved_ids", "b"), ("submitted_ids", "a"), ("submitted_ids", "b")]
    write_report_ids(ids, f"{tmpdir_path}/lists")
    assert spark.read.json(f"{tmpdir_path}/lists").where("list = 'submitted_ids'").count() == 2
    totals = run_report(buckets, preds).first()
    assert (totals.total_instances, totals.submitted_instances, totals.resolved_instances, totals.schema_version) == (3, 2, 1, 2)
    assert report_name("org/model", "run1") == "org__model.run1.json"


def test_run_buckets_each_once(spark):
    ds = spark.createDataFrame([(i,) for i in ["a", "b", "c", "d", "e", "f"]], "instance_id string")
    preds = spark.createDataFrame([("b", ""), ("c", None), ("d", "x"), ("e", "x"), ("f", "x"), ("zz", "x")],
                                  "instance_id string, model_patch string")
    reps = spark.createDataFrame([("d", True), ("e", False)], "instance_id string, resolved boolean")
    b = {r[0]: r[1] for r in run_buckets(ds, preds, reps).collect()}
    assert b == {"a": "incomplete", "b": "empty_patch", "c": "empty_patch", "d": "resolved",
                 "e": "unresolved", "f": "error"}
