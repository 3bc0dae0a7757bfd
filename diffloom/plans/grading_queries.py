"""Registered queries: log parsing and grading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators.grading import grade_tests
from diffloom.operators.logs import parse_logs
from diffloom.plans.common import event_gold, event_logs, t

RUN_KEYS = ["run_id", "instance_id"]
GRADE_COLS = ["run_id", "instance_id", "applied", "f2p_success", "f2p_failure", "p2p_success",
              "p2p_failure", "f2p_rate", "p2p_rate", "resolution"]


def _graded(spark: SparkSession, sf_dir: str, modes: DataFrame | None) -> DataFrame:
    parsed = parse_logs(event_logs(spark, sf_dir), RUN_KEYS, dialects=[K.PYTEST])  # the stand-in logs are pytest logs
    g = grade_tests(parsed, event_gold(spark, sf_dir), RUN_KEYS, modes=modes)
    return g.select(*GRADE_COLS[:7], F.round("f2p_rate", 6).alias("f2p_rate"),
                    F.round("p2p_rate", 6).alias("p2p_rate"), "resolution")


def grade_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: logs -> gate -> section -> pytest lines -> last wins -> grade per run."""
    return _graded(spark, sf_dir, None)


def regrade_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both evaluation modes: instances of odd users are graded fail-only (M6 dimension)."""
    modes = (t(spark, sf_dir, "events").select("user_id").distinct()
             .select(F.concat(F.lit("inst-"), F.col("user_id").cast("string")).alias("instance_id"),
                     F.when(F.col("user_id") % 2 == 1, F.lit(K.FAIL_ONLY))
                     .otherwise(F.lit(K.PASS_AND_FAIL)).alias("eval_type")))
    return _graded(spark, sf_dir, modes)


# ----------------------------------------------------------------------------- E6, E16

from diffloom.operators.reports import result_summary, summary_levels  # noqa: E402
from diffloom.operators.grading import (best_config_per_group, refresh_gold_tests, refresh_id_lists,  # noqa: E402
                                        refreshed_gold_long)
from diffloom.plans.common import F2P_TYPES, event_rows  # noqa: E402


NO_RESULTS = (7, 3)  # users whose id leaves 3 on division by 7 have a result file without tests


def _result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of all events: one instance per user, each event a test run (exit 0 below 60,
    1 below 200, else 4); some users have no tests. Long from the start: the tests of a user may be
    any share of the table."""
    ev = t(spark, sf_dir, "events").select("user_id", "event_type", "value")
    iid = F.concat(F.lit("proj"), (F.col("user_id") % 5).cast("string"), F.lit("__app-"), F.col("user_id").cast("string"))
    code = F.when(F.col("value") < 60, F.lit(0)).when(F.col("value") < 200, F.lit(1)).otherwise(F.lit(4))
    kind = F.when(F.col("event_type").isin(F2P_TYPES), F.lit(K.FAIL_TO_PASS)).otherwise(F.lit(K.PASS_TO_PASS))
    ran = F.col("user_id") % NO_RESULTS[0] != NO_RESULTS[1]
    return ev.select(iid.alias("instance_id"), F.substring_index(iid, "-", 1).alias("repo_key"),
                     F.when(ran, kind).alias("test_type"), F.when(ran, code).alias("exit_code"))


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 + E16 per instance (compat: no tests counts as passed; strict needs one)."""
    per = result_summary(_result_rows(spark, sf_dir))
    return per.select("instance_id", "repo_key", "total_tests", "passed_tests", "fail_to_pass", "pass_to_pass",
                      "has_warning", "n_exit_1", "n_exit_other", "passed_compat", "passed_strict")


def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 totals per repository and overall (``repo_key`` NULL) in one rollup."""
    per = result_summary(_result_rows(spark, sf_dir))
    return summary_levels(per).select("repo_key", "instances", "passed_compat", "passed_strict", "warnings",
                                      F.col("fail_to_pass").cast("long").alias("fail_to_pass"),
                                      F.col("pass_to_pass").cast("long").alias("pass_to_pass"),
                                      F.col("tests").cast("long").alias("tests"))


# ----------------------------------------------------------------------------- E10, E11

def _fresh_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four configurations = four slices of the month; last status per test in each slice."""
    ev = event_rows(spark, sf_dir)
    cfg = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)).cast("int")
    ev = ev.withColumn("config", cfg)
    return ev.groupBy("config", "instance_id", "test").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status"))


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = t(spark, sf_dir, "events").select("user_id").distinct()
    expected = users.select(F.concat(F.lit("inst-"), F.col("user_id").cast("string")).alias("instance_id"),
                            F.explode(F.sequence(F.lit(0), F.lit(3))).alias("config"))
    return refresh_gold_tests(_fresh_statuses(spark, sf_dir), event_gold(spark, sf_dir), expected=expected)


def refresh_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per configuration and instance, new gold lists from fresh statuses (PASSED only)."""
    return _refreshed(spark, sf_dir).select("config", "instance_id", "new_f2p", "new_p2p", "old_f2p", "old_p2p", "no_log",
                                            "reproduced", "not_reproduced", "f2p_changed", "p2p_changed")


def refresh_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new gold lists themselves."""
    return refreshed_gold_long(_fresh_statuses(spark, sf_dir), event_gold(spark, sf_dir))


def refresh_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instances without a log, not reproduced, or with changed lists."""
    return refresh_id_lists(_refreshed(spark, sf_dir))


def best_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per group (instances of users by ``user_id % 3``) the configuration reproducing most
    instances; the lower configuration number wins a tie."""
    r = _refreshed(spark, sf_dir)
    r = r.withColumn("grp", (F.substring("instance_id", 6, 20).cast("long") % 3).cast("int")) \
         .withColumn("config_rank", F.col("config"))
    return best_config_per_group(r, ["grp"], "config", "config_rank")
