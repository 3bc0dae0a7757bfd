"""Shared pieces of the registered queries: table access and stand-in data rules.

The driver tables hold no logs, diffs or issues, so several queries *build* such text from
structured rows (with Spark, at scale) and then parse it back with the library's operators.
The DuckDB oracles compute the same answer straight from the structured rows, so they check
the parsers independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.sources.tables import load_table

# Stand-in rules (parameters of the stand-in data, mirrored in the oracle SQL)
EVENTS_PER_RUN = 8192          # a run covers this many consecutive event ids: bounds a log
TIMEOUT_VALUE = 300.0          # a log with an event this large carries a timeout marker
NO_END_VALUE = 1.0             # a log whose first event is below this lacks the end marker
F2P_TYPES = ["error", "signup"]  # event types whose tests are FAIL_TO_PASS gold tests


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def status_band(value: Column) -> Column:
    return (F.when(value < 40, F.lit(K.PASSED)).when(value < 80, F.lit(K.FAILED))
            .when(value < 100, F.lit(K.ERROR)).when(value < 130, F.lit(K.XFAIL))
            .otherwise(F.lit(K.SKIPPED)))


def test_name(event_type: Column) -> Column:
    return F.concat(F.lit("tests/test_"), event_type, F.lit(".py::test_"), event_type)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.concat(F.lit("run-"), (F.col("event_id") / F.lit(EVENTS_PER_RUN)).cast("long").cast("string")).alias("run_id"),
        F.concat(F.lit("inst-"), F.col("user_id").cast("string")).alias("instance_id"),
        "user_id", "ts", "event_id", "event_type", "value",
        test_name(F.col("event_type")).alias("test"),
        status_band(F.col("value")).alias("status"))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pytest-style log per (run, instance), lines in (ts, event_id) order.

    A run spans ``EVENTS_PER_RUN`` event ids, so no log exceeds that many lines whatever the
    skew of users. FAILED lines carry a ``' - message'`` tail.
    """
    ev = event_rows(spark, sf_dir)
    line = F.when(F.col("status") == K.FAILED,
                  F.concat(F.lit("FAILED "), F.col("test"), F.lit(" - AssertionError: value "), F.col("value").cast("string"))
                  ).otherwise(F.concat(F.col("status"), F.lit(" "), F.col("test")))
    per = ev.groupBy("run_id", "instance_id").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", line.alias("line")))).alias("ls"),
        F.max("value").alias("vmax"),
        F.min_by("value", F.struct("ts", "event_id")).alias("first_value"))
    log = F.concat_ws(
        "\n", F.lit(K.INSTALL_PASS), F.lit(K.APPLY_PATCH_PASS), F.lit(K.START_TEST_OUTPUT),
        F.concat(F.lit("collected "), F.size("ls").cast("string"), F.lit(" items")),
        F.array_join(F.transform("ls", lambda x: x["line"]), "\n"),
        F.when(F.col("first_value") >= NO_END_VALUE, F.lit(K.END_TEST_OUTPUT)),
        F.when(F.col("vmax") >= TIMEOUT_VALUE, F.lit(K.TESTS_TIMEOUT)),
        F.lit(K.TESTS_FAILED))
    return per.select("run_id", "instance_id", F.lit("pytest-dev/pytest").alias("repo"), log.alias("log"))


def event_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tests of an instance: every event type its user ever had."""
    ev = t(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    return ev.select(F.concat(F.lit("inst-"), F.col("user_id").cast("string")).alias("instance_id"),
                     F.when(F.col("event_type").isin(F2P_TYPES), F.lit(K.FAIL_TO_PASS))
                     .otherwise(F.lit(K.PASS_TO_PASS)).alias("category"),
                     test_name(F.col("event_type")).alias("test"))
