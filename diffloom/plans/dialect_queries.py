"""Registered query over logs of every dialect (I1-I13, I15, F5, F6): the events of a (run, instance)
written as that dialect's lines, by user, and parsed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators.logs import parse_logs
from diffloom.plans.common import TIMEOUT_VALUE, event_rows

# the dialect of a user's logs is that of this repository, by user_id modulo the length
REPOS = ["pytest-dev/pytest", "psf/requests", "astropy/astropy", "mwaskom/seaborn", "matplotlib/matplotlib", "sympy/sympy",
         "django/django", "chartjs/Chart.js", "markedjs/marked", "diegomura/react-pdf", "Automattic/wp-calypso", "nobody/knows"]


def _line(kind: Column, status: Column) -> list[Column]:
    """The line of a test ``kind`` with ``status`` in the dialect of each of ``REPOS``."""
    passed, failed = status == K.PASSED, status == K.FAILED
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return [
        text(status, " t.py::", kind, F.when(failed, F.lit(" - why")).otherwise(F.lit(""))),
        text(status, " t.py::", kind, "[/tmp/dir/", kind, "]"),
        F.when(passed, text("t.py::", kind, " PASSED")).otherwise(text("\x1b[31m", status, "\x1b[0m t.py::", kind)),
        F.when(passed, text("t.py::", kind, " PASSED [ 50%]")).otherwise(text(status, " t.py::", kind, " - why")),
        text(status, " t.py::", kind, "[MouseButton.LEFT]"),
        text("test_", kind, F.when(passed, F.lit(" ok")).when(failed, F.lit(" F")).when(status == K.ERROR, F.lit(" E")).otherwise(F.lit(" s"))),
        F.when(passed, text("test_", kind, " (m.T) ... some output\nok"))
        .otherwise(text("test_", kind, " (m.T) ... ", F.when(failed, F.lit("FAIL")).when(status == K.ERROR, F.lit("ERROR"))
                        .when(status == K.SKIPPED, F.lit("skipped 'no'")).otherwise(F.lit("expected failure")))),
        text("Chrome 78.0.3904 (Linux 0.0.0) ", kind, " works ", F.when(failed, F.lit("FAILED")).otherwise(F.lit("done"))),
        F.when(failed, text("12) ", kind, " renders ")).otherwise(text("ok ", kind)),
        text(F.when(passed, F.lit("PASS ")).when(failed, F.lit("FAIL ")).otherwise(F.lit("SKIP ")), "tests/", kind, ".test.js (1.2 s)"),
        F.when(passed, text("    ✓ does ", kind, " (5ms)")).when(failed, text("    ✕ does ", kind)).otherwise(text("not indented ", kind)),
        text(status, " t.py::", kind),
    ]


def dialect_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_rows(spark, sf_dir).withColumn("d", (F.col("user_id") % len(REPOS)).cast("int"))
    lines = _line(F.col("event_type"), F.col("status"))
    line = F.lit(None).cast("string")
    for k, c in reversed(list(enumerate(lines))):
        line = F.when(F.col("d") == k, c).otherwise(line)
    repo = F.element_at(F.array(*[F.lit(r) for r in REPOS]), F.col("d") + 1)
    # a run covers a fixed number of events, so a log is bounded
    per = ev.groupBy("run_id", "instance_id", repo.alias("repo")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", line.alias("line")))).alias("ls"), F.max("value").alias("vmax"))
    suite = F.when(F.col("repo") == "Automattic/wp-calypso", F.lit(" ./node_modules/.bin/jest a.js\n  suite\n")).otherwise(F.lit(""))
    log = F.concat_ws("\n", F.lit(K.APPLY_PATCH_PASS), F.lit(K.START_TEST_OUTPUT),
                      F.concat(suite, F.array_join(F.transform("ls", lambda x: x["line"]), "\n")), F.lit(K.END_TEST_OUTPUT),
                      F.when(F.col("vmax") >= TIMEOUT_VALUE, F.lit(K.TESTS_TIMEOUT)))
    return per.select("run_id", "instance_id", "repo", log.alias("log"))


def grade_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test's last status, whatever the dialect; one row without a test for logs that were not
    applied, hold no readable result, or are rejects."""
    parsed = parse_logs(dialect_logs(spark, sf_dir), ["run_id", "instance_id"])
    return parsed.select("run_id", "instance_id", "applied", "reject_reason", F.explode_outer("tests").alias("test", "status"))
