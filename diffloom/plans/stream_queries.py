"""Registered queries over streams (L2-L4): the stand-in rows arrive as files in three drops, and each drop is
taken in by a run of the stream that stops when nothing is left (``availableNow``), as after a restart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.plans.common import event_gold, event_logs, t
from diffloom.plans.grading_queries import GRADE_COLS
from diffloom.plans.patch_queries import order_patches
from diffloom.session import materialize, scratch_path
from diffloom.streaming.incremental import collect_stream, grade_log_stream, graded_schema, regrade


#: Pulls in one file of a drop.
DROP_ROWS = 50_000


def order_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pull rows (the schema of pull files): one for each order with its diff; pending orders are not merged,
    and every fourth resolves no issue."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    p = order_patches(spark, sf_dir).join(o, F.col("order_key") == F.col("o_orderkey"))
    key = F.col("order_key").cast("string")
    issues = F.when(F.col("order_key") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(key))
    return p.select(F.col("order_key").cast("int").alias("number"), F.concat(F.lit("Order "), key).alias("title"),
                    F.concat(F.lit("fixes #"), key).alias("body"), F.lit("2024-01-01T00:00:00Z").alias("created_at"),
                    F.when(F.col("o_orderstatus") != "P", F.lit("2024-02-01T00:00:00Z")).alias("merged_at"), F.lit("").alias("diff_url"),
                    F.struct(F.md5(key).alias("sha"), F.struct(F.lit("own/rep").alias("full_name")).alias("repo")).alias("base"),
                    issues.alias("resolved_issues"), F.col("patch").alias("diff"))


def collected_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2, A10: what ``collect_stream`` has written after three drops of pull files; the second and the third
    bring pulls of earlier ones again. ``in_tests``: whether the row is in the second output."""
    pulls = materialize(order_pulls(spark, sf_dir), "pulls")
    work = scratch_path(spark, f"collect-{uuid.uuid4().hex}")
    again = [F.lit(False), F.col("number") % 6 == 0, (F.col("number") % 5 == 0) & (F.col("number") % 3 != 2)]
    for drop, repeated in enumerate(again):
        arrived = pulls.where((F.col("number") % 3 == drop) | repeated).write.mode("append")
        # diffs repeat themselves; a file that is compressed is read by one task, so its rows are bounded
        arrived.option("compression", "gzip").option("maxRecordsPerFile", DROP_ROWS).json(f"{work}/pulls")
        collect_stream(spark, f"{work}/pulls", f"{work}/all", f"{work}/checkpoint", tests_dir=f"{work}/tests").awaitTermination()
    main = spark.read.parquet(f"{work}/tests").select("instance_id", F.lit(True).alias("in_tests"))
    rows = spark.read.parquet(f"{work}/all").join(main, "instance_id", "left")
    return rows.select("instance_id", F.col("pull_number").cast("long").alias("pull_number"), "base_commit",
                       F.array_join("issue_numbers", ",").alias("issues"), F.md5("problem_statement").alias("statement_md5"),
                       F.coalesce("in_tests", F.lit(False)).alias("in_tests"))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir).select("run_id", F.lit("m").alias("model"), "instance_id", "repo", "log")
    return materialize(logs, "logs")


def _grades(spark: SparkSession, path: str, gold: DataFrame) -> DataFrame:
    g = spark.read.schema(graded_schema(spark, gold)).parquet(path)
    return g.select(*GRADE_COLS[:7], F.round("f2p_rate", 6).alias("f2p_rate"), F.round("p2p_rate", 6).alias("p2p_rate"), "resolution")


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    logs, gold = _logs(spark, sf_dir), materialize(event_gold(spark, sf_dir), "gold")
    work = scratch_path(spark, f"grade-{uuid.uuid4().hex}")
    third = F.crc32(F.concat("run_id", "instance_id")) % 3
    for drop in range(3):
        logs.where((third == drop) | ((third == 0) & F.lit(drop == 2))).write.mode("append").parquet(f"{work}/logs")
        arriving = spark.readStream.schema(logs.schema).parquet(f"{work}/logs")
        grade_log_stream(arriving, gold, f"{work}/graded", f"{work}/checkpoint").awaitTermination()
    return f"{work}/graded", logs, gold


def streamed_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: what ``grade_log_stream`` has written after three drops of logs, the third with all of the first again."""
    path, _, gold = _streamed(spark, sf_dir)
    return _grades(spark, path, gold)


def regraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the output of the stream after the runs of even number were graded again, fail-only."""
    path, logs, gold = _streamed(spark, sf_dir)
    even = F.substring("run_id", 5, 20).cast("long") % 2 == 0
    modes = gold.select("instance_id").distinct().withColumn("eval_type", F.lit(K.FAIL_ONLY))
    regrade(logs.where(even), gold, path, modes=modes)
    return _grades(spark, path, gold)
