"""Registered queries: as-of versioning.

Stand-in: a repository is an order priority; releases are the finished ('F') orders, with
version ``<year-1990>.<month>`` of the order date; instances are the other orders, created at
their order date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.operators.versions import asof_join, asof_version_by_order
from diffloom.plans.common import t


def _sides(spark: SparkSession, sf_dir: str):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("repo"),
                                          "o_orderdate")
    rel = o.where(F.col("o_orderstatus") == "F").select(
        "repo", F.col("o_orderdate").alias("date"),
        F.concat((F.year("o_orderdate") - 1990).cast("string"), F.lit("."),
                 F.month("o_orderdate").cast("string")).alias("version"))
    inst = o.where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("instance_id"), "repo",
                                                         F.col("o_orderdate").alias("created_at"))
    return inst, rel


def asof_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of the newest release strictly before ``created_at`` (NULL if none)."""
    inst, rel = _sides(spark, sf_dir)
    return asof_join(inst, rel, ["repo"], "created_at", "date", ["version"], strict=True) \
        .select("instance_id", "repo", "version")


def asof_version_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 + E9: cutoff = latest date per version; the greatest version (string order) whose
    cutoff is before ``created_at``; else the lowest version of the repository."""
    inst, rel = _sides(spark, sf_dir)
    return asof_version_by_order(inst, rel, ["repo"], "created_at", "version", "date") \
        .select("instance_id", "repo", "version")
