"""Registered queries: joins, decontamination, sampling, budgets and run reports
(D1, D2, D4, D7, D8, D14, D16, D17, E5, E14, F1, F2, F3, F8, F9, G1, H1, L1, A13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.functions.filters import has_nonempty_prediction
from diffloom.functions.text import word_count
from diffloom.operators.costs import price_calls
from diffloom.operators.reports import exclude_completed, missing_ids, run_buckets, select_runnable
from diffloom.operators.sampling import (exclude_exact_rows, exclude_groups, latest_per_group, sample_per_group,
                                         split_even, stop_at_budget)
from diffloom.plans.common import t


def _docs(spark, sf_dir):
    return t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "instance_id")


def _preds(spark, sf_dir):
    lab = t(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("instance_id"), "quality", "toxic",
                      F.when(F.col("quality") == 1, F.lit("diff --git a/x b/x")).otherwise(F.lit("")).alias("model_patch"))


def runnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + B22: dataset rows with a non-empty prediction."""
    p = _preds(spark, sf_dir).where(has_nonempty_prediction(F.col("model_patch")))
    return select_runnable(_docs(spark, sf_dir).select("instance_id", "lang"), p.select("instance_id", "toxic"))


def completed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 (rows not yet done) + D4 (requested ids unknown to the dataset), one table."""
    docs, preds = _docs(spark, sf_dir), _preds(spark, sf_dir)
    pending = exclude_completed(docs.select("instance_id"), preds).withColumn("kind", F.lit("pending"))
    unknown = missing_ids(preds, docs).withColumn("kind", F.lit("unknown"))
    return pending.unionByName(unknown)


def decontam_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled (training) documents minus those whose exact text is a labelled one."""
    docs, lab = _docs(spark, sf_dir), t(spark, sf_dir, "labels").select(F.col("doc_id").alias("instance_id"))
    train = docs.join(lab, "instance_id", "left_anti").select("instance_id", "text")
    evals = docs.join(lab, "instance_id", "left_semi").select("text")
    return exclude_exact_rows(train, evals, "text").select("instance_id")


def decontam_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training documents from sources that have no toxic-labelled (evaluation) document."""
    docs, lab = _docs(spark, sf_dir), t(spark, sf_dir, "labels")
    evals = docs.join(lab.where(F.col("toxic") == 1).select(F.col("doc_id").alias("instance_id")), "instance_id", "left_semi")
    train = docs.join(lab.select(F.col("doc_id").alias("instance_id")), "instance_id", "left_anti")
    return exclude_groups(train.select("instance_id", "source"), evals, "source")


def sample_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 documents per source in seeded md5 order."""
    d = t(spark, sf_dir, "documents").select("doc_id", "source")
    return sample_per_group(d, ["source"], "doc_id", n=10, seed=42)


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 (+ F9 = a filter on ``part``): orders in key order, four contiguous parts."""
    o = t(spark, sf_dir, "orders").select("o_orderkey")
    return split_even(o, ["o_orderkey"], 4).select("o_orderkey", "part")


# fixed price table of the stand-in (micro-units per word)
ROLE_PRICES = [("system", 1), ("user", 3), ("assistant", 15)]
BUDGET = 3000


def budget_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D14 + G1 + F3: cost per turn from a price dimension, turns in length order, stop once
    the conversation's running cost reaches the budget (the crossing turn is kept)."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("model"), "text")
    c = c.withColumn("n_words", word_count("text")).withColumn("n_chars", F.length("text"))
    prices = spark.createDataFrame(ROLE_PRICES, "model string, price_per_word long")
    c = price_calls(c, prices, "model", "n_words")
    kept = stop_at_budget(c, "cost", BUDGET, ["conv_id"], [F.col("n_chars"), F.col("turn")])
    return kept.select("conv_id", "turn", F.col("cost").cast("long").alias("cost"),
                       F.col("cost_before").cast("long").alias("cost_before"))


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 + D16: newest order per (status, priority), joined to its customer."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    best = latest_per_group(o, ["o_orderstatus", "o_orderpriority"], "o_orderdate", "o_orderkey")
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return best.join(c, "o_custkey", "left").select("o_orderstatus", "o_orderpriority", "o_orderkey", "o_custkey", "c_name")


def run_report_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + D17: documents = dataset, labels = predictions, labelled en/fr documents have a
    report (resolved when not toxic). One row per bucket with count and id checksums."""
    docs, preds = _docs(spark, sf_dir), _preds(spark, sf_dir)
    reports = (preds.join(docs.select("instance_id", "lang"), "instance_id")
               .where(F.col("lang").isin("en", "fr")).select("instance_id", (F.col("toxic") == 0).alias("resolved")))
    b = run_buckets(docs, preds, reports)
    return b.groupBy("bucket").agg(F.count("*").alias("n"), F.min("instance_id").alias("min_id"),
                                   F.max("instance_id").alias("max_id"), F.sum("instance_id").alias("sum_id"))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environment key = first 22 hex of SHA-256 of the spec text; distinct keys."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    spec = F.concat(F.lit('{"brand":"'), F.col("p_brand"), F.lit('","size":'), F.col("p_size").cast("string"),
                    F.lit(',"type":"'), F.col("p_type"), F.lit('"}'))
    k = p.select("p_partkey", F.substring(F.sha2(spec, 256), 1, 22).alias("env_key"))
    return k.groupBy("env_key").agg(F.count("*").alias("n_parts"), F.min("p_partkey").alias("first_partkey"))


def resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + H1 + A13: a first run wrote the labelled documents; the second run takes only the
    rest (anti join on written ids); the union holds every id once."""
    docs = _docs(spark, sf_dir).select("instance_id")
    lab = t(spark, sf_dir, "labels").select(F.col("doc_id").alias("instance_id")).distinct()
    run1 = docs.join(lab, "instance_id", "left_semi").withColumn("run", F.lit(1))
    run2 = exclude_completed(docs, run1).withColumn("run", F.lit(2))
    return run1.unionByName(run2)
