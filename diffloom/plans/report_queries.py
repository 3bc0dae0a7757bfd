"""Registered queries: run reports with their id lists, instance reports, collection totals and
import closures (E4, E5, E13, A12, C18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators.files import import_closure
from diffloom.operators.grading import grade_tests, instance_report
from diffloom.operators.joins import dealt
from diffloom.operators.logs import parse_logs
from diffloom.operators.reports import collection_stats, report_ids, run_buckets, run_report
from diffloom.plans.common import event_gold, event_logs, t
from diffloom.plans.grading_queries import RUN_KEYS

#: Bytes of the parts' table whose repositories one task makes.
PART_BYTES = 32 << 10


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as the dataset, each labelled one predicted twice (the second counts), reports for en and fr."""
    docs = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("instance_id"), "lang")
    lab = t(spark, sf_dir, "labels").select(F.col("doc_id").alias("instance_id"), "quality", "toxic")
    patch = F.when(F.col("quality") == 1, F.lit("diff")).otherwise(F.lit(""))
    preds = lab.select("instance_id", F.explode(F.array(F.struct(F.lit("old").alias("model_patch"), F.lit(1).alias("pos")),
                                                        F.struct(patch.alias("model_patch"), F.lit(2).alias("pos")))).alias("p")).select("instance_id", "p.*")
    reports = lab.join(docs, "instance_id").where(F.col("lang").isin("en", "fr")).select("instance_id", (F.col("toxic") == 0).alias("resolved"))
    return run_buckets(docs, preds, reports), preds


def run_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: the totals of a run."""
    return run_report(*_run(spark, sf_dir))


def run_report_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id lists of a run, long."""
    return report_ids(*_run(spark, sf_dir))


def instance_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each (run, instance); instances of some users have no patch or an empty one."""
    graded = grade_tests(parse_logs(event_logs(spark, sf_dir), RUN_KEYS, dialects=[K.PYTEST]), event_gold(spark, sf_dir), RUN_KEYS)
    users = t(spark, sf_dir, "events").select((F.col("event_id") / 8192).cast("long").cast("string").alias("run"), "user_id").distinct()
    patch = F.when(F.col("user_id") % 4 == 0, F.lit(None).cast("string")).when(F.col("user_id") % 4 == 1, F.lit("")).otherwise(F.lit("diff"))
    preds = users.select(F.concat(F.lit("run-"), "run").alias("run_id"), F.concat(F.lit("inst-"), F.col("user_id").cast("string")).alias("instance_id"),
                         patch.alias("model_patch"))
    return instance_report(graded, preds, RUN_KEYS)


def collection_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulls seen, instances, those with tests, and those that were written before."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instance_id"), "o_orderstatus")
    inst = o.where("o_orderstatus <> 'P'").withColumn("test_patch", F.when(F.col("instance_id") % 3 == 0, F.lit(" ")).otherwise(F.lit("d")))
    return collection_stats(o, inst, o.where("instance_id % 7 = 0"))


def part_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(corpus_id, path, content): one repository for each part, in which file k imports file k + 1, and some import
    the first again (a ring). The part's size gives how many files: a few, or hundreds for one part in 40. A part's few bytes
    are many files, so parts are dealt to more tasks than the table's files would make."""
    k = F.col("k")
    n = F.when(F.col("p_partkey") % 40 == 0, F.col("p_size") * 8).otherwise(F.col("p_size") % 6)
    parts = t(spark, sf_dir, "part").select("p_partkey", "p_size")
    parts = dealt(parts, parts, PART_BYTES, "p_partkey", "p_size").select(F.col("p_partkey").cast("string").alias("corpus_id"), n.alias("n"))
    files = parts.select("corpus_id", "n", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k"))
    nxt = F.when(k < F.col("n"), F.concat(F.lit("import m"), (k + 1).cast("string"), F.lit("\n"))).when(
        F.col("n") % 2 == 0, F.lit("import m0\n")).otherwise(F.lit("x = 1\n"))
    # an island that nothing reaches is beside every chain
    island = parts.select("corpus_id", F.lit("island/f.py").alias("path"), F.lit("import m0\n").alias("content"))
    return files.select("corpus_id", F.concat(F.lit("m"), k.cast("string"), F.lit("/f.py")).alias("path"), nxt.alias("content")).union(island)


def import_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, file) reached through imports from the first file of each part's repository."""
    files = part_repositories(spark, sf_dir)
    found = import_closure(files, files.where("path = 'm0/f.py'").select("corpus_id", "path"))
    return found.select(F.col("corpus_id").cast("long").alias("p_partkey"), "file")
