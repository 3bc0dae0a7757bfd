"""Registered queries over orders, samples, cutoffs, file snapshots and releases built from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators.costs import fits_model_context
from diffloom.operators.files import doc_contents, parse_test_ids
from diffloom.operators.issues import take_until_cutoff, tracker_hints
from diffloom.operators.prompts import readme_files, select_files
from diffloom.operators.sampling import contiguous_shard, from_id_limit, sample_n, union_distinct
from diffloom.operators.versions import release_table, version_from_files
from diffloom.plans.common import t

START, LIMIT, SAMPLE = 700, 40, 25
CONTEXT = [("en", 400), ("de", 300), ("fr", 200)]


def order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by what a shard, a sample, a restart and a cutoff take of them."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instance_id"), "o_orderpriority", "o_orderdate")
    cutoff = F.lit("2000-06-15").cast("timestamp_ntz")
    newest = take_until_cutoff(o, cutoff, "o_orderdate", ["o_orderpriority"], ("o_orderdate", "instance_id"))
    first = take_until_cutoff(o, None, "o_orderdate", ["o_orderpriority"], ("o_orderdate", "instance_id"), max_rows=3)
    parts = {"shard": contiguous_shard(o, ["instance_id"], 1, 4), "sample": sample_n(o, "instance_id", SAMPLE, seed=7),
             "from_id": from_id_limit(o, ["instance_id"], "instance_id", START, LIMIT),
             "cutoff": newest, "newest": first,
             "union": union_distinct(o.where("instance_id % 3 = 0").select("instance_id"), o.where("instance_id % 5 = 0").select("instance_id"))}
    out = None
    for kind, df in parts.items():
        part = df.select(F.lit(kind).alias("kind"), "instance_id")
        out = part if out is None else out.union(part)
    return out


def context_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose characters fit the limit of their language's model."""
    limits = spark.createDataFrame(CONTEXT, "lang string, context_limit int")
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", F.length("text").alias("n"))
    return fits_model_context(d, limits, "lang", "n").select("doc_id", "lang")


def file_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, versions and test ids of one small repository for each part."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    init = F.concat(F.lit('"""\nversion = "9.9"\n"""\n'), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit('version = "'), size, F.lit('.2.1"\n'))).otherwise(F.lit("")))
    setup = F.concat(F.lit("VERSION = ("), size, F.lit(", 7)\n"))
    texts = [("pkg/__init__.py", init), ("setup.py", setup), ("README.md", F.col("p_name")), ("docs/README.md", F.lit("no"))]
    files = p.select(key.alias("corpus_id"), F.explode(F.array(*[F.struct(F.lit(n).alias("path"), c.alias("content")) for n, c in texts])).alias("f"))
    files = files.select("corpus_id", "f.path", "f.content")
    inst = p.select(F.col("p_partkey").alias("instance_id"), F.lit("o/r").alias("repo"), key.alias("corpus_id"), F.col("p_name").alias("name"))
    paths = spark.createDataFrame([("o/r", "pkg/__init__.py", 0), ("o/r", "setup.py", 1)], "repo string, path string, rank int")
    patterns = spark.createDataFrame([("o/r", r'version = "([^"]*)"', 0), ("o/r", r"VERSION = \((.*)\)", 1)], "repo string, pattern string, rank int")
    versions = version_from_files(inst, files, paths, patterns).select(F.lit("version").alias("kind"), "instance_id", F.col("version").alias("value"))
    tests = inst.select("instance_id", F.array(F.concat(F.lit("t.py::"), F.col("name")), F.lit("odd")).alias(K.FAIL_TO_PASS),
                        F.array(F.concat(F.lit("test_"), F.col("corpus_id"), F.lit(" (a.b.Case)"))).alias(K.PASS_TO_PASS))
    ids = parse_test_ids(tests).select(F.lit("test").alias("kind"), "instance_id", F.concat_ws("|", "test_file", "test_case", "test_type").alias("value"))
    readmes = readme_files(files).select(F.lit("readme").alias("kind"), F.col("corpus_id").cast("long").alias("instance_id"), F.md5(doc_contents("path", "content")).alias("value"))
    every = select_files(inst, "all", snapshot=files).select(F.lit("file").alias("kind"), "instance_id", F.col("path").alias("value"))
    return versions.union(ids).union(readmes).union(every)


def release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20, H5: version and date pairs read from pages of releases, one page for each customer."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.lit("soon"))
    item = F.concat(F.lit("<li>v"), (F.col("o_orderkey") % 5).cast("string"), F.lit("."), (F.col("o_orderkey") % 7).cast("string"),
                    F.lit(".0 ("), day, F.lit(")</li>"))
    # a page holds a customer's orders of one block of keys, so it is bounded
    pages = o.groupBy(F.col("o_custkey").alias("repo"), (F.col("o_orderkey") / 8192).cast("long")).agg(F.concat_ws("\n", F.collect_list(item)).alias("html"))
    return release_table(pages, r"<li>v([\d.]+) \(([^)]*)\)</li>", ["yyyy-MM-dd", "dd.MM.yyyy"])


def early_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: comments on an order's ticket before its first commit; times that cannot be read are kept as errors."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    minute = F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0")
    when = F.when(F.col("l_linenumber") == 7, F.lit("yesterday")).otherwise(F.concat(F.lit("See timeline at 05/17/12 10:"), minute, F.lit(":00")))
    c = li.select(F.lit("r").alias("repo"), F.col("l_orderkey").alias("pull_number"),
                  F.concat(F.lit("note "), F.col("l_partkey").cast("string")).alias("comment"), when.alias("timestamp"))
    first = t(spark, sf_dir, "orders").select(F.lit("r").alias("repo"), F.col("o_orderkey").alias("pull_number"),
                                              F.lit("2012-05-17 10:30:00").cast("timestamp").alias("first_commit_at"))
    return tracker_hints(c, first).select("pull_number", "text", "time_error")
