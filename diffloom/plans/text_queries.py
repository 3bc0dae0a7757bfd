"""Registered queries: statement gates and funnel, issue references, hints, repetition and
page extraction (B4-B7, B13, B14, E12, C1, C3, J11, C20-style extraction, H5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.functions.filters import (contains_commit_hash, contains_gitlab_issue, contains_hyperlinks,
                                        contains_keyword_reference, contains_media, max_words)
from diffloom.functions.text import words
from diffloom.operators.funnel import filter_funnel
from diffloom.operators.issues import hints_before_first_commit, pull_text, resolved_issues
from diffloom.operators.tokens import repetition_flag, tail
from diffloom.plans.common import t


def statement_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B14 + E12 + M5: rows left after each statement gate, per language, from a list of filters."""
    txt = F.col("text")
    gates = [("words_ok", ~max_words(txt, 40)), ("no_links", ~contains_hyperlinks(txt)),
             ("no_refs", ~(contains_keyword_reference(txt) | contains_gitlab_issue(txt))),
             ("no_hash", ~contains_commit_hash(txt)), ("kept", ~contains_media(txt))]
    return filter_funnel(t(spark, sf_dir, "documents"), gates, ["lang"], also=[("with_hash", contains_commit_hash(txt))])


def _ref_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_returnflag", "l_linestatus")
    kw = (F.when(F.col("l_returnflag") == "R", F.lit("fixes"))
          .when(F.col("l_returnflag") == "A", F.lit("Closes"))
          .otherwise(F.lit("refs")))
    ref = F.concat(kw, F.lit(" #"), F.col("l_partkey").cast("string"))
    line = F.when(F.col("l_linestatus") == "O", ref).otherwise(F.concat(F.lit("<!-- "), ref, F.lit(" -->")))
    return li.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line")).alias("it"))


def resolved_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pull text (title, body from line items, no commits) -> resolved issue numbers.

    Body lines are ``fixes #p`` (returned), ``Closes #p`` (accepted), ``refs #p`` (not a
    keyword); closed line items are written inside HTML comments and must be ignored.
    """
    per = _ref_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("it")).alias("its"))
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = o.join(per, per.l_orderkey == o.o_orderkey, "left")
    title = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(": "), F.col("o_orderpriority"))
    body = F.array_join(F.transform("its", lambda x: x["line"]), "\n")
    issues = resolved_issues(pull_text(title, body))
    return j.select(F.col("o_orderkey").alias("order_key"),
                    F.size(issues).cast("long").alias("n_resolved"),
                    F.array_join(issues, ",").alias("resolved"))


def hints_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, turns before the first assistant turn (the "first commit"), up
    to the first turn that is too long (prefix, not filter); no assistant turn -> no hints."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    first = c.where(F.col("role") == "assistant").groupBy("conv_id").agg(F.min("turn").alias("first_commit_at"))
    # a comment is "earlier" when it precedes the first commit and is at most 300 characters
    com = c.select("conv_id", F.col("turn").alias("pos"), "text",
                   F.when(F.length("text") <= 300, F.col("turn")).otherwise(F.lit(1 << 30)).alias("updated_at"))
    h = hints_before_first_commit(com, first, keys=("conv_id",), time_col="updated_at")
    agg = h.groupBy("conv_id").agg(F.count("*").alias("n_hints"),
                                   F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("hs"))
    txt = F.array_join(F.transform("hs", lambda x: x["text"]), "\n")
    return agg.select("conv_id", "n_hints", F.md5(txt).alias("hints_md5"), F.length(txt).cast("long").alias("hints_chars"))


def repetition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 on words: documents whose last 100 words hold at most 10 distinct ones."""
    d = t(spark, sf_dir, "documents").select("doc_id", words("text").alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"),
                    F.size(F.array_distinct(tail(F.col("w"), 100))).cast("long").alias("n_distinct_tail"),
                    repetition_flag(F.col("w")).alias("repetitive"))


def release_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20-style extraction + H5: regex fields from raw HTML, exploded links, distinct pairs."""
    p = t(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"),
        F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), 1).alias("links"))
    pages = p.groupBy("host", "lang").agg(F.count("*").alias("n_pages"))
    links = p.select("host", "lang", F.explode("links").alias("href")).dropDuplicates(["host", "lang", "href"]) \
             .groupBy("host", "lang").agg(F.count("*").alias("n_distinct_links"))
    return pages.join(links, ["host", "lang"], "left").fillna(0, ["n_distinct_links"])


def problem_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2: resolved issue numbers of each pull text (as in ``resolved_refs``), then the
    statement ``title\\nbody\\n`` per resolved issue in order, from an issue table (parts:
    number = part key, title = name, body = type); unknown issues are skipped."""
    from diffloom.operators.issues import problem_statement
    per = _ref_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("it")).alias("its"))
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = o.join(per, per.l_orderkey == o.o_orderkey, "left")
    title = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(": "), F.col("o_orderpriority"))
    body = F.array_join(F.transform("its", lambda x: x["line"]), "\n")
    pulls = j.select(F.lit("r").alias("repo"), F.col("o_orderkey").alias("pull_number"),
                     resolved_issues(pull_text(title, body)).alias("resolved_issues"))
    issues = t(spark, sf_dir, "part").select(F.lit("r").alias("repo"), F.col("p_partkey").cast("string").alias("issue_number"),
                                             F.col("p_name").alias("title"), F.col("p_type").alias("body"))
    ps = problem_statement(pulls, issues)
    return ps.select(F.col("pull_number").alias("order_key"), F.md5("problem_statement").alias("statement_md5"),
                     F.length("problem_statement").cast("long").alias("statement_chars"))
