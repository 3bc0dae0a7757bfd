"""Registered queries: BM25 retrieval, recall, context packing, prompt text and training
tokens (K1, K2, G5, E7, H2, J1, J3, J4, J7, J8).

Corpus = documents of one language (``corpus_id = lang``); queries = benchmark items, each
searched in every corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.functions.text import word_count, words
from diffloom.operators.joins import broadcast_derived
from diffloom.operators.prompts import code_text, pack_context, render_prompt, text_dataset
from diffloom.operators.retrieval import bm25_index, bm25_search, recall_summary, retrieval_recall
from diffloom.operators.tokens import regex_tokens, register_tokenizer, train_tokens
from diffloom.plans.common import t

K = 20
PACK_LIMIT = 6000      # context limit of the stand-in, in words


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    q = t(spark, sf_dir, "benchmark").select("item_id", "text")
    idx = bm25_index(docs, "lang", "doc_id", "text", q, "text")
    return bm25_search(idx, q, "item_id", "text", k=K)


def bm25_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hits(spark, sf_dir)
    return h.select("query_id", "corpus_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def passage_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item's whole text. Each item is looked for by its longest inner
    word (one with white space on both sides, so it is a word of the document too), and the candidates
    are verified with ``instr``; items of fewer than three words are compared with every document: a
    stated query set. One scan of the documents."""
    bench = t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage")).where(F.length("passage") > 0)
    w = words("passage")
    inner = F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inner, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    items = bench.select("item_id", "passage", F.coalesce(longest, F.lit("")).alias("word"))
    docs = t(spark, sf_dir, "documents").select("doc_id", "text")
    held = docs.select("doc_id", "text", F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words("text")))).alias("word"))
    found = held.join(broadcast_derived(items, bench), "word").where(F.instr("text", F.col("passage")) > 0)
    return found.select("item_id", "doc_id").distinct()


def _recalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hits(spark, sf_dir)
    retrieved = h.select(F.col("query_id").alias("instance_id"), "rank",
                         F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file"))
    gold = passage_gold(spark, sf_dir).select(F.col("item_id").alias("instance_id"),
                                              F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file"))
    return retrieval_recall(retrieved, gold)


def recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 + H2: per item, share of its gold documents among the retrieved ones (all corpora)."""
    return _recalls(spark, sf_dir).select(F.col("instance_id").alias("item_id"), "n_gold", "n_retrieved", "n_hit",
                    F.round("recall", 6).alias("recall"))


def recall_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over the items of recall, of any and of full recall, in percent."""
    return recall_summary(_recalls(spark, sf_dir))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hits(spark, sf_dir)
    dl = t(spark, sf_dir, "documents").select("doc_id", word_count("text").cast("long").alias("tokens"))
    items = h.join(dl, "doc_id").groupBy("query_id", "corpus_id").agg(
        F.collect_list(F.struct(F.col("rank"), F.col("doc_id"), F.col("tokens"))).alias("items"))
    base = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"),
                                                word_count("text").cast("long").alias("base"))
    p = items.join(base, "query_id").withColumn("pk", pack_context(F.col("items"), F.col("base"), F.lit(PACK_LIMIT)))
    return p


def pack_context_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy packing in rank order, strict limit, oversized files skipped."""
    p = _packed(spark, sf_dir)
    return p.select("query_id", "corpus_id", F.size("pk.kept").cast("long").alias("n_taken"),
                    F.col("pk.used").alias("used"),
                    F.array_join(F.transform("pk.kept", lambda x: x.cast("string")), ",").alias("taken"))


def code_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J3 + J7: the packed documents (contents joined last) as a code text, a style-2
    prompt and a text-dataset row; compared by md5 and length."""
    p = _packed(spark, sf_dir).select("query_id", "corpus_id", F.explode("pk.kept").alias("doc_id"))
    docs = t(spark, sf_dir, "documents").select("doc_id", "text")
    files = p.join(docs, "doc_id").groupBy("query_id", "corpus_id").agg(
        F.collect_list(F.struct(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                                F.col("text").alias("content"))).alias("files"))
    st = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("problem_statement"))
    j = files.join(st, "query_id").select(
        F.concat_ws("/", F.col("query_id").cast("string"), "corpus_id").alias("instance_id"),
        "problem_statement", F.size("files").cast("long").alias("n_files"),
        render_prompt("style-2", F.col("problem_statement"), code_text(F.col("files"))).alias("prompt"))
    ds = text_dataset(j, "prompt", carry=("n_files",))
    parts = F.split("instance_id", "/")
    return ds.select(F.try_element_at(parts, F.lit(1)).cast("long").alias("query_id"),
                     F.try_element_at(parts, F.lit(2)).alias("corpus_id"), "n_files",
                     F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("text_chars"))


def md5_ids(text) -> Column:
    """A tokenizer plug-in (M4) whose ids every engine can compute: the first 28 bits of a piece's MD5."""
    return F.transform(regex_tokens(text), lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("int"))


def train_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + M4: user turn = text, the next assistant turn = patch (a turn without an answer has none); the id
    lists themselves, as digests."""
    register_tokenizer("md5", md5_ids)
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("patch"))
    pairs = u.join(a, ["conv_id", "turn"], "left")
    tt = pairs.select("conv_id", "turn", train_tokens(F.col("prompt"), F.col("patch"), "md5").alias("tk"))
    digest = lambda c: F.md5(F.array_join(F.col(c).cast("array<string>"), ","))
    return tt.select("conv_id", "turn", F.size("tk.input_ids").cast("long").alias("n_input_ids"),
                     digest("tk.input_ids").alias("input_md5"), digest("tk.labels").alias("labels_md5"))
