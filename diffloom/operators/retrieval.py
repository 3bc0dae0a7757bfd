"""BM25 retrieval (K1, K2, G5), hits handling (D6) and retrieval recall.

A query batch is searched in two passes over the documents. The first counts, for the terms of
the batch only, the documents of each corpus that hold them, with the corpus sizes and mean
lengths; with the batch it makes one weight row for each (corpus, term, query). The second takes
the occurrences of these terms, deals them out by (corpus, document), and sums each document's
scores where its occurrences are: the weights come to it by broadcast (their size is bounded by
the batch), so no posting list of a frequent term and no table of query-document pairs is
shuffled; only each task's best ``k`` documents of a query are.

Scoring (our own definition; the original used an external library's analyser): lower-case words of
letters, numbers and ``_`` of any script, ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``,
``score = sum_t qtf * idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom.operators.joins import broadcast_derived, dealt

TOKEN_RE = r"[\p{L}\p{N}_]+"
#: Bytes of the documents' table whose scores one task holds.
SCORED_BYTES = 4 << 20
K1 = 0.9
B = 0.4


def terms(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_RE), 0)


def query_terms(queries: DataFrame, query_id_col: str, text_col: str, corpus_col: str | None = None) -> DataFrame:
    """(query_id, [corpus_id,] term, qtf)."""
    keys = ["query_id", *(["corpus_id"] if corpus_col else [])]
    q = queries.select(F.col(query_id_col).alias("query_id"), *([F.col(corpus_col).alias("corpus_id")] if corpus_col else []),
                       F.explode(terms(text_col)).alias("term"))
    return q.groupBy(*keys, "term").agg(F.count("*").alias("qtf"))


def bm25_index(docs: DataFrame, corpus_col: str, doc_col: str, text_col: str, queries: DataFrame, query_text_col: str) -> dict[str, DataFrame]:
    """K1 for a query batch. ``counts``: (corpus_id, term, df, n_docs, avgdl) for the batch's terms, one
    scan; ``occurrences``: (corpus_id, doc_id, dl, term), one row for each occurrence of such a term."""
    batch = queries.select(F.explode(terms(query_text_col)).alias("term")).distinct()
    tok = docs.select(F.col(corpus_col).alias("corpus_id"), F.col(doc_col).alias("doc_id"), terms(text_col).alias("toks"))
    tok = tok.select("corpus_id", "doc_id", F.size("toks").alias("dl"), "toks")
    # each document also has one row without a term, which carries its length
    marked = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("toks"))
    held = tok.select("corpus_id", "dl", F.explode(marked).alias("term"))
    known = broadcast_derived(batch.union(batch.sparkSession.range(1).select(F.lit(None).cast("string").alias("term"))), queries)
    held = held.join(known.withColumnRenamed("term", "known"), F.col("term").eqNullSafe(F.col("known")), "left_semi")
    counts = held.groupBy("corpus_id", "term").agg(F.count("*").alias("df"), F.avg("dl").alias("mean"))
    corpus = Window.partitionBy("corpus_id")  # the batch's terms, not documents
    of_corpus = lambda c: F.max(F.when(F.col("term").isNull(), F.col(c))).over(corpus)
    counts = counts.withColumn("n_docs", of_corpus("df")).withColumn("avgdl", of_corpus("mean")).where("term is not null").drop("mean")
    occurrences = tok.select("corpus_id", "doc_id", "dl", F.explode("toks").alias("term")).join(
        broadcast_derived(batch, queries), "term", "left_semi")
    return {"counts": counts, "occurrences": occurrences, "docs": docs}


def bm25_search(index: dict[str, DataFrame], queries: DataFrame, query_id_col: str, text_col: str,
                corpus_col: str | None = None, k: int = 20, k1: float = K1, b: float = B) -> DataFrame:
    """K2 + G5: top-k ``(query_id, corpus_id, rank, doc_id, score)`` per query and corpus.

    ``corpus_col`` on the queries restricts each query to its own corpus; without it a query
    runs against every corpus (an equi-join on the batch's terms, not a cross product).
    """
    q = query_terms(queries, query_id_col, text_col, corpus_col)
    on = ["corpus_id", "term"] if corpus_col else ["term"]
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = index["counts"].join(q, on).select("corpus_id", "term", "query_id", (F.col("qtf") * idf).alias("w"), "avgdl")
    # a task sorts its documents' scores for every query, many times the rows that are shuffled: the count of tasks follows the documents
    tf = dealt(index["occurrences"], index["docs"], SCORED_BYTES, "corpus_id", "doc_id").groupBy("corpus_id", "doc_id", "dl", "term").agg(F.count("*").alias("tf"))
    hits = tf.join(broadcast_derived(weights, queries), ["corpus_id", "term"])
    part = F.col("w") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    scores = hits.groupBy("query_id", "corpus_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
    w = Window.partitionBy("query_id", "corpus_id").orderBy(F.col("score").desc(), F.col("doc_id"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def attach_hits(instances: DataFrame, hits: DataFrame, k: int, id_col: str = "instance_id") -> DataFrame:
    """Left join, first k hits, absent -> []; duplicate ids in the hits: the last wins
    (``pos`` = file order column when present)."""
    h = hits
    if "pos" in h.columns:
        h = h.groupBy(id_col).agg(F.max_by("hits", "pos").alias("hits"))
    j = instances.join(h.select(id_col, "hits"), id_col, "left")
    empty = F.array().cast(h.schema["hits"].dataType)
    return j.withColumn("hits", F.slice(F.coalesce("hits", empty), 1, k))


def retrieval_recall(retrieved: DataFrame, gold: DataFrame, id_col: str = "instance_id",
                     file_col: str = "file", rank_col: str = "rank") -> DataFrame:
    """E7 per instance: |retrieved ∩ gold| / |gold|. The first retrieved file is dropped when
    its name holds 'readme' (any case); instances with no gold or no retrieved file are left
    out (not scored 0). Long tables in, one row per instance out (joins, no arrays of content).
    """
    dropped = (F.col(rank_col) == 1) & F.lower(F.col(file_col)).contains("readme")
    r = retrieved.where(~dropped).select(id_col, file_col, F.lit(1).alias("r"), F.lit(0).alias("g"))
    both = r.union(gold.select(id_col, file_col, F.lit(0), F.lit(1)))
    files = both.groupBy(id_col, file_col).agg(F.max("r").alias("r"), F.max("g").alias("g"))
    out = files.groupBy(id_col).agg(F.sum("g").alias("n_gold"), F.sum("r").alias("n_retrieved"),
                                    F.sum(F.col("r") * F.col("g")).alias("n_hit")).where("n_gold > 0 and n_retrieved > 0")
    return out.withColumn("recall", F.col("n_hit") / F.col("n_gold"))


def prompt_files(prompt) -> Column:
    """The files that a prompt names, in order and once each: ``[start of p]`` .. ``[end of p]``."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    starts = F.regexp_extract_all(p, F.lit(r"\[start of ([^\]\n]+)\]"), 1)
    return F.array_distinct(F.filter(starts, lambda f: F.instr(p, F.concat(F.lit("[end of "), f, F.lit("]"))) > 0))


def patch_sources(patch) -> Column:
    """The files that a patch changes, by its ``--- a/`` lines, once each."""
    p = F.col(patch) if isinstance(patch, str) else patch
    return F.array_distinct(F.regexp_extract_all(p, F.lit(r"(?m)^--- a/([^\n\t]+)"), 1))


def recall_summary(per_instance: DataFrame) -> DataFrame:
    """E7 totals: means of recall, recall > 0 and recall = 1, times 100, 2 decimals."""
    return per_instance.agg(
        F.round(F.avg("recall") * 100, 2).alias("avg_recall"),
        F.round(F.avg((F.col("recall") > 0).cast("double")) * 100, 2).alias("any_recall"),
        F.round(F.avg((F.col("n_hit") == F.col("n_gold")).cast("double")) * 100, 2).alias("full_recall"),
        F.count("*").alias("n_instances"))
