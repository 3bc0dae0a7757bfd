"""The registered queries of the operators: each applies its operator, with production
parameters, to its whole table and derives the contract's columns from the operator's output.

Each query's columns of documents are the id and the text, so extra columns, and columns with
the names of results, cannot clash with anything.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.llm.common import documents, fold_of, prepare
from diffloom.session import materialize, scratch_path
from diffloom.sources.tables import load_table


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.quality_rules import rules

    found = documents(spark, sf_dir).select("doc_id", rules(F.col("text")).alias("r"))
    return found.select("doc_id", "r.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.simhash import hex16, near_duplicates

    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from diffloom.llm import bpe

    file = bpe.load(spark, public_tokenizers.path("word_bpe_49k.json"))
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(coded: pd.DataFrame) -> pd.DataFrame:
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return pd.DataFrame({"n_tokens": [len(i) for i in coded["ids"]],
                             "ids_sha256": [sha(" ".join(map(str, i.tolist()))) for i in coded["ids"]],
                             "decoded_sha256": [sha(t) for t in coded["text"]]})

    found = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), file, then=("d", digests))
    return found.select("doc_id", "d.*")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.multiset_hash import edited

    found = edited(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
                        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.pii import fit, spans

    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", spans(F.col("text"), fit(docs)).alias("s"))
    return found.select("doc_id", "s.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm import mixing as M

    docs = documents(spark, sf_dir).select("doc_id", M.domain_of(F.col("source")).alias("domain"), "lang", "source",
                                           M.word_count(F.col("text")).alias("n_tokens"))
    docs = materialize(docs, "mix-documents")  # ids, levels and counts: no texts
    return M.mix(docs, M.LEVELS, M.WEIGHTS, "n_tokens", seed=M.SEED, max_epochs=M.MAX_EPOCHS, percent=M.PERCENT)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.warc import read_archive, write_archive

    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archive(load_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.ppm import language_model

    return language_model(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm import quality_cnn as C

    docs = documents(spark, sf_dir)
    net = C.fit(docs, load_table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), C.score(F.col("text"), net).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= C.THRESHOLD).cast("int"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.suffix_dedup import repeated_spans

    return repeated_spans(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm import conversation_repair as C

    prepare(spark)
    table = load_table(spark, sf_dir, "conversations")
    rows = C.damaged(table)
    report = materialize(C.repair(rows), "conversation-report")
    sha = C.digests(rows, report).withColumnRenamed("conv", "sha_conv")
    found = report.join(sha, F.col("conv").eqNullSafe(F.col("sha_conv")))
    every = table.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm import spelling as S

    words = materialize(S.word_counts(documents(spark, sf_dir), change=S.typo), "spelling-words")
    return S.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from diffloom.llm.ngram_join import near_duplicates

    return near_duplicates(documents(spark, sf_dir))
