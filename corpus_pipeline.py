"""The corpus pipeline: documents pass the stages in order, each written as Parquet and read
again before the next. Every stage works on all that its predecessor kept, and all but the last
return the columns of documents.

Nulls in any column, empty texts, repeated rows and empty tables pass as each operator defines
them; columns beyond those of documents are left behind by the first stage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.llm import bpe, mixing, pii, quality_rules, simhash
from diffloom.llm.common import prepare
from diffloom.session import checkpoint_dir, delete_path, scratch_scope
from diffloom.sources.tables import load_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality_rules.keep_passing(docs.select(COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    prepare(spark)
    return simhash.keep_one(docs.select(COLUMNS))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets; ``n_chars`` follows. The
    field is fitted to a bounded sample of the documents that came here."""
    prepare(spark)
    docs = docs.select(COLUMNS)
    clean = pii.redacted(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each (domain, language, source) fills its share of the token budget; a document that a leaf
    takes in two epochs comes twice."""
    prepare(spark)
    named = docs.select(*COLUMNS, mixing.domain_of(F.col("source")).alias("domain"),
                        mixing.word_count(F.col("text")).alias("n_tokens"))
    return mixing.mix(named, mixing.LEVELS, mixing.WEIGHTS, "n_tokens", seed=mixing.SEED, max_epochs=mixing.MAX_EPOCHS,
                      percent=mixing.PERCENT).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids of the public word vocabulary."""
    import public_tokenizers

    prepare(spark)
    file = bpe.load(spark, public_tokenizers.path("word_bpe_49k.json"))
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), file)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality), ("simhash", near_dedup), ("pii", redact), ("mixing", mix), ("bpe", encode)]

#: SQL cannot express the stages; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table ``documents``. The tables between them are in the shared
    checkpoint folder, so a lost executor costs no more than the stage at work; what a stage has
    written for itself, and its input, go when its result is there."""
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, before = load_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = os.path.join(folder, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
