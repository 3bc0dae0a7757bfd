"""File sources and sinks (A1-A15). Schemas are declared; nothing is inferred."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom import schemas
from diffloom.functions.filters import is_test_path_words
from diffloom.functions.text import lit_regex
from diffloom.functions.filters import valid_patch_format
from diffloom.operators.reports import exclude_completed, missing_ids
from diffloom.session import path_exists


def read_instances(spark: SparkSession, path: str, schema=schemas.INSTANCE) -> DataFrame:
    """A1: ``.jsonl`` / ``.jsonl.all`` (one object per line) or ``.json`` (one array)."""
    multi = path.endswith(".json")
    return spark.read.schema(schema).option("multiLine", multi).json(path)


def read_dataset(spark: SparkSession, path: str, split: str | None = None, ids: list[str] | DataFrame | None = None,
                 id_col: str = "instance_id") -> DataFrame:
    """A2: a Parquet dataset (partitioned by ``split``), optional split and id subset; unknown
    requested ids raise (D3). JSON Lines files are read as JSON Lines."""
    if path.endswith(".jsonl") or path.endswith(".json"):
        df = read_instances(spark, path)
    else:
        df = spark.read.parquet(path)
    if split is not None and "split" in df.columns:
        df = df.where(F.col("split") == split)
    if ids is not None:
        req = ids if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], f"{id_col} string")
        miss = [r[0] for r in missing_ids(req, df, id_col).limit(20).collect()]
        if miss:
            raise ValueError(f"instance ids not in the dataset: {miss}")
        df = df.join(req.select(id_col), id_col, "left_semi")
    return df


def read_predictions(spark: SparkSession, path: str, instances: DataFrame | None = None) -> DataFrame:
    """A3: a JSON list, a JSON object keyed by id, JSON Lines, or the word ``gold`` (the
    instances' patch becomes the prediction). Rows without an id raise."""
    if path == "gold":
        if instances is None:
            raise ValueError("gold predictions need the instances")
        return instances.select("instance_id", F.lit("gold").alias("model_name_or_path"),
                                F.col("patch").alias("model_patch"))
    if path.endswith(".jsonl"):
        df = spark.read.schema(schemas.PREDICTION).json(path)
    else:
        raw = spark.read.text(path, wholetext=True)
        first = F.regexp_extract(F.col("value"), r"^\s*(\S)", 1)
        as_list = F.from_json("value", "array<struct<instance_id:string,model_name_or_path:string,model_patch:string>>")
        as_map = F.from_json("value", "map<string,struct<instance_id:string,model_name_or_path:string,model_patch:string>>")
        rows = F.when(first == "[", as_list).otherwise(F.map_values(as_map))
        df = raw.select(F.explode(rows).alias("p")).select("p.*")
    bad = df.where(F.col("instance_id").isNull()).limit(1).count()
    if bad:
        raise ValueError("a prediction has no instance_id")
    return df


def read_logs(spark: SparkSession, root: str, file_name: str = "test_output.txt") -> DataFrame:
    """A5: ``<root>/<run>/<model>/<instance>/test_output.txt`` -> (run_id, model, instance_id,
    log). For large corpora compact this once to Parquet; each file is one cell."""
    df = spark.read.text(os.path.join(root, "*", "*", "*", file_name), wholetext=True)
    p = F.col("_metadata.file_path")
    pat = r"([^/]+)/([^/]+)/([^/]+)/[^/]+$"
    return df.select(F.regexp_extract(p, pat, 1).alias("run_id"),
                     F.regexp_replace(F.regexp_extract(p, pat, 2), "__", "/").alias("model"),
                     F.regexp_extract(p, pat, 3).alias("instance_id"), F.col("value").alias("log"))


def read_result_files(spark: SparkSession, glob: str) -> DataFrame:
    """Result JSON files; ``repo_key_compat`` = file stem up to the first '-' minus the
    ``result_`` prefix (so ``scikit-learn__...`` gives ``scikit``); ``repo_key`` = id without
    its trailing ``-<number>``."""
    df = spark.read.schema(schemas.RESULT_FILE).option("multiLine", True).json(glob)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    return df.select("instance_id", "results",
                     F.regexp_replace(F.substring_index(stem, "-", 1), "^result_", "").alias("repo_key_compat"),
                     F.regexp_extract("instance_id", r"^(.*)-\d+$", 1).alias("repo_key"))


# fixed value: the text put in place of content that is not valid UTF-8
UNDECODABLE = "[could not decode file contents]"


def read_snapshot(spark: SparkSession, root: str, corpus_id: str | None = None, include_tests: bool = False) -> DataFrame:
    """All ``*.py`` files under ``root`` -> (corpus_id, path, content); test files
    (B16 word form on the *relative* path) dropped unless asked for."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.py").load(root))
    root_re = r"^(file:)?" + lit_regex(os.path.abspath(root).rstrip("/") + "/")
    rel = F.regexp_replace(F.col("path"), root_re, "")
    text = F.expr("try_validate_utf8(cast(content as string))")
    out = df.select(F.lit(corpus_id or os.path.basename(os.path.abspath(root))).alias("corpus_id"),
                    rel.alias("path"), F.coalesce(text, F.lit(UNDECODABLE)).alias("content"))
    return out if include_tests else out.where(~is_test_path_words(F.col("path")))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """A8."""
    return spark.read.schema(schemas.HITS).json(path)


def write_hits(hits: DataFrame, path: str) -> None:
    """A8 (``instance_id, hits`` as JSON Lines)."""
    hits.write.mode("append").json(path)


def append_rows(df: DataFrame, path: str, id_col: str = "instance_id", fmt: str = "json") -> DataFrame:
    """A9 + L1: append only rows whose id is not written yet (idempotent reruns). Returns the
    rows that were written."""
    todo = df
    if path_exists(df.sparkSession, path):  # what cannot be read is an error, not an empty output
        done = df.sparkSession.read.schema(df.schema).format(fmt).load(path).select(id_col)
        todo = exclude_completed(df, done, id_col)
    todo.write.mode("append").format(fmt).save(path)
    return todo


def write_candidates(df: DataFrame, path_all: str, path_main: str, test_col: str = "test_patch") -> None:
    """A10: every valid row to ``.all``; rows with a test patch also to the main output."""
    from diffloom.functions.filters import has_test_patch
    df.write.mode("append").json(path_all)
    df.where(has_test_patch(test_col)).write.mode("append").json(path_main)


def output_name(dataset_name: str, prompt_style: str, file_source: str, k: int | None = None,
                max_context_len: int | None = None, tokenizer_name: str | None = None) -> str:
    """A11 name: dataset, prompt style, file source, k or context limit and tokenizer."""
    name = f"{os.path.basename(dataset_name)}__{prompt_style}__fs-{file_source}"
    if k is not None:
        name += f"__k-{k}"
    if max_context_len is not None:
        name += f"__mcc-{max_context_len}-{tokenizer_name}"
    return name


def write_splits(df: DataFrame, path: str) -> None:
    """One dataset per split; an existing output stops the job (errorifexists)."""
    df.write.partitionBy("split").mode("errorifexists").parquet(path)


def merge_parts(spark: SparkSession, glob: str, expected_ids: DataFrame | None = None, id_col: str = "instance_id",
                schema=schemas.INSTANCE) -> DataFrame:
    """Union of worker parts; the check counts distinct ids against the input."""
    df = spark.read.schema(schema).json(glob)
    if expected_ids is not None:
        n_in = expected_ids.select(id_col).distinct().count()
        n_out = df.select(id_col).distinct().count()
        if n_in != n_out:
            raise ValueError(f"merged parts hold {n_out} ids, expected {n_in}")
    return df


def read_patch_dir(spark: SparkSession, glob: str, model_name: str) -> DataFrame:
    """One diff per file; id from the file name; malformed diffs flagged."""
    df = spark.read.text(glob, wholetext=True)
    iid = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    return df.select(iid.alias("instance_id"), F.lit(model_name).alias("model_name_or_path"),
                     F.col("value").alias("model_patch"), valid_patch_format(F.col("value")).alias("well_formed"))


def export_jsonl(df: DataFrame, path: str, split: str | None = None) -> None:
    """A15."""
    (df.where(F.col("split") == split) if split else df).write.mode("overwrite").json(path)
