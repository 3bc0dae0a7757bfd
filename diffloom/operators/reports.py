"""Run selection and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diffloom import constants as K


def last_prediction_per_id(predictions: DataFrame, id_col: str = "instance_id", pos_col: str = "pos") -> DataFrame:
    """D1 detail: predictions become a map keyed by id, so the last row per id wins."""
    cols = [c for c in predictions.columns if c not in (id_col,)]
    return predictions.groupBy(id_col).agg(F.max_by(F.struct(*cols), pos_col).alias("p")).select(id_col, "p.*")


def select_runnable(instances: DataFrame, predictions: DataFrame, id_col: str = "instance_id",
                    ids: DataFrame | None = None) -> DataFrame:
    """Instances with a prediction (optionally restricted to an id list by semi join)."""
    j = instances.join(predictions, id_col)
    return j.join(ids.select(id_col), id_col, "left_semi") if ids is not None else j


def exclude_completed(df: DataFrame, done: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """Drop rows already finished."""
    return df.join(done.select(id_col), id_col, "left_anti")


def missing_ids(requested: DataFrame, known: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """Requested ids that are not known (a warning table)."""
    return requested.select(id_col).distinct().join(known.select(id_col), id_col, "left_anti")


def require_known_ids(requested: DataFrame, known: DataFrame, id_col: str = "instance_id", show: int = 20) -> None:
    """D3: raise when ids are unknown, listing at most ``show`` of them (never all)."""
    miss = [r[0] for r in missing_ids(requested, known, id_col).limit(show).collect()]
    if miss:
        raise ValueError(f"unknown instance ids (first {len(miss)}): {miss}")


def with_outputs_only(df: DataFrame, logs: DataFrame, predictions: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """Re-grade mode keeps rows that have both a log and a prediction."""
    return df.join(logs.select(id_col), id_col, "left_semi").join(predictions.select(id_col), id_col, "left_semi")


def locate_outputs(df: DataFrame, outputs: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """Adds ``has_output``."""
    o = outputs.select(id_col).distinct().withColumn("has_output", F.lit(True))
    return df.join(o, id_col, "left").fillna(False, ["has_output"])


# fixed values: run-report buckets, first rule wins
INCOMPLETE, EMPTY_PATCH, RESOLVED, UNRESOLVED, ERROR = "incomplete", "empty_patch", "resolved", "unresolved", "error"


def run_buckets(dataset: DataFrame, predictions: DataFrame, reports: DataFrame, id_col: str = "instance_id",
                patch_col: str = "model_patch") -> DataFrame:
    """E5 per instance, one row each however often it was predicted or reported (the last prediction by
    ``pos`` counts, or else the greatest patch; one resolved report suffices): no prediction -> incomplete; '' or NULL patch -> empty_patch; a report
    -> resolved / unresolved; else error. ``reports``: (id, resolved)."""
    if "pos" in predictions.columns:
        p = last_prediction_per_id(predictions, id_col)
    else:
        p = predictions.groupBy(id_col).agg(F.max(patch_col).alias(patch_col))
    p = p.select(id_col, patch_col).withColumn("__has_pred", F.lit(True))
    r = reports.groupBy(id_col).agg(F.coalesce(F.bool_or("resolved"), F.lit(False)).alias("__resolved")).withColumn("__has_report", F.lit(True))
    j = dataset.select(id_col).join(p, id_col, "left").join(r, id_col, "left")
    bucket = (F.when(F.col("__has_pred").isNull(), F.lit(INCOMPLETE))
              .when(F.coalesce(F.col(patch_col), F.lit("")) == "", F.lit(EMPTY_PATCH))
              .when(F.col("__has_report").isNotNull(),
                    F.when(F.col("__resolved"), F.lit(RESOLVED)).otherwise(F.lit(UNRESOLVED)))
              .otherwise(F.lit(ERROR)))
    return j.select(id_col, bucket.alias("bucket"))


def run_report(buckets: DataFrame, predictions: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """E5 totals in one aggregate; id lists stay in the bucket table (sorted lists of a whole
    dataset would pass through one row)."""
    b = F.col("bucket")
    totals = buckets.agg(
        F.count("*").alias("total_instances"),
        F.count_if(b.isin(RESOLVED, UNRESOLVED)).alias("completed_instances"),
        F.count_if(b == RESOLVED).alias("resolved_instances"),
        F.count_if(b == UNRESOLVED).alias("unresolved_instances"),
        F.count_if(b == EMPTY_PATCH).alias("empty_patch_instances"),
        F.count_if(b == ERROR).alias("error_instances"),
        F.count_if(b == INCOMPLETE).alias("incomplete_instances"))
    sub = predictions.agg(F.countDistinct(id_col).alias("submitted_instances"))
    # both sides are single-row global aggregates: a one-row equi-join on a constant
    return (totals.withColumn("__k", F.lit(1)).join(sub.withColumn("__k", F.lit(1)), "__k").drop("__k")
            .withColumn("schema_version", F.lit(K.REPORT_SCHEMA_VERSION)))


# fixed values: the id lists of a run report, with the buckets each holds
REPORT_LISTS = {
    "completed_ids": [RESOLVED, UNRESOLVED], "incomplete_ids": [INCOMPLETE], "empty_patch_ids": [EMPTY_PATCH],
    "resolved_ids": [RESOLVED], "unresolved_ids": [UNRESOLVED], "error_ids": [ERROR],
}


def report_ids(buckets: DataFrame, predictions: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """E5 id lists as a long table ``(list, id)``, with ``submitted_ids`` from the predictions: the
    lists of a whole dataset do not pass through one row."""
    member = F.array_compact(F.array(*[F.when(F.col("bucket").isin(b), F.lit(n)) for n, b in REPORT_LISTS.items()]))
    own = buckets.select(F.explode(member).alias("list"), id_col)
    return own.union(predictions.select(F.lit("submitted_ids").alias("list"), id_col).distinct())


def write_report_ids(ids: DataFrame, path: str, id_col: str = "instance_id") -> None:
    """The id lists, sorted, one partition folder for each list."""
    ids.repartitionByRange("list", id_col).sortWithinPartitions("list", id_col).write.partitionBy("list").mode("overwrite").json(path)


def report_name(model: str, run_id: str) -> str:
    """``<model>.<run>.json``, with ``/`` in the model as ``__``."""
    return f"{model.replace('/', '__')}.{run_id}.json"


def write_report(report: DataFrame, path: str) -> None:
    """The report row as JSON text (one small row: coalesce(1) is bounded)."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def result_rows(results: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """A6 + I16: explode result files; exit code 0 passes, 1 fails, others warn."""
    r = results.select(id_col, "repo_key", F.explode_outer("results").alias("r"))
    return r.select(id_col, "repo_key", F.col("r.test_type").alias("test_type"),
                    F.col("r.test_case").alias("test_case"), F.col("r.exit_code").alias("exit_code"))


def result_summary(rows: DataFrame, id_col: str = "instance_id", repo_col: str = "repo_key") -> DataFrame:
    """E6 + E16 per instance, then per repository and overall in one GROUPING SETS pass.

    ``passed_compat``: passed == total (an instance without tests passes); ``passed_strict``
    also needs at least one test. Totals count instances, F2P/P2P passes and warnings.
    """
    has = F.col("exit_code").isNotNull()
    per = rows.groupBy(repo_col, id_col).agg(
        F.count_if(has).alias("total_tests"),
        F.count_if(F.col("exit_code") == 0).alias("passed_tests"),
        F.count_if((F.col("test_type") == K.FAIL_TO_PASS) & (F.col("exit_code") == 0)).alias("fail_to_pass"),
        F.count_if((F.col("test_type") == K.PASS_TO_PASS) & (F.col("exit_code") == 0)).alias("pass_to_pass"),
        F.coalesce(F.bool_or(has & ~F.col("exit_code").isin(0, 1)), F.lit(False)).alias("has_warning"),
        F.count_if(F.col("exit_code") == 1).alias("n_exit_1"),
        F.count_if(has & ~F.col("exit_code").isin(0, 1)).alias("n_exit_other"))
    per = per.withColumn("passed_compat", F.col("passed_tests") == F.col("total_tests")) \
             .withColumn("passed_strict", (F.col("passed_tests") == F.col("total_tests")) & (F.col("total_tests") > 0))
    return per


def summary_levels(per: DataFrame, repo_col: str = "repo_key") -> DataFrame:
    """E6 repository and overall totals in one pass (``rollup`` = grouping sets (repo), ())."""
    return per.rollup(repo_col).agg(
        F.count("*").alias("instances"),
        F.count_if("passed_compat").alias("passed_compat"),
        F.count_if("passed_strict").alias("passed_strict"),
        F.count_if("has_warning").alias("warnings"),
        F.sum("fail_to_pass").alias("fail_to_pass"),
        F.sum("pass_to_pass").alias("pass_to_pass"),
        F.sum("total_tests").alias("tests"))


def collection_stats(pulls: DataFrame, instances: DataFrame, written: DataFrame | None = None,
                     id_col: str = "instance_id") -> DataFrame:
    """Totals of a collection run in one pass each: pulls seen, valid instances, with
    tests, and skipped (already written)."""
    from diffloom.functions.filters import has_test_patch
    p = pulls.agg(F.count("*").alias("total_pulls"))
    i = instances.agg(F.count("*").alias("completed"), F.count_if(has_test_patch("test_patch")).alias("with_tests"))
    out = p.withColumn("__k", F.lit(1)).join(i.withColumn("__k", F.lit(1)), "__k")
    if written is not None:
        sk = instances.join(written.select(id_col).distinct(), id_col, "left_semi").agg(F.count("*").alias("skipped"))
        out = out.join(sk.withColumn("__k", F.lit(1)), "__k")
    return out.drop("__k")


def keep_valid_ids(df: DataFrame, valid: DataFrame, id_col: str = "instance_id") -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows) by a semi / anti join pair."""
    v = valid.select(id_col).distinct()
    return df.join(v, id_col, "left_semi"), df.join(v, id_col, "left_anti")


def lookup_spec(df: DataFrame, specs: DataFrame, keys=("repo", "version")) -> tuple[DataFrame, DataFrame]:
    """Dimension lookup of the environment spec; unknown keys go to a reject output
    instead of failing the job. ``specs`` is one row per (repo, version)."""
    k = list(keys)
    j = df.join(specs.withColumn("__known", F.lit(True)), k, "left")
    return j.where(F.col("__known").isNotNull()).drop("__known"), j.where(F.col("__known").isNull()).select(*df.columns)


def unresolved_pairs(before: DataFrame, after: DataFrame, cols=("instance_id", "version")) -> DataFrame:
    """Distinct (id, version) pairs of ``before`` that are not in ``after``."""
    c = list(cols)
    return before.select(*c).distinct().subtract(after.select(*c).distinct())


def order_by_id(df: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """String order of the id (a range-partitioned sort)."""
    return df.orderBy(F.col(id_col).cast("string"))


def package_rank(packages: DataFrame, links: DataFrame, repo_stats: DataFrame | None = None,
                 written: DataFrame | None = None) -> DataFrame:
    """Per package the first link (by position) whose label mentions source, code or
    homepage and whose URL has 'github'; then stars and pulls of that repository by a left
    join; packages already written are skipped (L1).

    ``packages``: (rank, name, url); ``links``: (name, pos, label, href);
    ``repo_stats``: (github, stars, pulls)."""
    lab = F.lower(F.col("label"))
    ok = (lab.contains("source") | lab.contains("code") | lab.contains("homepage")) & F.col("href").contains("github")
    first = links.where(ok).groupBy("name").agg(F.min_by("href", "pos").alias("github"))
    out = packages.join(first, "name", "left")
    if repo_stats is not None:
        out = out.join(repo_stats, "github", "left")
    if written is not None:
        out = out.join(written.select("name").distinct(), "name", "left_anti")
    return out
