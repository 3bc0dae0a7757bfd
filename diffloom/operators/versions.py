"""Versioning.

As-of join without a per-repository window over the big side. The release table is a small
dimension; it is turned into a dense ``(key, bucket)`` timeline (bucket = calendar month):
for every bucket the releases inside it (a short sorted array) and the latest release before
the bucket starts (carried forward with a window over the *release* timeline only). The
instances then equi-join on ``(key, bucket)`` and pick with higher-order functions. The big
side is shuffled by ``(key, bucket)``, which spreads a hot repository over its months; AQE
broadcasts the timeline when it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(ts: Column) -> Column:
    return F.date_trunc("month", ts.cast("timestamp_ntz"))


def release_timeline(releases: DataFrame, keys: Sequence[str], time_col: str, value_cols: Sequence[str],
                     until: DataFrame | None = None) -> DataFrame:
    """Dense month timeline per key: ``(keys, bucket, inside: array<struct<t, v...>>, carry)``.

    ``until`` (keys + ``__min_bucket``, ``__max_bucket``) extends each key's timeline to the first and the
    last bucket that the probe side needs; otherwise it spans the releases. ``oldest``: the key's
    first release, on every row.
    """
    keys = list(keys)
    vals = list(value_cols)
    # one row per (key, exact time): ties keep the greatest value, and each month's array is
    # bounded by the distinct release times of the key in that month, not by row copies
    r = (releases.groupBy(*keys, F.col(time_col).alias("__t"))
         .agg(F.max(F.struct(*vals)).alias("__v")).select(*keys, "__t", *[F.col(f"__v.{v}").alias(v) for v in vals])
         .withColumn("__b", _bucket(F.col("__t"))))
    rng = r.groupBy(*keys).agg(F.min("__b").alias("__lo"), F.max("__b").alias("__hi"))
    if until is not None:
        rng = rng.join(until, keys, "left").select(
            *keys, F.least("__lo", F.coalesce("__min_bucket", "__lo")).alias("__lo"),
            F.greatest("__hi", F.coalesce("__max_bucket", "__hi")).alias("__hi"))
    grid = rng.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr("interval 1 month"))).alias("__b"))
    inside = r.groupBy(*keys, "__b").agg(F.array_sort(F.collect_list(F.struct("__t", *vals))).alias("inside"))
    g = grid.join(inside, keys + ["__b"], "left")
    w = Window.partitionBy(*keys).orderBy("__b")
    last_in = F.try_element_at(F.col("inside"), F.lit(-1))
    g = g.withColumn("__last", last_in)
    g = g.withColumn("carry", F.last("__last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    first = F.first(F.try_element_at(F.col("inside"), F.lit(1)), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return g.withColumn("oldest", first).drop("__last")


def asof_join(left: DataFrame, releases: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              value_cols: Sequence[str], strict: bool = True, fallback: str = "none") -> DataFrame:
    """For each left row, the values of the newest release of the same key with
    ``time < left_time`` (``<=`` when not strict). ``fallback``: ``none`` (NULL) or
    ``oldest`` (the first release) when nothing is earlier."""
    vals = list(value_cols)
    j = _asof(left, releases, keys, left_time, right_time, vals, strict)
    pick = F.coalesce("__pick", "oldest") if fallback == "oldest" else F.col("__pick")
    out = j.withColumn("__pick", pick)
    return out.select(*left.columns, *[F.col("__pick")[v].alias(v) for v in vals],
                      F.col("__pick")["__t"].alias(f"{right_time}_matched"))


def _asof(left: DataFrame, releases: DataFrame, keys: Sequence[str], left_time: str, right_time: str, vals: list[str],
          strict: bool) -> DataFrame:
    """``left`` with ``__pick`` (the newest earlier release, or NULL) and ``oldest``: one join with the timeline."""
    keys = list(keys)
    lb = left.withColumn("__b", _bucket(F.col(left_time)))
    until = lb.groupBy(*keys).agg(F.min("__b").alias("__min_bucket"), F.max("__b").alias("__max_bucket"))
    tl = release_timeline(releases, keys, right_time, vals, until)
    j = lb.join(tl, keys + ["__b"], "left")
    lt = F.col(left_time).cast("timestamp_ntz")
    cmp = (lambda x: x["__t"].cast("timestamp_ntz") < lt) if strict else (lambda x: x["__t"].cast("timestamp_ntz") <= lt)
    hit = F.try_element_at(F.filter(F.coalesce(F.col("inside"), F.array().cast(tl.schema["inside"].dataType)), cmp), F.lit(-1))
    return j.withColumn("__pick", F.coalesce(hit, F.col("carry")))


def version_cutoffs(releases: DataFrame, keys: Sequence[str], version_col: str, time_col: str) -> DataFrame:
    """The latest date per version."""
    return releases.groupBy(*keys, version_col).agg(F.max(time_col).alias("cutoff"))


def asof_version_by_order(left: DataFrame, releases: DataFrame, keys: Sequence[str], left_time: str,
                          version_col: str, time_col: str, numeric: bool = False) -> DataFrame:
    """Versions ordered (as strings, or numerically with ``numeric=True``) descending;
    the first whose cutoff is before ``left_time``; else the lowest version.

    That is the running maximum of the version over cutoffs in time order, looked up as of
    ``left_time`` (strict), with the minimum version as fallback.
    """
    keys = list(keys)
    order_key = (F.transform(F.split(F.col(version_col), r"\."), lambda x: x.cast("int"))
                 if numeric else F.col(version_col))
    cut = version_cutoffs(releases, keys, version_col, time_col).withColumn("__ord", order_key)
    # running max over a (small) per-key release list: bounded by the number of versions
    w = Window.partitionBy(*keys).orderBy("cutoff", "__ord").rowsBetween(Window.unboundedPreceding, 0)
    run = (cut.withColumn("__best", F.max(F.struct("__ord", version_col)).over(w))
              .withColumn("__seq", F.row_number().over(Window.partitionBy(*keys).orderBy("cutoff", "__ord"))))
    # __seq first: among versions with the same cutoff the as-of pick keeps the latest running
    # maximum (the one that has seen all of them), whatever the order of the version text
    lowest = F.min(F.struct("__ord", version_col)).over(Window.partitionBy(*keys))
    run = run.select(*keys, "cutoff", "__seq", F.col(f"__best.{version_col}").alias("__v"), lowest[version_col].alias("__lowest"))
    j = _asof(left, run, keys, left_time, "cutoff", ["__seq", "__v", "__lowest"], True)
    found = F.coalesce(F.col("__pick")["__v"], F.col("oldest")["__lowest"])
    return j.select(*left.columns, found.alias(version_col))


def major_minor(version) -> Column:
    """Keep ``major.minor`` (split on '.' or ','), then only digits and dots."""
    v = F.col(version) if isinstance(version, str) else version
    parts = F.split(v, r"[.,]")
    mm = F.when(F.size(parts) >= 2, F.concat_ws(".", F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2)))).otherwise(v)
    return F.regexp_replace(mm, r"[^0-9.]", "")


# fixed value: repositories whose version is the whole match (text after '=', ',' -> '.')
WHOLE_MATCH_REPOS = ["pyvista/pyvista"]


def version_from_files(instances: DataFrame, files: DataFrame, paths: DataFrame, patterns: DataFrame,
                       id_col: str = "instance_id") -> DataFrame:
    """C17: for each instance, candidate files (by path rank) and patterns (by rank); text
    inside triple double quotes is ignored; the first hit by (path_rank, pattern_rank) wins.
    The version is capture group 1 without blanks (whole-match repositories: the text after
    '=' with ',' as '.'), cut to major.minor with digits and dots only.

    ``files``: (corpus_id, path, content); ``paths``: (repo, path, rank);
    ``patterns``: (repo, pattern, rank). Files are joined with the patterns of their repository, so they are
    read once.
    """
    cand = (instances.select(id_col, "repo", "corpus_id")
            .join(paths.withColumnRenamed("rank", "path_rank"), "repo")
            .join(files.select("corpus_id", "path", "content"), ["corpus_id", "path"]))
    cand = cand.withColumn("content", F.regexp_replace("content", r'(?s)""".*?"""', ""))
    tried = cand.join(patterns.select("repo", "pattern", F.col("rank").alias("pattern_rank")), "repo").where(F.expr("rlike(content, pattern)"))
    whole = F.replace(F.trim(F.substring_index(F.expr("regexp_extract(content, pattern, 0)"), "=", -1)), F.lit(","), F.lit("."))
    group = F.replace(F.expr("regexp_extract(content, pattern, 1)"), F.lit(" "), F.lit(""))
    hits = tried.select(id_col, "path_rank", "pattern_rank", F.when(F.col("repo").isin(WHOLE_MATCH_REPOS), whole).otherwise(group).alias("raw"))
    best = hits.groupBy(id_col).agg(F.min_by("raw", F.struct("path_rank", "pattern_rank")).alias("raw"))
    return instances.join(best.select(id_col, major_minor(F.col("raw")).alias("version")), id_col, "left")


def release_table(pages: DataFrame, pattern: str, date_formats: Sequence[str], key_col: str = "repo",
                  html_col: str = "html") -> DataFrame:
    """C20: HTML pages -> distinct (key, version, date); rows without a parsable date are
    skipped. ``pattern`` has two groups: version and date text."""
    pairs = pages.select(key_col, F.explode(F.arrays_zip(
        F.regexp_extract_all(html_col, F.lit(pattern), 1).alias("v"),
        F.regexp_extract_all(html_col, F.lit(pattern), 2).alias("d"))).alias("p"))
    date = F.coalesce(*[F.try_to_date(F.col("p.d"), f) for f in date_formats])
    return (pairs.select(key_col, major_minor(F.col("p.v")).alias("version"), date.alias("date"))
            .where(F.col("date").isNotNull()).distinct())
