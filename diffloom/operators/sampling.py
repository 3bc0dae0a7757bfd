"""Ordering, splitting and sampling.

Random choices use a hash of the id and a seed instead of a generator, so reruns and retried
tasks pick the same rows. Per-group top-k uses ``row_number() <= n``; Spark plans it as a
WindowGroupLimit on both sides of the shuffle, so a hot group ships at most n rows per task.
Global ranks (F1) are computed without a single-partition window: a sort by ranges of the whole order,
written once, the counts of the ranges (one small row each) and a running offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom.session import materialize


def hash_order(id_col, seed: int) -> Column:
    """A stable pseudo-random order key (md5 of ``id|seed``: equal in Spark and SQL engines)."""
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def sample_per_group(df: DataFrame, group_cols: Sequence[str], id_col: str, n: int = 500,
                     seed: int = 42, drop_cols: Sequence[str] = ("test_patch",)) -> DataFrame:
    """n rows per group in seeded hash order (ties by id); listed columns dropped."""
    w = Window.partitionBy(*group_cols).orderBy(hash_order(id_col, seed), F.col(id_col))
    out = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return out.drop(*[c for c in drop_cols if c in out.columns])


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """First n rows in seeded hash order (fewer rows than n: all of them). Planned as
    TakeOrderedAndProject: each task keeps its own n best, the driver merges n per task."""
    return df.orderBy(hash_order(id_col, seed), F.col(id_col)).limit(n)


def train_valid_split(df: DataFrame, id_col: str, ratio: float = 0.01, seed: int = 42) -> DataFrame:
    """Adds ``split`` = validation for a share of about ``ratio`` by the seeded hash of the id."""
    place = F.conv(F.substring(hash_order(id_col, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("split", F.when(place < int(ratio * 2**32), F.lit("validation")).otherwise(F.lit("train")))


#: Rows of a slice of an order, about: each slice is sorted on its own.
SLICE_ROWS = 4_000_000


def ordered_slices(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """``df`` with its place in an order: ``__slice`` and ``__at``, from 0, inside it.

    Slices are ranges of the whole order tuple, from Spark's sample of it, so neither a common prefix nor a
    common first column puts rows together; rows equal in the order are spread, and ordered, by the hash of
    the whole row (only equal rows share a slice whatever its size). There are as many slices as
    shuffle partitions, or one for each ``SLICE_ROWS`` rows if that is more. The sorted rows are written once
    to the shared checkpoint folder: places are read back, so a retried task finds the same ones."""
    spark = df.sparkSession
    n = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE_ROWS))
    keys = [*order, F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    written = materialize(ranged.withColumn("__mid", F.monotonically_increasing_id()), "order")
    # the number of the partition above 33 bits, the row's place in it below
    return written.withColumn("__slice", F.shiftright("__mid", 33)).withColumn("__at", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("__mid")


def global_rank(df: DataFrame, order_cols: Sequence[str], slices: int | None = None) -> DataFrame:
    """0-based ``rank`` in ``order_cols`` order (ties broken by the caller's columns, then by the hash of the row)
    without moving all rows to one task, plus ``__total`` (the row count): the place inside a slice, and the
    slices' counts as offsets. Rows are shuffled once; the offsets are one row for each slice."""
    placed = ordered_slices(df, [F.col(c) if isinstance(c, str) else c for c in order_cols], slices)
    w = Window.orderBy("__s")  # one row for each slice
    offsets = placed.groupBy(F.col("__slice").alias("__s")).agg(F.count("*").alias("__n"))
    offsets = (offsets.withColumn("__off", F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                      .withColumn("__total", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).drop("__n"))
    found = placed.join(F.broadcast(offsets), F.col("__slice") == F.col("__s"))
    return found.withColumn("rank", F.col("__off") + F.col("__at")).drop("__slice", "__s", "__at", "__off")


def split_even(df: DataFrame, order_cols: Sequence[str], n: int, part_col: str = "part") -> DataFrame:
    """n contiguous parts of the ordered rows; the first ``N % n`` parts get one more row
    (the sizes of ``ntile``). Parts are numbered from 0."""
    r = global_rank(df, order_cols)
    q = F.floor(F.col("__total") / n)
    rem = F.col("__total") - q * n
    big = (q + 1) * rem
    part = F.when(F.col("rank") < big, F.floor(F.col("rank") / (q + 1))) \
            .otherwise(rem + F.floor((F.col("rank") - big) / F.greatest(q, F.lit(1))))
    return r.withColumn(part_col, part.cast("int")).drop("__total")


def contiguous_shard(df: DataFrame, order_cols: Sequence[str], shard: int, n: int) -> DataFrame:
    """shard ``shard`` of ``n`` (shard first, then drop finished rows: stable shards)."""
    return split_even(df, order_cols, n, "__part").where(F.col("__part") == shard).drop("__part", "rank")


def order_by_length(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """G1: ascending by characters, ties by id."""
    return df.orderBy(F.length(text_col), F.col(id_col))


def running_sum_before(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, value_col: str,
                       out_col: str = "sum_before") -> DataFrame:
    """Sum of ``value_col`` over the earlier rows of the same group (in ``order_cols`` order),
    plus ``rows_before`` (their count), without putting a whole group into one task.

    Rows are sliced by ranges of the group and the order, so a hot group spans many slices. The
    totals of each (group, slice), a small table, give each slice its offset; the running sum is a
    window over one slice of one group. ``order_cols`` must order rows totally (add an id to break
    ties). NULL group values are a group of their own.
    """
    gc = list(group_cols)
    s = ordered_slices(df, [*map(F.col, gc), *[F.col(c) if isinstance(c, str) else c for c in order_cols]])
    totals = s.groupBy(*gc, "__slice").agg(F.sum(value_col).alias("__sum"), F.count("*").alias("__n"))
    w_off = Window.partitionBy(*gc).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__g_{c}") for c in gc], F.col("__slice").alias("__s"),
                            F.coalesce(F.sum("__sum").over(w_off), F.lit(0)).alias("__off"),
                            F.coalesce(F.sum("__n").over(w_off), F.lit(0)).alias("__noff"))
    w_in = Window.partitionBy(*gc, "__slice").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    out = (s.withColumn("__in", F.coalesce(F.sum(value_col).over(w_in), F.lit(0)))
            .withColumn("__nin", F.coalesce(F.count(F.lit(1)).over(w_in), F.lit(0))))
    same = F.col("__slice") == F.col("__s")
    for c in gc:
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    out = out.join(offsets, same)
    return (out.withColumn(out_col, F.col("__off") + F.col("__in"))
               .withColumn("rows_before", F.col("__noff") + F.col("__nin"))
               .drop("__slice", "__at", "__s", "__off", "__in", "__noff", "__nin", *[f"__g_{c}" for c in gc]))


def stop_at_budget(df: DataFrame, cost_col: str, max_cost: float | None, group_cols: Sequence[str],
                   order_cols: Sequence) -> DataFrame:
    """rows in order until the running total reaches the budget; the row that crosses it
    is kept, and the first row always runs (also at budget 0). ``None`` = no limit.

    The running total comes from ``running_sum_before`` (no single-task window per group)."""
    if max_cost is None:
        return df
    r = running_sum_before(df, group_cols, order_cols, cost_col, "cost_before")
    return r.where((F.col("cost_before") < F.lit(max_cost)) | (F.col("rows_before") == 0)).drop("rows_before")


def latest_per_group(df: DataFrame, group_cols: Sequence[str], time_col: str, id_col: str) -> DataFrame:
    """F8: the newest row per group (ties: larger id); a plain aggregate with partial
    aggregation, so a hot group costs one row per task in the shuffle."""
    cols = [c for c in df.columns if c not in group_cols]
    best = df.groupBy(*group_cols).agg(F.max_by(F.struct(*cols), F.struct(time_col, id_col)).alias("__b"))
    return best.select(*group_cols, "__b.*")


def exclude_groups(df: DataFrame, eval_df: DataFrame, group_col: str) -> DataFrame:
    """Drop rows whose group occurs in the evaluation set (anti join on the distinct
    groups; AQE broadcasts them when they are small)."""
    return df.join(eval_df.select(group_col).distinct(), group_col, "left_anti")


def exclude_exact_rows(df: DataFrame, eval_df: DataFrame, text_col: str, eval_text_col: str | None = None) -> DataFrame:
    """Drop rows whose raw text equals an evaluation row (anti join on SHA-256)."""
    et = eval_text_col or text_col
    keys = eval_df.select(F.sha2(F.col(et), 256).alias("__h")).distinct()
    return df.withColumn("__h", F.sha2(F.col(text_col), 256)).join(keys, "__h", "left_anti").drop("__h")


def from_id_limit(df: DataFrame, order_cols: Sequence[str], id_col: str, start_id=None, limit: int | None = None) -> DataFrame:
    """Rows in order starting at ``start_id`` (inclusive), at most ``limit`` of them,
    counted from the start row (the original compares the limit with the absolute index when
    no id is given; ours always counts from the start)."""
    r = global_rank(df, order_cols)
    if start_id is not None:
        # one scalar (the start row's rank) is looked up; the rest is a filter
        hit = r.where(F.col(id_col) == F.lit(start_id)).select("rank").limit(1).collect()
        if not hit:
            return r.limit(0).drop("__total")
        start = hit[0][0]
        r = r.where(F.col("rank") >= start).withColumn("rank", F.col("rank") - F.lit(start))
    if limit is not None:
        r = r.where(F.col("rank") < limit)
    return r.drop("__total")


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """H4: union of id sources, each id once."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def group_by_version(df: DataFrame, version_col: str = "version", n_partitions: int | None = None) -> DataFrame:
    """Keep rows, co-located by version (``repartition``) instead of one list per version."""
    return df.repartition(n_partitions, version_col) if n_partitions else df.repartition(version_col)
