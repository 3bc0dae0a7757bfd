"""Hot groups: one group holding every row gives the same answers as a brute-force window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from diffloom.operators.sampling import running_sum_before, split_even, stop_at_budget


def test_running_sum_hot_group_spans_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = spark.range(2000).select(F.lit("hot").alias("g"), F.col("id").alias("i"), (F.col("id") % 7).alias("c"))
        got = running_sum_before(df, ["g"], ["i"], "c")
        # the range-partitioned sort spreads the single group over several partitions
        spread = df.orderBy("g", "i").select(F.spark_partition_id().alias("p")).distinct().count()
        assert spread > 1
        brute = df.withColumn("sb", F.coalesce(F.sum("c").over(
            Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        a = {r.i: (r.sum_before, r.rows_before) for r in got.collect()}
        b = {r.i: (r.sb, r.i) for r in brute.collect()}
        assert a == b
        kept = stop_at_budget(df, "c", 100, ["g"], ["i"]).count()
        assert kept == brute.where("sb < 100").count()
        parts = split_even(df, ["i"], 3).groupBy("part").count().collect()
        assert sorted(r[1] for r in parts) == [666, 667, 667]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_null_groups_and_text_orders(spark):
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 2), ("g", "é", 3), ("g", "z", 4), ("g", None, 5)], "g string, o string, c int")
    got = {(r.g, r.o): (r.sum_before, r.rows_before) for r in running_sum_before(df, ["g"], ["o"], "c").collect()}
    assert got == {(None, "a"): (0, 0), (None, "b"): (2, 1), ("g", None): (0, 0), ("g", "z"): (5, 1), ("g", "é"): (9, 2)}
    assert [r.o for r in split_even(df, ["o", "c"], 5).orderBy("part").collect()] == [None, "a", "b", "z", "é"]


def test_scratch_tables_go_with_their_scope(spark, tmpdir_path):
    from diffloom.session import materialize, path_exists, scratch_scope
    with scratch_scope(spark):
        df = materialize(spark.range(5), "scope-test")
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        df.write.parquet(f"{tmpdir_path}/out")
        assert path_exists(spark, path)
    assert not path_exists(spark, path) and spark.read.parquet(f"{tmpdir_path}/out").count() == 5


def rows_by_slice(df, order, slices):
    from diffloom.operators.sampling import ordered_slices
    return {r[0]: r[1] for r in ordered_slices(df, [F.col(c) for c in order], slices).groupBy("__slice").count().collect()}


def test_one_prefix_and_one_value_spread_over_all_slices(spark):
    ids = spark.range(100_000).select(F.concat(F.lit("owner__name-with-a-long-prefix-"), F.col("id").cast("string")).alias("i"))
    dates = spark.range(100_000).select(F.lit("2024-01-01").cast("date").alias("d"), F.col("id").alias("i"))
    for df, order in ((ids, ["i"]), (dates, ["d"])):
        counts = rows_by_slice(df, order, 16)
        assert len(counts) == 16 and max(counts.values()) < 3 * 100_000 / 16, counts


def test_global_rank_of_one_value_and_of_text(spark):
    from diffloom.operators.sampling import from_id_limit, global_rank
    df = spark.range(3000).select(F.lit("same").alias("d"), F.concat(F.lit("prefix-"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("i"))
    assert [r[0] for r in global_rank(df, ["d"], slices=7).select("rank").orderBy("rank").collect()] == list(range(3000))
    by_text = global_rank(df, ["i"], slices=7).orderBy("rank").collect()
    assert [r.i for r in by_text] == sorted(r.i for r in by_text) and {r["__total"] for r in by_text} == {3000}
    got = from_id_limit(df, ["i"], "i", "prefix-01000", 3)
    assert sorted(r.i for r in got.collect()) == ["prefix-01000", "prefix-01001", "prefix-01002"]
    assert global_rank(df.limit(0), ["i"]).count() == 0
