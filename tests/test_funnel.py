from pyspark.sql import functions as F

from diffloom.operators.funnel import apply_filters, filter_funnel


def test_funnel_counts_what_is_left(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", None), ("b", 9)], "g string, n int")
    filters = [("positive", F.col("n") > 0), ("small", F.col("n") < 8)]
    assert [tuple(r) for r in apply_filters(df, filters).orderBy("n").collect()] == [("a", 1), ("a", 5)]
    got = {r.g: tuple(r)[1:] for r in filter_funnel(df, filters, ["g"], also=[("five", F.col("n") == 5)]).collect()}
    assert got == {"a": (3, 2, 2, 1), "b": (1, 1, 0, 0)}
    assert tuple(filter_funnel(df, filters).first()) == (4, 3, 2)
