"""Lists of row filters (M5, B14, E12): one pass that keeps, or counts, the rows that pass each in turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Filters = Sequence[tuple[str, Column]]


def apply_filters(df: DataFrame, filters: Filters) -> DataFrame:
    """The rows that pass every filter; a NULL verdict does not pass."""
    for _, passes in filters:
        df = df.where(passes)
    return df


def filter_funnel(df: DataFrame, filters: Filters, by: Sequence[str] = (), also: Filters = ()) -> DataFrame:
    """``n_total`` and, for each filter in order, the rows left after it and all before it (as ``n_<name>``), for
    each group of ``by``, in one aggregate. ``also``: conditions that are counted on their own. Each
    condition is evaluated once for a row."""
    named = [(f"__f{k}", c) for k, (_, c) in enumerate([*filters, *also])]
    rows = df.select(*by, *[F.coalesce(c, F.lit(False)).alias(n) for n, c in named])
    counts, left = [F.count("*").alias("n_total")], F.lit(True)
    for (name, _), (column, _) in zip(filters, named):
        left = left & F.col(column)
        counts.append(F.count_if(left).alias(f"n_{name}"))
    for (name, _), (column, _) in zip(also, named[len(filters):]):
        counts.append(F.count_if(column).alias(f"n_{name}"))
    return rows.groupBy(*by).agg(*counts) if by else rows.agg(*counts)
