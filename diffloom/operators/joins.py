"""Join helpers: broadcast only behind a checked size bound, or never."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sides derived from an input of at most so many bytes are broadcast.
MAX_SOURCE_BYTES = 16 << 20
#: Tasks of a shuffle at most, by an estimate.
MAX_TASKS = 100_000


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file sizes for tables): known without running anything."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_derived(df: DataFrame, source: DataFrame, limit: int = MAX_SOURCE_BYTES) -> DataFrame:
    """``broadcast(df)`` when the ``source`` that bounds it (a query batch, whose terms ``df`` holds) is
    at most ``limit`` bytes by the optimizer's estimate, else ``df`` unchanged: the join then shuffles
    both sides unless AQE finds one small. Starts no job."""
    return F.broadcast(df) if planned_bytes(source) <= limit else df


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join. For sides that grow with the input while their estimate does not (rows made by
    ``explode``, Parquet files of repeated strings): Spark would broadcast them, through the driver's memory."""
    return df.hint("merge")


def dealt(df: DataFrame, source: DataFrame, task_bytes: int, *columns: str) -> DataFrame:
    """``df`` by hash of ``columns`` in as many tasks as ``source`` has ``task_bytes`` by the optimizer's estimate, so that a
    task's work does not grow with the input. AQE keeps a stated count; other shuffles it merges by their bytes. A source
    without an estimate (rows of an RDD count as exabytes) leaves the count to the session."""
    n = -(-planned_bytes(source) // task_bytes)
    return df.repartition(max(1, n), *columns) if n <= MAX_TASKS else df.repartition(*columns)
