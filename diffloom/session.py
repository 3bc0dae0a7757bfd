"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "diffloom", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster the master, memory and partition count come from spark-submit; the defaults
    here only matter for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # only effective when this call starts the JVM (local mode: the driver is the executor)
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Where nothing is configured, a session on one machine
    (``local[...]``, as in tests) gets a scratch folder; on a cluster, whose machines would
    not share it, this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="diffloom-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the store that Spark reads it from. Errors of the store are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` but computes the plan a single time (an eager
    Dataset checkpoint runs the plan once to count and again to write). The folder is the
    cluster's shared ``spark.checkpoint.dir``, so the table survives executor loss.
    """
    import uuid

    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    for tables in _SCOPES:
        tables.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes, at its end, the tables that ``materialize`` wrote inside it. For code that has written its
    result by then: frames that were made inside and not written cannot be read afterwards."""
    tables: list[str] = []
    _SCOPES.append(tables)
    try:
        yield
    finally:
        _SCOPES.remove(tables)
        for path in tables:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``diffloom`` importable in Python workers (what ``--py-files`` does on submit):
    zip the package once per context and ``addPyFile`` it. Needed only by the operators that
    run Python in tasks (pandas UDFs, ``mapInPandas``), whose functions refer to this package."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="diffloom-pyfiles-"), "diffloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
