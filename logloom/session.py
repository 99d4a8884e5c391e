"""Session set-up and the shared folder for materialised intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own, chosen once per application.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="logloom-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh table location below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/logloom-{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application has made; say how many there were.

    Results that are still lazy read from them: call this when what was asked for is stored.
    """
    removed = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed


def drop_scratch(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The queries that run inside delete their shuffle files at their end, whenever the driver's heap is collected.

    For queries whose results are stored or collected: a lazy result would read its files again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(spark: SparkSession) -> None:
    """Let the driver give back what finished jobs have left in it: compiled plans, buffers, states of shuffles.

    Their memory lies outside of the heap, which a driver with little to do rarely collects.
    """
    gc.collect()  # Python tells the driver what it has let go
    spark._jvm.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
