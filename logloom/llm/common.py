"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import scratch_path

# The six characters that separate words, as a class and as a list.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; later jobs start from the files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that a Python worker no longer uses; workers stay while Spark may need them again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(work: Callable) -> Callable:
    """``work`` over record batches, with the memory that it took returned at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def text_of(name: str) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("bigint")


def prefix_sum(df: DataFrame, index: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Add the sum of ``value`` over all rows with a smaller dense ``index``.

    Sums run inside blocks of ``block`` indexes and then over the blocks, so no task holds
    more than a block of rows or the list of block sums.
    """
    before = Window.unboundedPreceding, -1
    cut = df.withColumn("_block", F.floor(F.col(index) / block).cast("bigint"))
    tops = cut.groupBy("_block").agg(F.sum(value).alias("_sum"))
    tops = tops.withColumn("_group", F.floor(F.col("_block") / block))
    level = Window.partitionBy("_group").orderBy("_block").rowsBetween(*before)
    groups = tops.groupBy("_group").agg(F.sum("_sum").alias("_all"))
    groups = groups.withColumn(
        "_base", F.coalesce(F.sum("_all").over(Window.orderBy("_group").rowsBetween(*before)), F.lit(0))
    ).drop("_all")
    tops = tops.join(groups, "_group").select(
        "_block", (F.col("_base") + F.coalesce(F.sum("_sum").over(level), F.lit(0))).alias("_base")
    )
    inner = Window.partitionBy("_block").orderBy(index).rowsBetween(*before)
    return (
        cut.join(tops, "_block")
        .withColumn(out, (F.col("_base") + F.coalesce(F.sum(value).over(inner), F.lit(0))).cast("bigint"))
        .drop("_block", "_base")
    )
