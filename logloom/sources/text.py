"""Raw text logs: one message per line, ordered within each file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.plans.joins import attach


def _number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the line's place within its file split; splits arrive one after the other."""
    current, seen = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        paths = batch.column("path")
        starts = batch.column("block_start").to_numpy()
        codes = paths.dictionary_encode().indices.to_numpy()
        changed = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
        bounds = [0, *changed.tolist(), batch.num_rows]
        place = np.empty(batch.num_rows, dtype=np.int64)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            split = (paths[lo].as_py(), int(starts[lo]))
            if split != current:
                current, seen = split, 0
            place[lo:hi] = np.arange(seen, seen + hi - lo)
            seen += hi - lo
        yield pa.RecordBatch.from_arrays(
            [paths, batch.column("block_start"), pa.array(place), batch.column("message")],
            names=["path", "block_start", "place", "message"],
        )


def read_text_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(stream_id, stream_name, seq, message)`` from plain or compressed text files.

    Each file is one stream; ``seq`` is the line's place in the file, from 0 without gaps, however
    the file was split for reading. A first pass counts the lines of each split; their running sum per
    file, one row per split, gives the place of the split's first line. No line is shuffled unless there
    are more splits than may be broadcast.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("message"),
    )
    before = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "block_start").agg(F.count(F.lit(1)).alias("n_lines"))
    splits = splits.withColumn("offset", F.coalesce(F.sum("n_lines").over(before), F.lit(0))).drop("n_lines")
    numbered = lines.mapInArrow(_number_lines, "path string, block_start bigint, place bigint, message string")
    return attach(numbered, splits, ["path", "block_start"]).select(
        F.xxhash64("path").alias("stream_id"),
        F.col("path").alias("stream_name"),
        (F.col("offset") + F.col("place")).cast("bigint").alias("seq"),
        "message",
    )
