"""Frequent keys of a column by Misra-Gries summaries.

Each partition keeps at most ``counters`` keys with counts that are too low by at most
``rows / (counters + 1)``; summaries add up under the same bound. A key in more than
``2 / (counters + 1)`` of all rows is therefore always among the candidates, and there are at
most ``counters + 1`` candidates, whatever the size of the table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import stored


def shrink(counts: dict, counters: int) -> dict:
    """Subtract the ``counters + 1``-th largest count from all and keep what is above zero."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {key: n - cut for key, n in counts.items() if n > cut}


def frequent_candidates(rows: DataFrame, key: str, counters: int) -> DataFrame:
    """``(key, at_least)``: every key that may be frequent, at most ``counters + 1`` rows.

    Null keys are counted but never candidates. An empty table gives no candidates.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        seen = 0
        for batch in batches:
            seen += batch.num_rows
            found = Counter(counts)
            for item in batch.column(0).drop_null().value_counts().to_pylist():
                found[item["values"]] += item["counts"]
            counts = shrink(found, counters)
        keys = [None, *counts]
        sizes = [seen, *counts.values()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], ["key", "n"])

    summaries = stored(rows.select(F.col(key).cast("binary").alias("key")).mapInArrow(summarise, "key binary, n long"), "summaries")
    total = summaries.filter("key is null").agg(F.sum("n")).first()[0] or 0
    merged = summaries.filter("key is not null").groupBy("key").agg(F.sum("n").alias("at_least"))
    enough = F.col("at_least") * (counters + 1) >= F.lit(total)
    return merged.filter(enough & (F.col("at_least") > 1)).withColumnRenamed("key", key)
