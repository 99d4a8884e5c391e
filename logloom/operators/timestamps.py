"""Delta-coded timestamps per stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.int64 import wrapping_add, wrapping_subtract
from logloom.plans.joins import attach
from logloom.plans.ordered import BLOCK_BITS, previous_value, running_sum


def reference_timestamps(events: DataFrame) -> DataFrame:
    """Per stream, the time of its first event: the default start of the deltas."""
    return events.groupBy("stream_id").agg(F.min_by("ts_ms", "seq").alias("reference_ts"))


def _with_reference(rows: DataFrame, references: DataFrame | int) -> DataFrame:
    if isinstance(references, int):
        return rows.withColumn("reference_ts", F.lit(references).cast("bigint"))
    side = references.select("stream_id", "reference_ts")
    return attach(rows, side, ["stream_id"], "left")


def delta_encode(
    events: DataFrame, references: DataFrame | int | None = None, bits: int = BLOCK_BITS
) -> DataFrame:
    """Replace ``ts_ms`` by ``ts_delta``: the step from the previous event of the stream.

    The first event counts from the stream's reference timestamp. ``references`` is a
    table ``(stream_id, reference_ts)``, one number for all, or None for each stream's
    own first time, which makes its first delta zero and needs no join. Steps wrap at 64 bits, and so
    do the sums of :func:`delta_restore`, so all times come back.
    """
    with_prev = previous_value(events, "ts_ms", "_prev", bits=bits)
    if references is None:
        start = F.col("ts_ms")
    else:
        with_prev = _with_reference(with_prev, references)
        start = F.coalesce("reference_ts", F.lit(0).cast("bigint"))
    delta = wrapping_subtract(F.col("ts_ms"), F.coalesce(F.col("_prev"), start))
    return with_prev.withColumn("ts_delta", delta).drop("_prev", "ts_ms", "reference_ts")


def delta_restore(
    deltas: DataFrame, references: DataFrame | int, bits: int = BLOCK_BITS
) -> DataFrame:
    """Replace ``ts_delta`` by ``ts_ms``: reference timestamp plus the deltas so far."""
    summed = _with_reference(running_sum(deltas, "ts_delta", "_sum", bits=bits), references)
    restored = wrapping_add(F.coalesce("reference_ts", F.lit(0).cast("bigint")), F.col("_sum"))
    return summed.withColumn("ts_ms", restored).drop("ts_delta", "_sum", "reference_ts")
