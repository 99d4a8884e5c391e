"""Reports on streams and on the codec; bad rows are reported, never raised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions.glob import first_match_index
from logloom.operators.encoding import decode_log, encode_log
from logloom.operators.search import Queries, in_interval


def roundtrip_audit(events: DataFrame, width: int = 8) -> DataFrame:
    """Per stream: rows, rows lost in encode and decode, rows that failed to decode."""
    decoded = decode_log(encode_log(events.withColumn("_original", F.col("message")), width).drop("status"))
    return decoded.groupBy("stream_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(~F.col("message").eqNullSafe(F.col("_original"))).alias("n_lossy"),
        F.count_if(F.col("status") == S.DECODE_ERROR).alias("n_failed"),
    )


def stream_status(events: DataFrame, streams: DataFrame) -> DataFrame:
    """One row per stream of ``streams (stream_id, closed)`` or of the events.

    A stream that was never closed, or has no header, is incomplete, also if it holds nothing; a
    closed one is corrupted when positions are missing between its first and last or repeated, and
    has an encode error when messages are null.
    """
    places = events.groupBy("stream_id", "seq").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("message").isNull()).alias("n_null")
    )
    counts = places.groupBy("stream_id").agg(
        F.sum("n").alias("n_events"),
        F.count(F.lit(1)).alias("n_places"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.sum("n_null").alias("n_null"),
    )
    joined = streams.select("stream_id", "closed").join(counts, "stream_id", "full_outer")
    n = F.coalesce("n_events", F.lit(0))
    gap = (F.col("last_seq") - F.col("first_seq") + 1) != F.col("n_places")
    status = (
        F.when(~F.coalesce("closed", F.lit(False)), S.INCOMPLETE_IR)
        .when((n > 0) & (gap | (n != F.col("n_places"))), S.CORRUPTED_IR)
        .when(F.coalesce("n_null", F.lit(0)) > 0, S.ENCODE_ERROR)
        .otherwise(S.SUCCESS)
    )
    return joined.select("stream_id", n.cast("bigint").alias("n_events"), "closed", status.alias("status"))


def search_outcome(
    events: DataFrame,
    queries: Queries,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    streams: DataFrame | None = None,
) -> DataFrame:
    """How a sequential search of each stream ends, and the event it stops at.

    Success with the first match; QueryNotFound when an event at or after ``upper``
    came first; EndOfIr when the stream ran out. Streams of ``streams (stream_id, closed)``
    without events are reported too: EndOfIr if closed, else IncompleteIr; so is the end of
    a stream that is not closed.
    """
    queries = list(queries)
    index = first_match_index(queries, F.col("message")).cast("int")
    hit_idx = F.when(in_interval(lower, upper), index)
    hit_seq = F.when(hit_idx.isNotNull(), F.col("seq"))
    # One scan and one aggregate: the first match and the cutoff of every stream.
    ends = events.groupBy("stream_id").agg(
        F.min(F.when(F.col("ts_ms") >= F.lit(upper), F.col("seq"))).alias("cut_seq"),
        F.min(hit_seq).alias("hit_seq"),
        F.min_by(hit_idx, hit_seq).alias("hit_idx"),
    )
    hit = F.col("hit_seq").isNotNull() & (F.col("cut_seq").isNull() | (F.col("hit_seq") < F.col("cut_seq")))
    end = F.lit(S.END_OF_IR)
    if streams is not None:
        ends = ends.join(streams.select("stream_id", "closed"), "stream_id", "full_outer")
        hit = F.coalesce(hit, F.lit(False))
        end = F.when(F.coalesce("closed", F.lit(False)), S.END_OF_IR).otherwise(S.INCOMPLETE_IR)
    return ends.select(
        "stream_id",
        F.when(hit, F.col("hit_seq")).alias("seq"),
        F.when(hit, F.col("hit_idx")).alias("idx"),
        F.when(hit, S.SUCCESS).when(F.col("cut_seq").isNotNull(), S.QUERY_NOT_FOUND).otherwise(end).alias("status"),
    )
