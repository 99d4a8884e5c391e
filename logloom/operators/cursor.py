"""Cursor-style reads per stream: seek to a time, next match, first k, read on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.operators.search import Queries, search, where
from logloom.plans.joins import attach
from logloom.plans.ordered import first_per_stream


def seek_positions(events: DataFrame, ts_ms: int) -> DataFrame:
    """Per stream, the position of the first event at or after ``ts_ms`` (narrow scan)."""
    return (
        events.filter(F.col("ts_ms") >= F.lit(ts_ms))
        .groupBy("stream_id")
        .agg(F.min("seq").alias("seek_seq"))
    )


def seek(events: DataFrame, ts_ms: int) -> DataFrame:
    """The first event at or after ``ts_ms`` of each stream, in stream order."""
    at = seek_positions(events, ts_ms).withColumnRenamed("seek_seq", "seq")
    # The time test is implied by the join; stated again it prunes row groups.
    late_enough = events.filter(F.col("ts_ms") >= F.lit(ts_ms))
    return attach(late_enough, at, S.EVENT_KEY, "left_semi")


def read_from(events: DataFrame, ts_ms: int) -> DataFrame:
    """The seek event and all that follow it, also where time falls back below ``ts_ms``."""
    joined = attach(events, seek_positions(events, ts_ms), ["stream_id"], "inner")
    return joined.filter(F.col("seq") >= F.col("seek_seq")).drop("seek_seq")


def after_cursor(events: DataFrame, cursors: DataFrame) -> DataFrame:
    """Events behind the position ``after_seq`` of their stream in ``cursors``.

    Streams without a cursor are read from their start.
    """
    side = cursors.select("stream_id", "after_seq")
    joined = attach(events, side, ["stream_id"], "left")
    return joined.filter(F.col("after_seq").isNull() | (F.col("seq") > F.col("after_seq"))).drop("after_seq")


def next_match(
    events: DataFrame,
    queries: Queries,
    cursors: DataFrame | None = None,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    stop_at_upper: bool = False,
) -> DataFrame:
    """The next matching event of each stream behind its cursor."""
    rows = events if cursors is None else after_cursor(events, cursors)
    return first_per_stream(search(rows, queries, lower, upper, stop_at_upper), 1).drop("rank")


def next_where(events: DataFrame, predicate, cursors: DataFrame | None = None) -> DataFrame:
    """The next event of each stream behind its cursor for which ``predicate`` holds.

    ``predicate`` is a Column such as ``F.contains("message", F.lit("ERROR"))`` or a
    Python function as in :func:`logloom.operators.search.where`.
    """
    rows = events if cursors is None else after_cursor(events, cursors)
    return first_per_stream(where(rows, predicate), 1).drop("rank")


def first_k_matches(
    events: DataFrame,
    queries: Queries,
    k: int,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    stop_at_upper: bool = False,
) -> DataFrame:
    """The first ``k`` matches of each stream with their 1-based ``rank``."""
    return first_per_stream(search(events, queries, lower, upper, stop_at_upper), k)
