"""Searches over a log table: wildcard queries, time intervals, simple text tests."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions.glob import WildcardQuery, any_match, first_match_index, folded
from logloom.functions.pattern_columns import first_in_table, keyed_queries
from logloom.plans.joins import attach
from logloom.session import materialize

Queries = Iterable[WildcardQuery | str]

# Up to this many queries are also stated as one OR, which the Parquet scan can use.
_PUSHED_QUERIES = 16


# Up to this many queries of a table are one expression; more are looked up by a join.
PLAIN_QUERIES = 256


def in_interval(lower: int = S.MIN_TS, upper: int = S.MAX_TS) -> Column:
    """``[lower, upper)`` on ``ts_ms``; two range tests that reach the Parquet scan."""
    return (F.col("ts_ms") >= F.lit(lower)) & (F.col("ts_ms") < F.lit(upper))


def upper_cutoffs(events: DataFrame, upper: int) -> DataFrame:
    """Per stream, the position of the first event at or after ``upper``."""
    return (
        events.filter(F.col("ts_ms") >= F.lit(upper))
        .groupBy("stream_id")
        .agg(F.min("seq").alias("cut_seq"))
    )


def before_cutoff(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Events before their stream's cutoff; streams without one are kept whole."""
    joined = attach(events, cutoffs, ["stream_id"], "left")
    return joined.filter(F.col("cut_seq").isNull() | (F.col("seq") < F.col("cut_seq"))).drop("cut_seq")


def search(
    events: DataFrame,
    queries: Queries,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    stop_at_upper: bool = False,
) -> DataFrame:
    """Events in ``[lower, upper)`` that match a query, with the first matching index.

    ``stop_at_upper`` ends each stream at its first event at or after ``upper``, as a
    sequential reader does; it differs from the plain interval only where time runs
    backwards. The default interval leaves out negative times, again like the reader.
    """
    queries = list(queries)
    index = first_match_index(queries, F.col("message")).cast("int")
    in_time = events.filter(in_interval(lower, upper))
    if len(queries) <= _PUSHED_QUERIES:
        in_time = in_time.filter(any_match(queries, F.col("message")))
    if len(queries) == 1:
        index = F.lit(0).cast("int")  # the filter has said all there is to know
    hits = in_time.withColumn("idx", index).filter(F.col("idx").isNotNull())
    return before_cutoff(hits, upper_cutoffs(events, upper)) if stop_at_upper else hits


def stream_search(events: DataFrame, queries: Queries, lower: int = S.MIN_TS, upper: int = S.MAX_TS) -> DataFrame:
    """The search without early stop; stateless, so it also runs on a streaming DataFrame."""
    return search(events, queries, lower, upper)


def search_query_table(events: DataFrame, queries: DataFrame, lower: int = S.MIN_TS, upper: int = S.MAX_TS) -> DataFrame:
    """As :func:`search`, with queries from a table ``(idx, query, case_sensitive)``.

    A long table stays a table: events are scanned once, short texts of their messages
    find the queries that may match by an equi-join, and only those are tested
    (:mod:`logloom.functions.pattern_columns`). Up to ``PLAIN_QUERIES`` become one expression, which gives
    the same rows. ``idx`` is the place of a query in the list: it must not be null or occur twice.
    """
    n, n_places = queries.agg(F.count(F.lit(1)), F.count_distinct("idx")).first()
    if n != n_places:
        raise ValueError("idx must be given and unique for every query")
    if n == 0:
        return search(events, [], lower, upper)
    in_time = events.filter(in_interval(lower, upper))
    if n > PLAIN_QUERIES:
        return first_in_table(in_time, materialize(keyed_queries(queries)))
    rows = sorted(queries.select("idx", "query", "case_sensitive").collect())
    # Folded once per row: the generator keeps the expression from being copied into each test.
    once = in_time.withColumn("_folded", F.explode(F.array(folded(F.col("message")))))
    index = first_match_index(
        [WildcardQuery(r["query"], r["case_sensitive"]) for r in rows], F.col("message"), [r["idx"] for r in rows], F.col("_folded")
    )
    return once.withColumn("idx", index.cast("int")).filter(F.col("idx").isNotNull()).drop("_folded")


def contains(events: DataFrame, text: str) -> DataFrame:
    return events.filter(F.contains("message", F.lit(text)))


def prefix(events: DataFrame, text: str) -> DataFrame:
    return events.filter(F.startswith("message", F.lit(text)))


def suffix(events: DataFrame, text: str) -> DataFrame:
    return events.filter(F.endswith("message", F.lit(text)))


def where(events: DataFrame, predicate: Column | Callable[[pd.Series, pd.Series], pd.Series]) -> DataFrame:
    """Events for which a user predicate holds.

    Pass a boolean Column where possible. A Python function gets Arrow batches of
    ``ts_ms`` and ``message`` as pandas Series and returns a boolean Series.
    """
    if isinstance(predicate, Column):
        return events.filter(predicate)

    @F.pandas_udf("boolean")
    def test(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ts_ms, message in batches:
            yield predicate(ts_ms, message).astype(bool)

    return events.filter(test("ts_ms", "message"))
