"""Cursors and searches on a stored log that open only the blocks they need.

Every question is first put to the zones, one small row per block and stream: which blocks can hold the
answer. Only the files of those blocks are read, only the rows of those blocks and streams are kept, and only
what is left is decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions import codec
from logloom.operators.encoding import decode_log
from logloom.operators.search import Queries, in_interval, search, where
from logloom.plans.joins import attach_materialized
from logloom.plans.ordered import first_per_stream
from logloom.session import scratch_path
from logloom.sources.log_tables import Snapshot, broadcast_if_small
from logloom.sources.zones import BLOCK_BITS, may_hold, variable_key

#: Up to this many files are named to the scan; beyond it all files are, and the join with the zones decides.
MAX_NAMED_FILES = 10_000

_BLOCK_KEY = ["chunk", "file", "block"]


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_in(log: Snapshot, zones: DataFrame, by_stream: bool = True) -> DataFrame:
    """The encoded events of ``zones (chunk, file, block, ...)``, a stored table, with their times."""
    found = zones.groupBy("chunk", "file").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("lo"), F.max("block").alias("hi"))
    found = found.limit(MAX_NAMED_FILES + 1).collect()
    # A block whose rows lie on two days is in two files, and is two blocks to the zones.
    on = [*_BLOCK_KEY, "stream_id"] if by_stream else _BLOCK_KEY
    if len(found) > MAX_NAMED_FILES:
        return log.timed(log.events_by_file().join(zones.select(*on), on, "left_semi").drop("file"))
    rows = log.events_by_file(sorted((r["chunk"], r["file"]) for r in found))
    if found:  # a bound that reaches the scan: pages of other blocks are skipped
        rows = rows.filter(F.col("block").between(min(r["lo"] for r in found), max(r["hi"] for r in found)))
    wanted = broadcast_if_small(zones.select(*on), sum(r["n"] for r in found))
    return log.timed(rows.join(wanted, on, "left_semi").drop("file"))


def seek_zones(log: Snapshot, ts_ms: int) -> DataFrame:
    """The blocks that may hold the first event at or after ``ts_ms`` of their stream, mostly one each.

    The block that is the first to end among those with late enough events holds one; the first of all
    is in it or in a block that begins before that end, which happens where days or chunks overlap.
    """
    late = log.zones().filter(F.col("max_ts") >= F.lit(ts_ms))
    bound = late.groupBy("stream_id").agg(F.min("last_seq").alias("bound"))
    return late.join(bound, "stream_id").filter(F.col("first_seq") <= F.col("bound")).drop("bound")


def _late_rows(log: Snapshot, ts_ms: int) -> DataFrame:
    return rows_in(log, _stored(seek_zones(log, ts_ms), "seek-zones")).filter(F.col("ts_ms") >= F.lit(ts_ms))


def seek_stored(spark: SparkSession, path: str, ts_ms: int) -> DataFrame:
    """The first event at or after ``ts_ms`` of each stream; one message per stream is decoded."""
    log = Snapshot(spark, path)
    late = _late_rows(log, ts_ms)
    kept = F.struct("seq", "ts_ms", "logtype_id", "vars")
    first = late.groupBy("stream_id").agg(F.min_by(kept, "seq").alias("row")).select("stream_id", "row.*")
    return _messages(log, first)


def _messages(log: Snapshot, rows: DataFrame) -> DataFrame:
    return decode_log(log.named(rows)).select(*S.EVENT_COLS)


def positions_stored(log: Snapshot, ts_ms: int, out: str) -> DataFrame:
    """Per stream, the position of its first event at or after ``ts_ms`` (stored)."""
    return _stored(_late_rows(log, ts_ms).groupBy("stream_id").agg(F.min("seq").alias(out)), "positions")


def read_from_stored(spark: SparkSession, path: str, ts_ms: int) -> DataFrame:
    """The event that a seek to ``ts_ms`` finds and all that follow it in its stream."""
    log = Snapshot(spark, path)
    starts = positions_stored(log, ts_ms, "seek_seq")
    zones = log.zones().join(starts, "stream_id").filter(F.col("last_seq") >= F.col("seek_seq"))
    rows = attach_materialized(rows_in(log, _stored(zones, "read-zones")), starts, ["stream_id"], "inner")
    return _messages(log, rows.filter(F.col("seq") >= F.col("seek_seq")))


def early_stop_stored(spark: SparkSession, path: str, queries: Queries, lower: int = S.MIN_TS, upper: int = S.MAX_TS) -> DataFrame:
    """The search of ``[lower, upper)`` that ends each stream at its first event at or after ``upper``.

    Blocks behind a stream's end, and blocks outside the interval, are not opened.
    """
    log = Snapshot(spark, path)
    cuts = positions_stored(log, upper, "cut_seq")
    zones = log.zones().filter((F.col("max_ts") >= F.lit(lower)) & (F.col("min_ts") < F.lit(upper)))
    zones = zones.join(cuts, "stream_id", "left").filter(F.col("cut_seq").isNull() | (F.col("first_seq") < F.col("cut_seq")))
    rows = attach_materialized(rows_in(log, _stored(zones, "stop-zones")), cuts, ["stream_id"], "left")
    rows = rows.filter(in_interval(lower, upper) & (F.col("cut_seq").isNull() | (F.col("seq") < F.col("cut_seq"))))
    return search(_messages(log, rows), queries, lower, upper)


def first_k_stored(
    spark: SparkSession,
    path: str,
    hits: Callable[[DataFrame], DataFrame],
    k: int = 1,
    cursors: DataFrame | None = None,
    lower: int | None = None,
    upper: int | None = None,
    first_rows: int = 1 << BLOCK_BITS,
) -> DataFrame:
    """The first ``k`` rows of every stream that ``hits`` keeps of its events, with their ``rank``.

    ``hits`` maps events to those that count, as ``lambda e: search(e, queries)`` does. The blocks of a stream are
    opened in order: first as many as hold ``first_rows`` of its events, then two times, then four times as
    many, until the stream has its ``k`` rows and all blocks that are still closed begin behind them. ``cursors (stream_id, after_seq)`` skips what
    lies before; ``lower`` and ``upper`` leave out blocks without a time of the interval.
    """
    log = Snapshot(spark, path)
    zones = log.zones()
    if lower is not None:
        zones = zones.filter(F.col("max_ts") >= F.lit(lower))
    if upper is not None:
        zones = zones.filter(F.col("min_ts") < F.lit(upper))
    side = None
    if cursors is not None:
        side = _stored(cursors.select("stream_id", "after_seq"), "cursors")
        side = broadcast_if_small(side, side.count())
        zones = zones.join(side, "stream_id", "left").filter(F.col("after_seq").isNull() | (F.col("last_seq") > F.col("after_seq")))
    line = Window.partitionBy("stream_id").orderBy("first_seq", "chunk", "block", "file").rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("n_events").over(line), F.lit(0)) / first_rows)
    closed = _stored(zones.withColumn("place", place).select("stream_id", "chunk", "block", "file", "first_seq", "place"), "open-order")
    last_place = closed.agg(F.max("place")).first()[0] or 0
    found: DataFrame | None = None
    opened = 0
    while opened <= last_place:
        until = 2 * opened + 1
        turn = closed.filter(F.col("place").between(opened, until - 1))
        if found is not None:
            # Finished: k rows, the last of them before the first block that is still closed.
            next_first = closed.filter(F.col("place") >= opened).groupBy("stream_id").agg(F.min("first_seq").alias("first_seq"))
            last = first_per_stream(found, k).filter(F.col("rank") == k).select("stream_id", F.col("seq").alias("kth"))
            done = next_first.join(last, "stream_id").filter(F.col("kth") < F.col("first_seq"))
            turn = turn.join(done.select("stream_id"), "stream_id", "left_anti")
        opened = until
        turn = _stored(turn, "open-turn")
        if turn.isEmpty():  # a large block may fill the places of several turns
            continue
        rows = rows_in(log, turn)
        if side is not None:
            rows = rows.join(side, "stream_id", "left")
            rows = rows.filter(F.col("after_seq").isNull() | (F.col("seq") > F.col("after_seq"))).drop("after_seq")
        # Of each turn no more than k rows of a stream are kept.
        part = _stored(first_per_stream(hits(_messages(log, rows)), k).drop("rank"), "open-hits")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return first_per_stream(hits(_messages(log, log.timed(log.events([])))), k)
    return first_per_stream(found, k)


def next_match_stored(
    spark: SparkSession, path: str, queries: Queries, cursors: DataFrame | None = None, lower: int = S.MIN_TS, upper: int = S.MAX_TS
) -> DataFrame:
    """The next matching event of each stream behind its cursor."""
    queries = list(queries)
    return first_k_stored(spark, path, lambda e: search(e, queries, lower, upper), 1, cursors, lower, upper).drop("rank")


def next_where_stored(spark: SparkSession, path: str, predicate: Column | Callable, cursors: DataFrame | None = None) -> DataFrame:
    """The next event of each stream behind its cursor for which ``predicate`` holds.

    ``predicate`` is as in :func:`logloom.operators.search.where`: contains, prefix and suffix are
    Columns like ``F.contains("message", F.lit("ERROR"))``.
    """
    return first_k_stored(spark, path, lambda e: where(e, predicate), 1, cursors).drop("rank")


def variables_of(spark: SparkSession, values: Iterable[str]) -> list[str]:
    """The keys of the variables that ``values`` are stored as, if a message holds them as tokens."""
    rows = spark.createDataFrame([(f"={v}",) for v in values], "message string")
    keyed = rows.select(F.transform(codec.vars_of(codec.tokens(F.col("message")), 8), variable_key).alias("keys"))
    found = []
    for r in keyed.collect():
        if len(r["keys"]) != 1:
            raise ValueError("a value must be a single token")
        found.append(r["keys"][0])
    return found


def lookup_variable(spark: SparkSession, path: str, value: str) -> DataFrame:
    """All events that hold ``value`` as a variable; only blocks whose filter knows it are opened."""
    log = Snapshot(spark, path)
    (key,) = variables_of(spark, [value])
    blocks = log.seen().filter(may_hold(F.lit(key))).select("chunk", "block", "file")
    rows = rows_in(log, _stored(blocks, "lookup-blocks"), by_stream=False)
    return _messages(log, rows.filter(F.exists("vars", lambda v: variable_key(v) == key)))
