"""How each arriving stream ends: a stateful operator with timers.

Every task first cuts what it read of a stream in a record batch to one row (first match, first event at or
after the upper bound, whether it was closed), so a stream that dominates the input is small when its rows
meet. Spark's state store then holds one row per stream. A match or a cutoff gives the outcome of the stream
at once, and so does the notice that it is closed; a timer gives that of a stream which stays silent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from logloom import schema as S
from logloom.functions.glob import first_match_index
from logloom.operators.search import Queries, in_interval

OUTCOME_SCHEMA = "stream_id bigint, seq bigint, idx int, status string"
_FOUND_SCHEMA = "stream_id bigint, cut_seq bigint, hit_seq bigint, hit_idx int, closed boolean"
_STATE_SCHEMA = "done boolean, due bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_outcome(
    events: DataFrame,
    queries: Queries,
    lower: int,
    upper: int,
    out: str,
    checkpoint: str,
    silent_ms: int,
    ends: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Append ``(stream_id, seq, idx, status)`` of every stream to Parquet, each once, as soon as it is known.

    The status is that of :func:`logloom.operators.quality.search_outcome`. ``ends (stream_id, closed)`` is a
    stream of notices: one that is not closed opens a stream before its first event, a closed one ends it
    with EndOfIr unless a match or cutoff arrived with it or before. A stream without either that gives
    neither event nor notice for ``silent_ms`` of processing time is IncompleteIr. Within a stream, later
    batches hold later positions; rows that come after the outcome change nothing. Null ids are left out.

    A job that runs on also runs batches without rows, so timers fire as time goes by. A job over what is
    available ends instead: timers that are due fire in its batches, for which an empty file is enough.
    """
    queries = list(queries)
    hit = F.when(in_interval(lower, upper), first_match_index(queries, F.col("message")).cast("int"))
    rows = events.select(
        "stream_id",
        F.when(F.col("ts_ms") >= F.lit(upper), F.col("seq")).alias("cut_seq"),
        F.when(hit.isNotNull(), F.col("seq")).alias("hit_seq"),
        hit.alias("hit_idx"),
        F.lit(None).cast("boolean").alias("closed"),
    )
    if ends is not None:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("cut_seq", "bigint"), ("hit_seq", "bigint"), ("hit_idx", "int"))]
        rows = rows.unionByName(ends.select("stream_id", *none, "closed"))
    found = rows.filter(F.col("stream_id").isNotNull()).mapInArrow(_per_stream, _FOUND_SCHEMA)
    outcomes = found.groupBy("stream_id").transformWithStateInPandas(
        _Outcome(silent_ms), OUTCOME_SCHEMA, outputMode="Append", timeMode="ProcessingTime"
    )
    trigger = trigger or {"availableNow": True}
    settings = {_PROVIDER: _ROCKSDB}
    if trigger.get("availableNow") or trigger.get("once"):
        settings[_EMPTY_BATCHES] = "false"
    writer = outcomes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _started(events.sparkSession, settings, lambda: writer.trigger(**trigger).start(out))


def _per_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per stream and record batch; the first non-null match in order of ``hit_seq`` is the first one."""
    sums = [("cut_seq", "min"), ("hit_seq", "first"), ("hit_idx", "first"), ("closed", "any")]
    for batch in batches:
        ordered = pa.Table.from_batches([batch]).sort_by("hit_seq")
        grouped = ordered.group_by("stream_id", use_threads=False).aggregate(sums)
        yield from grouped.select(["stream_id", *[f"{c}_{how}" for c, how in sums]]).rename_columns(batch.schema.names).to_batches()


class _Outcome(StatefulProcessor):
    """State of a stream: whether its outcome is out, and when silence ends it."""

    def __init__(self, silent_ms: int):
        self.silent_ms = silent_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("stream", _STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cut = hit = idx = None
        closed = False
        for part in rows:
            if part["cut_seq"].notna().any():
                first = int(part["cut_seq"].min())
                cut = first if cut is None else min(cut, first)
            if part["hit_seq"].notna().any():
                best = part.loc[part["hit_seq"].astype("Int64").idxmin()]
                if hit is None or best["hit_seq"] < hit:
                    hit, idx = int(best["hit_seq"]), int(best["hit_idx"])
            closed = closed or bool(part["closed"].fillna(False).astype(bool).any())
        done, due = self.state.get() if self.state.exists() else (False, None)
        if done:
            return
        if due is not None:
            self.handle.deleteTimer(due)
        if hit is not None and (cut is None or hit < cut):
            yield self._ended(key, S.SUCCESS, hit, idx)
        elif cut is not None:
            yield self._ended(key, S.QUERY_NOT_FOUND)
        elif closed:
            yield self._ended(key, S.END_OF_IR)
        else:
            due = timerValues.getCurrentProcessingTimeInMs() + self.silent_ms
            self.handle.registerTimer(due)
            self.state.update((False, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists() and not self.state.get()[0]:
            yield self._ended(key, S.INCOMPLETE_IR)

    def close(self) -> None:
        pass

    def _ended(self, key, status: str, seq: int | None = None, idx: int | None = None) -> pd.DataFrame:
        self.state.update((True, None))
        return pd.DataFrame(
            {
                "stream_id": pd.array([key[0]], "Int64"),
                "seq": pd.array([seq], "Int64"),
                "idx": pd.array([idx], "Int32"),
                "status": [status],
            }
        )


def _started(spark: SparkSession, settings: dict[str, str], start) -> StreamingQuery:
    """Start a query under ``settings``, which it keeps; the session's own are put back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
