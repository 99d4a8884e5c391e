"""Log jobs on arriving data.

The plain search is stateless. Timestamp restore, early stop and encode-and-append
carry state per stream; they run as ``foreachBatch`` jobs that apply the batch
operators to each micro-batch, so a stream that dominates a batch is still split over
tasks. All output of epoch n goes to a folder of that number and replaces what an
interrupted attempt left there. Within a stream, later batches hold later positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logloom import schema as S
from logloom.operators.search import Queries, search, stream_search, upper_cutoffs
from logloom.operators.timestamps import delta_restore
from logloom.plans.joins import attach, attach_materialized
from logloom.session import materialize
from logloom.sources.log_tables import write_log
from logloom.streaming.state import StateTable

RESTORE_STATE = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("last_ts", T.LongType()),
    ]
)
STOP_STATE = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("neg_cut_seq", T.LongType()),
    ]
)


def start_search(
    events: DataFrame,
    queries: Queries,
    out: str,
    checkpoint: str,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    **trigger,
) -> StreamingQuery:
    """Append matches to Parquet as events arrive."""
    hits = stream_search(events, queries, lower, upper)
    return (
        hits.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(out)
    )


def start_restore(
    deltas: DataFrame, references: DataFrame, out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Turn arriving ``ts_delta`` rows into ``ts_ms`` rows under ``out/events``.

    ``references`` seeds streams seen for the first time. Rows at or before the last
    position already restored go to ``out/late`` instead; their delta is not applied.
    """
    state = StateTable(deltas.sparkSession, f"{out}/state", RESTORE_STATE, "last_seq")

    def on_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            # State and references are cut down to the streams that arrived.
            present = batch.select("stream_id").distinct()
            known = materialize(state.before(epoch).join(present, "stream_id", "left_semi"))
            joined = attach_materialized(batch, known, ["stream_id"], "left")
            is_late = F.col("last_seq").isNotNull() & (F.col("seq") <= F.col("last_seq"))
            late = joined.filter(is_late).select(*batch.columns)
            late.write.mode("overwrite").parquet(f"{out}/late/epoch={epoch}")
            fresh = joined.filter(~is_late).select(*batch.columns)
            # One seed per stream: the last restored time, else the reference.
            seeds = (
                present.join(references.select("stream_id", "reference_ts"), "stream_id", "left")
                .join(known.select("stream_id", "last_ts"), "stream_id", "left")
                .select("stream_id", F.coalesce("last_ts", "reference_ts").alias("reference_ts"))
            )
            delta_restore(fresh, seeds).write.mode("overwrite").parquet(f"{out}/events/epoch={epoch}")
            written = spark.read.parquet(f"{out}/events/epoch={epoch}")
            changed = written.groupBy("stream_id").agg(
                F.max("seq").alias("last_seq"), F.max_by("ts_ms", "seq").alias("last_ts")
            )
            state.write(epoch, changed)
        finally:
            batch.unpersist()

    return _start(deltas, on_batch, checkpoint, trigger)


def start_early_stop_search(
    events: DataFrame,
    queries: Queries,
    lower: int,
    upper: int,
    out: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Search that ends each stream at its first event at or after ``upper``."""
    queries = list(queries)
    # The state keeps the smallest cutoff; its negative is the order value.
    state = StateTable(events.sparkSession, f"{out}/state", STOP_STATE, "neg_cut_seq")

    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            found = upper_cutoffs(batch, upper).select("stream_id", (-F.col("cut_seq")).alias("neg_cut_seq"))
            state.write(epoch, found)
            cutoffs = state.before(epoch).unionByName(found).groupBy("stream_id").agg(
                (-F.max("neg_cut_seq")).alias("cut_seq")
            )
            hits = attach(search(batch, queries, lower, upper), cutoffs, ["stream_id"], "left")
            open_rows = hits.filter(F.col("cut_seq").isNull() | (F.col("seq") < F.col("cut_seq"))).drop("cut_seq")
            open_rows.write.mode("overwrite").parquet(f"{out}/events/epoch={epoch}")
        finally:
            batch.unpersist()

    return _start(events, on_batch, checkpoint, trigger)


def start_encode_append(
    events: DataFrame, path: str, checkpoint: str, width: int = 8, compression: str = "zstd", **trigger
) -> StreamingQuery:
    """Encode arriving events and append each batch as a chunk of the log at ``path``.

    New log types get the next free ids; known ones keep theirs. Chunks stay open.
    """

    def on_batch(batch: DataFrame, epoch: int) -> None:
        write_log(batch, path, width=width, compression=compression, chunk=epoch, closed=False)

    return _start(events, on_batch, checkpoint, trigger)


def _start(source: DataFrame, on_batch, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
