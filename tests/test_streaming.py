import pytest
from pyspark.sql import types as T

from logloom.operators.search import search
from logloom.session import scratch_path
from logloom.sources.log_tables import read_log, read_logtypes
from logloom.streaming import jobs, state
from logloom.streaming.outcome import start_outcome

DELTAS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("stream_id", "seq", "ts_delta")] + [T.StructField("message", T.StringType())]
)


@pytest.fixture
def arrive(spark):
    """Feed arrivals one by one to a job started with ``start(source, checkpoint)``."""

    def feed(arrivals, schema, start):
        inbox, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "ck")
        for rows in arrivals:
            spark.createDataFrame(rows, schema).write.mode("append").parquet(inbox)
            start(spark.readStream.schema(schema).parquet(inbox), checkpoint).awaitTermination()

    return feed


def test_restore_carries_time_and_reports_late_rows(spark, arrive):
    refs = spark.createDataFrame([(0, 1000), (1, 50)], "stream_id long, reference_ts long")
    out = scratch_path(spark, "out")
    arrivals = [
        [(0, 1, 5, "b"), (0, 0, 1, "a"), (1, 0, 7, "x")],
        [(0, 3, -2, "d"), (0, 1, 99, "late"), (0, 2, 4, "c")],
        [(1, 5, 3, "y"), (2, 0, 8, "no reference")],
    ]
    arrive(arrivals, DELTAS, lambda source, ck: jobs.start_restore(source, refs, out, ck))
    rows = spark.read.parquet(f"{out}/events").select("stream_id", "seq", "ts_ms", "message").collect()
    assert sorted(map(tuple, rows)) == [
        (0, 0, 1001, "a"), (0, 1, 1006, "b"), (0, 2, 1010, "c"), (0, 3, 1008, "d"),
        (1, 0, 57, "x"), (1, 5, 60, "y"), (2, 0, 8, "no reference"),
    ]
    assert [r.message for r in spark.read.parquet(f"{out}/late").collect()] == ["late"]


def test_early_stop_is_remembered(spark, arrive, make_events):
    parts = [
        [(0, 0, 10, "error"), (0, 1, 95, "ok"), (1, 0, 10, "ok")],
        [(0, 2, 20, "error"), (1, 1, 30, "error")],
        [(1, 2, 90, "error"), (1, 3, 40, "error"), (2, 0, 5, "error")],
    ]
    out = scratch_path(spark, "out")
    schema = make_events([]).schema
    arrive(
        parts, schema, lambda source, ck: jobs.start_early_stop_search(source, ["error"], 0, 90, out, ck)
    )
    got = sorted((r.stream_id, r.seq) for r in spark.read.parquet(f"{out}/events").collect())
    batch = search(make_events(sum(parts, [])), ["error"], 0, 90, stop_at_upper=True)
    assert got == sorted((r.stream_id, r.seq) for r in batch.collect()) == [(0, 0), (1, 1), (2, 0)]


def test_encode_append_extends_the_dictionary(spark, arrive, make_events):
    parts = [[(0, i, i, f"job {i}") for i in range(3)], [(0, 3, 3, "stop"), (0, 4, 4, "job 9")], [(1, 0, 0, "a=b")]]
    path = scratch_path(spark, "log")
    arrive(parts, make_events([]).schema, lambda source, ck: jobs.start_encode_append(source, path, ck))
    assert sorted(r.message for r in read_log(spark, path).collect()) == sorted(r[3] for p in parts for r in p)
    ids = {r.logtype: r.logtype_id for r in read_logtypes(spark, path).collect()}
    assert ids == {"job <i>": 0, "stop": 1, "a=<d>": 2}


def test_state_snapshots_and_replay(spark, monkeypatch):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", 3)
    table = state.StateTable(spark, scratch_path(spark, "state"), jobs.RESTORE_STATE, "last_seq")
    want = {}
    for epoch in range(8):
        changed = [(epoch % 3, epoch * 10, epoch * 100), (7, epoch, epoch)]
        for _ in range(2 if epoch in (2, 5) else 1):  # a replayed epoch writes the same again
            table.write(epoch, spark.createDataFrame(changed, jobs.RESTORE_STATE))
        want.update({r[0]: r for r in changed})
        assert {r.stream_id: tuple(r) for r in table.before(epoch + 1).collect()} == want


def test_outcome_of_closed_and_silent_streams(spark, make_events):
    heads = "stream_id long, closed boolean"
    inbox, notices, out, checkpoint = (scratch_path(spark, x) for x in ("in", "heads", "out", "ck"))
    schema = make_events([]).schema

    def arrive(events, ends, silent_ms):
        make_events(events).coalesce(1).write.mode("append").parquet(inbox)
        spark.createDataFrame(ends, heads).coalesce(1).write.mode("append").parquet(notices)
        sources = (spark.readStream.schema(s).parquet(p) for s, p in ((schema, inbox), (heads, notices)))
        args = (["error", "x*"], 0, 90, out, checkpoint, silent_ms)
        start_outcome(next(sources), *args, next(sources)).awaitTermination()

    first = [(0, 2, 5, "error"), (0, 1, 6, "x"), (1, 0, 5, "y"), (1, 1, 99, "x"), (1, 2, 5, "x"), (2, 0, 3, None), (3, 0, 3, "z"), (None, 0, 1, "x")]
    arrive(first, [(i, False) for i in (4, 5)], 3_600_000)
    ended = {(0, 1, 1, "Success"), (1, None, None, "QueryNotFound")}
    assert set(map(tuple, spark.read.parquet(out).collect())) == ended
    # Streams with an outcome ignore what comes later; a match in the batch of the closing notice still counts.
    arrive([(1, 3, 4, "x"), (2, 1, 4, "x1"), (2, 2, 4, "x")], [(0, True), (2, True), (4, True), (5, False), (3, None)], 1)
    ended |= {(2, 1, 1, "Success"), (4, None, None, "EndOfIr")}
    assert set(map(tuple, spark.read.parquet(out).collect())) == ended
    arrive([], [], 1)
    ended |= {(3, None, None, "IncompleteIr"), (5, None, None, "IncompleteIr")}
    got = list(map(tuple, spark.read.parquet(out).collect()))
    assert set(got) == ended and len(got) == len(ended)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
