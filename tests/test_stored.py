"""Stored logs: commits, zones, block filters and the cursors that use them."""

import random

import pytest
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions.int64 import wrapping_add, wrapping_subtract
from logloom.operators import cursor, pruned, search, stored
from logloom.session import scratch_path
from logloom.sources import log_tables, manifest, zones
from logloom.sources.log_tables import Snapshot, audit_log, read_log, write_log
from tests.test_plans import plan_of

REF = 1704067200000


def keys(df):
    return sorted((r.stream_id, r.seq) for r in df.collect())


def events_of(rng, n, streams=4):
    """One stream holds most rows, and time runs back now and then."""
    rows = []
    for i in range(n):
        s = 0 if rng.random() < 0.7 else rng.randrange(1, streams)
        kind = "needle" if rng.random() < 0.004 else rng.choice(["error", "login", "took"])
        rows.append((s, i * 3, REF + i * 1000 + rng.randint(-60_000, 60_000), f"{kind} id={rng.randrange(n)} n {i} x{i % 50}y"))
    return rows


@pytest.fixture(scope="module", params=[4, 8])
def log(spark, request):
    """A log in two chunks of small blocks, with the events it holds."""
    old, zones.BLOCK_BITS = zones.BLOCK_BITS, 5
    try:
        rows = events_of(random.Random(request.param), 3000)
        events = spark.createDataFrame(rows, S.LOG_EVENTS)
        path = scratch_path(spark, "stored-log")
        write_log(events.filter("seq % 2 = 0 and seq < 6000"), path, width=request.param, chunk=0)
        write_log(events.filter("not (seq % 2 = 0 and seq < 6000)"), path, width=request.param, chunk=1)
    finally:
        zones.BLOCK_BITS = old
    return path, events


@pytest.mark.parametrize("at", [REF - 10**9, REF + 1_500_000])
def test_seek_and_read_from(spark, log, at):
    path, events = log
    assert sorted(map(tuple, stored.seek_stored(spark, path, at).collect())) == sorted(map(tuple, cursor.seek(events, at).collect()))
    assert keys(stored.read_from_stored(spark, path, at)) == keys(cursor.read_from(events, at))


def test_early_stop(spark, log):
    path, events = log
    for lower, upper in ((REF, REF + 900_000), (REF + 10**6, REF + 2 * 10**6), (0, S.MAX_TS)):
        want = search.search(events, ["*error*", "*x1?y"], lower, upper, stop_at_upper=True)
        assert keys(stored.early_stop_stored(spark, path, ["*error*", "*x1?y"], lower, upper)) == keys(want)
        assert keys(pruned.search_log(spark, path, ["*error*", "*x1?y"], lower, upper, True)) == keys(want)


@pytest.mark.parametrize(("k", "rows"), [(2, 100), (10_000, 4096)])
def test_first_k(spark, log, k, rows):
    path, events = log
    for query in ("needle*", "no such"):
        want = {(r.stream_id, r.seq, r["rank"]) for r in cursor.first_k_matches(events, [query], k).collect()}
        got = {(r.stream_id, r.seq, r["rank"]) for r in stored.first_k_stored(spark, path, lambda e, q=query: search.search(e, [q]), k, first_rows=rows).collect()}
        assert got == want


def test_next_match_walks_on(spark, log):
    path, events = log
    cursors = None
    for _ in range(2):
        found = stored.next_match_stored(spark, path, ["needle*"], cursors).collect()
        want = cursor.next_match(events, ["needle*"], cursors).collect()
        assert sorted(found) == sorted(want) and found
        cursors = spark.createDataFrame([(r.stream_id, r.seq) for r in found], "stream_id long, after_seq long")
    tests = F.contains("message", F.lit("needle")), lambda ts, msg: msg.str.endswith("x7y")
    for t in tests:
        assert keys(stored.next_where_stored(spark, path, t, cursors)) == keys(cursor.next_where(events, t, cursors))


def test_lookup_opens_few_blocks(spark, log):
    path, events = log
    row = events.filter("stream_id = 0").orderBy("seq").collect()[700]
    number = row.message.split(" n ")[1].split(" ")[0]
    assert keys(stored.lookup_variable(spark, path, number)) == keys(events.filter(F.rlike("message", F.lit(rf"(=| n ){number}( |$)"))))
    assert keys(stored.lookup_variable(spark, path, "x7y")) == keys(events.filter(F.endswith("message", F.lit(" x7y"))))
    assert stored.lookup_variable(spark, path, "x99y").isEmpty()
    (key,) = stored.variables_of(spark, ["x99y"])
    assert key == "d:x99y"
    seen = Snapshot(spark, path).seen()
    n_blocks = seen.count()
    assert n_blocks > 40 and seen.filter(zones.may_hold(F.lit(f"i:{number}"))).count() < n_blocks / 4


def test_filters_never_lose(spark, log):
    path, _ = log
    log_ = Snapshot(spark, path)
    rows = log_.events_by_file()
    entries = rows.select("chunk", "block", "file", F.explode(F.transform("vars", zones.variable_key)).alias("entry"))
    entries = entries.unionByName(rows.select("chunk", "block", "file", zones.logtype_entry(F.col("logtype_id")).alias("entry")))
    joined = entries.join(log_.seen(), ["chunk", "block", "file"])
    assert joined.filter(~zones.may_hold(F.col("entry"))).isEmpty()
    assert joined.count() == entries.count()


def test_filters_are_made_without_sorting_their_bits(spark, log):
    path, _ = log
    log_ = Snapshot(spark, path)
    rows = log_.events_by_file()
    made = zones.seen_of(rows, log_.zones())
    assert not any(x in plan_of(made) for x in ("SortAggregate", "regexp_extract"))
    entries = F.concat(F.array(zones.logtype_entry(F.col("logtype_id"))), F.transform("vars", zones.variable_key))
    bits = rows.select("block", "file", F.explode(entries).alias("entry"))
    bits = bits.select("block", "file", F.explode(F.array(*zones._positions(F.col("entry")))).alias("place"))
    want = bits.groupBy("block", "file").agg(F.bitmap_construct_agg("place").alias("filter"))
    found = {(r["block"], r["file"]): bytes(r["filter"]) for r in made.collect()}
    assert found == {(r["block"], r["file"]): bytes(r["filter"]) for r in want.collect()} and found


def test_seek_reads_only_named_files_and_decodes_one_row_per_stream(spark, log):
    path, events = log
    log_ = Snapshot(spark, path)
    wanted = stored.seek_zones(log_, REF + 2_800_000)
    files = {r.file for r in wanted.select("file").collect()}
    every = {r.file for r in log_.zones().select("file").collect()}
    rows = stored.rows_in(log_, stored._stored(wanted, "z"))
    read = {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in rows.inputFiles() if "/events/" in f}
    assert read == files <= every
    assert rows.count() < events.count() / 4
    plan = plan_of(stored.seek_stored(spark, path, REF + 2_800_000))
    assert "GreaterThanOrEqual(block" in plan and "Python" not in plan


# --- commits -----------------------------------------------------------------------


def test_a_stopped_write_is_not_seen(spark, make_events, monkeypatch):
    path = scratch_path(spark, "stopped")
    first = [(0, i, REF + i, f"job {i}") for i in range(5)]
    second = [(0, i, REF + i, f"task {i}") for i in range(5, 9)]
    write_log(make_events(first), path, width=8, chunk=0)
    before = [log_tables.stream_ends(spark, path).collect(), pruned.search_log(spark, path, ["*"]).count()]
    for name in ("with_dense_id", "_headers", "zones_of", "seen_of", "commit"):
        with monkeypatch.context() as m:
            m.setattr(log_tables, name, lambda *_, **__: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                write_log(make_events(second), path, width=8, chunk=1)
        assert {tuple(r)[:4] for r in read_log(spark, path).collect()} == set(first)
        assert [log_tables.stream_ends(spark, path).collect(), pruned.search_log(spark, path, ["*"]).count()] == before
    assert manifest.remove_uncommitted(spark, path) >= 5
    write_log(make_events(second), path, width=8, chunk=1)
    write_log(make_events(second[:2]), path, width=8, chunk=1)
    assert {tuple(r)[:4] for r in read_log(spark, path).collect()} == set(first + second[:2])
    assert {tuple(r)[:4] for r in read_log(spark, path, version=2).collect()} == set(first + second)
    assert {tuple(r)[:4] for r in read_log(spark, path, version=1).collect()} == set(first)
    assert read_log(spark, path, version=0).isEmpty()
    with pytest.raises(ValueError, match="newest"):
        write_log(make_events(first), path, width=8, chunk=0)
    with pytest.raises(ValueError, match="version"):
        read_log(spark, path, version=9)
    assert manifest.remove_uncommitted(spark, path, keep_versions=1) > 0
    assert read_log(spark, path).count() == 7


def test_of_two_writers_one_fails(spark, make_events):
    path = scratch_path(spark, "writers")
    base = manifest.read_manifest(spark, path)
    write_log(make_events([(0, 0, REF, "a")]), path)
    with pytest.raises(manifest.ConcurrentWriteError):
        manifest.commit(spark, path, base.with_chunk(0, manifest.Chunk("a0", 8)))
    assert manifest.versions(spark, path) == [1]


def test_audit_finds_what_changed(spark, make_events):
    path = scratch_path(spark, "audit")
    rows = [(s, i, REF + i, f"job {i} of {s}") for s in range(4) for i in range(6)]
    write_log(make_events(rows), path, width=8)
    assert all(r.intact for r in audit_log(spark, path).collect())
    log_ = Snapshot(spark, path)
    (chunk,) = log_.manifest.chunks.values()
    lost, doubled, late = [(F.col("stream_id") == s) & (F.col("seq") == i) for s, i in ((1, 2), (2, 3), (3, 4))]
    good = log_.events().drop("chunk")
    bad = good.filter(~lost).unionByName(good.filter(doubled)).withColumn("ts_ms", F.when(late, F.col("ts_ms") + 1).otherwise(F.col("ts_ms")))
    table = spark.createDataFrame(bad.collect(), bad.schema)
    table.write.mode("overwrite").partitionBy("event_day").parquet(f"{path}/events/chunk=0/attempt={chunk.attempt}")
    got = {r.stream_id: (r.n_events, r.n_stored, r.intact) for r in audit_log(spark, path).collect()}
    assert got == {0: (6, 6, True), 1: (6, 5, False), 2: (6, 7, False), 3: (6, 6, False)}


def test_odd_rows(spark, make_events):
    rows = [(0, 0, None, "no time 1"), (None, 1, 5, "no stream 2"), (1, None, 6, "no place 3"), (2, 2, -(2**63), None), (2, 2, 2**63 - 1, "é 4")]
    for width in (4, 8):
        path = scratch_path(spark, "odd")
        write_log(make_events(rows), path, width=width)
        got = [(r.stream_id, r.seq, r.ts_ms, r.message) for r in read_log(spark, path).collect()]
        assert sorted(got, key=repr) == sorted(rows, key=repr)
        assert stored.seek_stored(spark, path, 2**63 - 1).collect()[0].message == "é 4"
        empty = scratch_path(spark, "empty")
        write_log(make_events([]), empty, width=width)
        assert read_log(spark, empty).isEmpty() and stored.seek_stored(spark, empty, 0).isEmpty()
        assert stored.next_match_stored(spark, empty, ["*"]).isEmpty()
        assert stored.lookup_variable(spark, empty, "x1").isEmpty()


def test_sums_wrap_around(spark):
    rng = random.Random(4)
    edge = [0, 1, -1, 2**63 - 1, -(2**63), 2**32, -(2**32), 2**31]
    pairs = [(a, b) for a in edge for b in edge] + [(rng.randrange(-(2**63), 2**63), rng.randrange(-(2**63), 2**63)) for _ in range(200)]

    def wrap(x):
        return (x + 2**63) % 2**64 - 2**63

    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select(wrapping_add(F.col("a"), F.col("b")), wrapping_subtract(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(wrap(a + b), wrap(a - b)) for a, b in pairs]


def test_days_of_all_times(spark):
    times = [0, -1, 1, 86_399_999, 86_400_000, -86_400_000, -86_400_001, 2**63 - 1, -(2**63)]
    got = spark.createDataFrame([(t,) for t in times], "t long").select(log_tables.day_of(F.col("t"))).collect()
    assert [r[0] for r in got] == [t // 86_400_000 for t in times]


def test_a_chunk_reads_only_its_part_of_the_dictionary(spark, make_events):
    path = scratch_path(spark, "log")
    names = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(26 * 26 * 26)]
    write_log(make_events([(0, i, i, f"{n} step") for i, n in enumerate(names)]).coalesce(1), path)
    for chunk, messages in enumerate((["abc step", "not seen"], ["not seen"], ["xyz step", "not seen", "new"], []), 1):
        write_log(make_events([(chunk, i, i, m) for i, m in enumerate(messages)]), path, chunk=chunk)
    log = Snapshot(spark, path)
    assert [c.n_logtypes for _, c in sorted(log.manifest.chunks.items())] == [len(names), 1, 0, 1, 0]
    ids = [r.logtype_id for r in log.logtypes().collect()]
    assert sorted(ids) == list(range(len(names) + 2))
    got = read_log(spark, path).filter("stream_id > 0").select("stream_id", "message")
    assert sorted(map(tuple, got.collect())) == [(1, "abc step"), (1, "not seen"), (2, "not seen"), (3, "new"), (3, "not seen"), (3, "xyz step")]

    asked = spark.createDataFrame([("abc step",), ("xyz step",), ("nowhere",)], "logtype string").withColumn("hash", F.xxhash64("logtype"))
    for most in (2, 256):
        found = log.logtypes_among(asked, most)
        assert {r.logtype for r in found.collect()} == {"abc step", "xyz step"}
    scan = log.logtypes().filter(" or ".join(f"hash = {r.hash}" for r in asked.collect()))
    assert scan.count() == 2
    assert "Or(" in scan._jdf.queryExecution().toString().split("PushedFilters")[1]
    plan = scan.select("logtype_id")._jdf.queryExecution()
    plan.toRdd().count()
    leaf = plan.executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() <= 3 * 4096 < len(names)
