import gzip
import os

import pytest

from logloom import schema as S
from logloom.operators import quality
from logloom.session import scratch_path
from logloom.sources.log_tables import read_encoded, read_log, read_logtypes, read_streams, write_log
from logloom.sources.metadata import parse_metadata, with_local_time
from logloom.sources.text import read_text_log

REF = 1704067200000


@pytest.fixture(scope="module")
def streams(spark):
    full = (
        '{"REFERENCE_TIMESTAMP":"1704067200000","TIMESTAMP_PATTERN":"yyyy-MM-dd HH:mm:ss,SSS",'
        '"TIMESTAMP_PATTERN_SYNTAX":"java::SimpleDateFormat","TZ_ID":"America/Toronto"}'
    )
    rows = [
        (1, 4, 1, full), (2, 8, 1, full), (3, 4, 1, "{}"), (4, 4, 1, '{"TZ_ID":"Asia/Kolkata"}'),
        (5, 4, 1, '{"REFERENCE_TIMESTAMP":"abc"}'), (6, 4, 2, full), (7, 4, 1, "not json"), (8, 4, 1, ""),
        (9, 4, 1, '{"REFERENCE_TIMESTAMP":99,"TZ_ID":5}'), (10, 4, 1, "[]"), (11, 4, 1, "null"),
        (12, 4, 1, '{"REFERENCE_TIMESTAMP":"-12","TZ_ID":"Mars/Olympus"}'), (13, 4, None, full),
        (14, 4, 1, '{"REFERENCE_TIMESTAMP":"99999999999999999999"}'),
    ]
    return parse_metadata(spark.createDataFrame(rows, S.STREAMS_RAW))


def test_metadata(streams):
    rows = {r.stream_id: r for r in streams.collect()}
    assert {k: r.status for k, r in rows.items() if r.status != S.SUCCESS} == {
        6: S.UNSUPPORTED_VERSION, 7: S.CORRUPTED_IR, 8: S.INCOMPLETE_IR, 10: S.CORRUPTED_IR, 13: S.UNSUPPORTED_VERSION,
    }
    assert {k: r.reference_ts for k, r in rows.items() if r.reference_ts} == {1: REF, 12: -12}
    assert rows[1].ts_pattern_syntax == "java::SimpleDateFormat"
    assert (rows[4].tz_id, rows[4].ts_pattern) == ("Asia/Kolkata", "")
    assert (rows[9].tz_id, rows[6].tz_id) == ("", "")


def test_local_time(make_events, streams):
    events = make_events([(s, 0, REF + 5, "x") for s in (1, 3, 4, 12)])
    for known in ((), ("yyyy-MM-dd HH:mm:ss,SSS",)):
        got = {r.stream_id: (r.local_time, r.zone_known) for r in with_local_time(events, streams, known).collect()}
        assert got == {
            1: ("2023-12-31 19:00:00,005", True),
            3: ("2024-01-01T00:00:00.005", False),
            4: ("2024-01-01T05:30:00.005", True),
            12: ("2024-01-01T00:00:00.005", False),
        }


def test_text_lines_keep_their_order(spark):
    folder = scratch_path(spark, "lines").removeprefix("file:")
    os.makedirs(folder)
    for name in ("a.log", "b.log"):
        with open(f"{folder}/{name}", "w") as f:
            f.writelines(f"{i}\n" if i % 5 else "\n" for i in range(30000))
    with gzip.open(f"{folder}/c.log.gz", "wt") as f:
        f.writelines(f"{i}\n" for i in range(1, 2000))
    with open(f"{folder}/d.log", "w") as f:
        f.write("\n" * 20000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = read_text_log(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    files = {}
    for r in sorted(rows, key=lambda r: (r.stream_name, r.seq)):
        files.setdefault(os.path.basename(r.stream_name), []).append(r.message)
    want = [str(i) if i % 5 else "" for i in range(30000)]
    assert files["a.log"] == files["b.log"] == want
    assert files["c.log.gz"] == [str(i) for i in range(1, 2000)]
    assert files["d.log"] == [""] * 20000
    for name in files:
        assert sorted(r.seq for r in rows if r.stream_name.endswith("/" + name)) == list(range(len(files[name])))


@pytest.mark.parametrize("width", [4, 8])
def test_chunks_share_one_dictionary(spark, make_events, width):
    first = [(s, i, REF + i, f"job {i} done") for s in (0, 1) for i in range(5)]
    second = [(s, i, REF - i, f"task {i} done" if i % 2 else f"job {i} done") for s in (1, 2) for i in range(5, 9)]
    path = scratch_path(spark, "chunks")
    write_log(make_events(first), path, width=width, chunk=0, closed=False)
    write_log(make_events(second), path, width=width, chunk=1)
    write_log(make_events(second), path, width=width, chunk=1)
    rows = {(r.stream_id, r.seq, r.ts_ms, r.message) for r in read_log(spark, path).collect()}
    assert rows == set(first + second)
    types = {r.logtype: (r.logtype_id, r.chunk) for r in read_logtypes(spark, path).collect()}
    assert types == {"job <i> done": (0, 0), "task <i> done": (1, 1)}
    stored = read_encoded(spark, path)
    assert stored.filter(stored.ts_delta.isNotNull()).count() == (len(first + second) if width == 4 else 0)
    heads = {(r.chunk, r.stream_id): (r.reference_ts, r.closed, r.n_events) for r in read_streams(spark, path).collect()}
    assert heads[1, 2] == (REF - 5, True, 4) and heads[0, 0] == (REF, False, 5)


def test_given_reference_and_null_messages(spark, make_events):
    events = make_events([(0, 0, REF, "a 1"), (0, 1, REF + 5, None), (0, 2, REF + 3, "b")])
    refs = spark.createDataFrame([(0, 1000)], "stream_id long, reference_ts long")
    path = scratch_path(spark, "refs")
    write_log(events, path, references=refs, tz_id="America/Toronto", ts_pattern="HH:mm")
    assert read_encoded(spark, path).orderBy("seq").first().ts_delta == REF - 1000
    rows = read_log(spark, path).orderBy("seq").collect()
    assert [(r.ts_ms, r.message, r.status) for r in rows] == [
        (REF, "a 1", S.SUCCESS), (REF + 5, None, S.DECODE_ERROR), (REF + 3, "b", S.SUCCESS),
    ]


def test_stream_status(spark, make_events):
    rows = [(1, 0, 0, "a"), (1, 1, 0, "b"), (2, 0, 0, "a"), (2, 2, 0, "b"), (3, 0, 0, "a"), (5, 0, 0, None)]
    table = spark.createDataFrame(
        [(1, True), (2, True), (3, False), (4, False), (5, True), (6, True)], "stream_id long, closed boolean"
    )
    got = {r.stream_id: (r.n_events, r.status) for r in quality.stream_status(make_events(rows), table).collect()}
    assert got == {
        1: (2, S.SUCCESS), 2: (2, S.CORRUPTED_IR), 3: (1, S.INCOMPLETE_IR), 4: (0, S.INCOMPLETE_IR),
        5: (1, S.ENCODE_ERROR), 6: (0, S.SUCCESS),
    }


def test_repeats_do_not_hide_gaps_and_orphans_are_reported(spark, make_events):
    rows = [(1, 0, 0, "a"), (1, 0, 0, "a"), (1, 2, 0, "b"), (9, 0, 0, "x")]
    table = spark.createDataFrame([(1, True)], "stream_id long, closed boolean")
    got = {r.stream_id: r.status for r in quality.stream_status(make_events(rows), table).collect()}
    assert got == {1: S.CORRUPTED_IR, 9: S.INCOMPLETE_IR}


def test_streams_have_headers_of_their_own(spark, make_events):
    path = scratch_path(spark, "headers")
    heads = spark.createDataFrame([(1, "HH:mm", "java", "Asia/Kolkata")], "stream_id long, ts_pattern string, ts_pattern_syntax string, tz_id string")
    write_log(make_events([(1, 0, REF, "a"), (2, 0, REF, "b")]), path, tz_id="UTC", streams=heads)
    got = {r.stream_id: (r.ts_pattern, r.ts_pattern_syntax, r.tz_id) for r in read_streams(spark, path).collect()}
    assert got == {1: ("HH:mm", "java", "Asia/Kolkata"), 2: ("", "", "UTC")}


def test_only_named_queries_return_nothing(spark, sf_dir):
    from logloom.registry import QUERIES

    for name in ("time_interval_early_stop", "stream_early_stop", "search_encoded_edges", "wildcard_nocase_unicode"):
        assert not QUERIES[name](spark, sf_dir).isEmpty(), name


def test_long_templates_do_not_pass_through_the_driver(spark):
    from pyspark.sql import functions as F

    from logloom.plans.dense import with_dense_id

    long = spark.range(300).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 40_000)).alias("v"))
    ids = with_dense_id(long, "v", "id", by_hash=True)
    assert sorted(r.id for r in ids.select("id").collect()) == list(range(300))


def test_scratch_tables_can_be_removed(spark):
    from logloom import session

    kept, session._scratch[:] = list(session._scratch), []
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.remove_scratch(spark) == 1
    assert not os.path.exists(path.removeprefix("file:"))
    session._scratch[:] = kept
