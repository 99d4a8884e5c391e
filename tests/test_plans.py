"""Building blocks against brute force, also with one stream that owns most rows."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from logloom.operators.encoding import decode_log, encode_log
from logloom.operators.search import search
from logloom.operators.timestamps import delta_encode, delta_restore
from logloom.plans.dense import with_dense_id
from logloom.plans.joins import attach
from logloom.plans.ordered import first_per_stream, previous_value, running_sum
from logloom.session import scratch_path, settle


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for stream, n, span in ((0, 3000, 5000), (1, 40, 10**9), (2, 1, 3), (-5, 300, 10**15)):
        for seq in rng.sample(range(-span, span), n):
            rows.append((stream, seq, rng.randint(-500, 500), f"m{seq}"))
    return rows, spark.createDataFrame(rows, "stream_id long, seq long, ts_ms long, message string")


def by_stream(rows):
    streams = {}
    for r in sorted(rows):
        streams.setdefault(r[0], []).append(r)
    return streams


@pytest.mark.parametrize("bits", [2, 5, 18])
def test_previous_value_and_running_sum(skewed, bits):
    rows, df = skewed
    want = {}
    for stream, part in by_stream(rows).items():
        total, prev = 0, None
        for _, seq, ts, _ in part:
            total += ts
            want[stream, seq] = (prev, total)
            prev = ts
    prev = {(r.stream_id, r.seq): r.p for r in previous_value(df, "ts_ms", "p", bits=bits).collect()}
    sums = {(r.stream_id, r.seq): r.s for r in running_sum(df, "ts_ms", "s", bits=bits).collect()}
    assert {k: (prev[k], sums[k]) for k in want} == want
    assert len(prev) == len(sums) == len(want)


def test_delta_round_trip(skewed):
    rows, df = skewed
    restored = delta_restore(delta_encode(df, 77, bits=4), 77, bits=3)
    assert {(r.stream_id, r.seq, r.ts_ms, r.message) for r in restored.collect()} == set(rows)


@pytest.mark.parametrize("bits", [1, 18])
def test_delta_round_trip_of_any_time(spark, bits):
    top, bottom = 2**63 - 1, -(2**63)
    times = [-5, top, bottom, bottom, top, 0, bottom + 1, top - 1, -1, 1]
    rows = [(stream, seq, times[(seq + stream) % len(times)], "m") for stream in (0, 1) for seq in range(25)]
    df = spark.createDataFrame(rows, "stream_id long, seq long, ts_ms long, message string")
    encoded = delta_encode(df, bottom, bits=bits)
    steps = {(r.stream_id, r.seq): r.ts_delta for r in encoded.collect()}
    for stream, part in by_stream(rows).items():
        prev = bottom
        for _, seq, ts, _ in part:
            assert steps[stream, seq] == (ts - prev - bottom) % 2**64 + bottom
            prev = ts
    restored = delta_restore(encoded, bottom, bits=bits)
    assert sorted((r.stream_id, r.seq, r.ts_ms, r.message) for r in restored.collect()) == rows


def test_first_per_stream(skewed):
    rows, df = skewed
    got = {(r.stream_id, r["rank"]): r.seq for r in first_per_stream(df, 5).collect()}
    assert got == {(s, i + 1): r[1] for s, part in by_stream(rows).items() for i, r in enumerate(part[:5])}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach_without_broadcast(spark, skewed, how):
    _, df = skewed
    side = spark.createDataFrame([(0, "big"), (1, "small"), (9, "absent")], "stream_id long, label string")
    small = attach(df, side, ["stream_id"], how)
    large = attach(df, side, ["stream_id"], how, max_broadcast_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_dense_ids(spark):
    values = [f"v{i * 7919 % 5003}" for i in range(5003)]
    df = spark.createDataFrame([(v,) for v in values], "value string").repartition(7)
    got = {r.id: r.value for r in with_dense_id(df, "value", "id", start=10).collect()}
    assert got == {i + 10: v for i, v in enumerate(sorted(values))}


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, skewed):
    path = scratch_path(spark, "plan")
    skewed[1].write.parquet(path)
    return spark.read.parquet(path)


def test_search_plan_pushes_filters(stored):
    plan = plan_of(search(stored, ["*error*"], 5, 100))
    assert "GreaterThanOrEqual(ts_ms,5)" in plan and "LessThan(ts_ms,100)" in plan
    assert "StringContains(message,error)" in plan
    assert "Exchange" not in plan
    assert "StringStartsWith(message,user=1)" in plan_of(search(stored, ["user=1*"]))


def test_codec_and_filters_stay_in_the_jvm(stored):
    for df in (decode_log(encode_log(stored)), search(stored, ["*a*b?c*", "x*"])):
        plan = plan_of(df)
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_joins_are_never_nested_loops(skewed):
    _, df = skewed
    plan = plan_of(search(df, ["*m*"], 0, 100, stop_at_upper=True))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_narrow_columns_only(stored):
    plan = plan_of(encode_log(stored).groupBy("logtype").agg(F.count(F.lit(1)).alias("n")))
    assert "ReadSchema: struct<message:string>" in plan


def test_driver_collects_what_jobs_left(spark):
    collectors = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    rounds = lambda: sum(c.getCollectionCount() for c in collectors if "Old" in c.getName() or "MarkSweep" in c.getName())
    before = rounds()
    settle(spark)
    assert rounds() > before
