import random

import pytest
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.operators.encoding import decode_log, encode_log, explode_vars
from logloom.operators.quality import roundtrip_audit
from logloom.session import scratch_path
from logloom.sources.log_tables import read_log, write_log

SETS = {
    "combo": [
        "static text dict=var notint123 -1.234 4321.",
        "static123 text321 dict=var0123 321.1234 -3210.",
    ],
    "dict": ["textint1234 textequal=variable", "test=bigint 2147483648"],
    "float": ["float 1.0 1.2 1.23 1.234", "-float -1.0 -1.2 -1.23 -1.234"],
    "int": ["int 1 12 123 1234", "-int -1 -12 -123 -1234"],
    "static": ["static text log zero.", "static text log one."],
}
EDGES = [
    "-0", "-0.0", "007", "1.", ".5", "-0.5", "-0.05", "0.0", "9999999999999999999", "2147483647", "-2147483648",
    "2147483648", "-2147483649", "21474836.48", "21474836.47", "<i>", "<i", "&lt;", "&lt;5", "a&b", "\\", "k==v",
    "k=", "=v", "k=--", "k=-5", "", " ", "\n", "é=é1", "99999999.99999999", "999999999999999999", "=<a", "=&a",
]


def messages_df(make_events, messages):
    return make_events([(0, i, 1704067200000 + 7 * i, m) for i, m in enumerate(messages)])


@pytest.mark.parametrize("width", [8, 4])
@pytest.mark.parametrize("codec", ["zstd", "none"])
def test_stored_round_trip(spark, make_events, width, codec):
    path = scratch_path(spark, "test")
    want = [
        (stream, i, 1704067200000 + 7 * i, m)
        for stream, messages in enumerate(SETS.values())
        for i, m in enumerate(messages)
    ]
    write_log(make_events(want), path, width=width, compression=codec)
    rows = sorted(map(tuple, read_log(spark, path).collect()))
    assert rows == [(*row, "Success") for row in want]


@pytest.mark.parametrize("width", [8, 4])
def test_long_messages(spark, width):
    size = 8 * 1024 * 1024
    events = spark.range(2).select(
        F.lit(0).cast("bigint").alias("stream_id"),
        F.col("id").alias("seq"),
        F.col("id").alias("ts_ms"),
        F.expr(f"repeat('x', cast({size} - id as int))").alias("message"),
    )
    assert roundtrip_audit(events, width).first().asDict() == {
        "stream_id": 0, "n_events": 2, "n_lossy": 0, "n_failed": 0,
    }


@pytest.mark.parametrize("width", [8, 4])
def test_edges_and_random_messages(make_events, width):
    rng = random.Random(7)
    alphabet = "0123456789.-+_\\=<>& abzAZéü\n"
    texts = EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(20000)]
    audit = roundtrip_audit(messages_df(make_events, texts), width).first()
    assert (audit.n_events, audit.n_lossy, audit.n_failed) == (len(texts), 0, 0)


def test_worked_examples(make_events):
    encoded = encode_log(messages_df(make_events, SETS["combo"] + ["a&b <i> 5"]))
    assert [r.logtype for r in encoded.orderBy("seq").collect()] == [
        "static text dict=<d> <d> <f> <d>",
        "<d> <d> dict=<d> <f> <d>",
        "a&amp;b &lt;i> <i>",
    ]


def test_kinds_by_width(make_events):
    texts = ["2147483647", "2147483648", "-2147483648", "21474836.47", "21474836.48", "-0.5"]
    for width, kinds in ((8, "iiifff"), (4, "idifdf")):
        rows = explode_vars(encode_log(messages_df(make_events, texts), width)).orderBy("seq").collect()
        assert "".join(r.k for r in rows) == kinds
    half = rows[-1]
    assert (half.num, half.scale, half.dict) == (-5, 1, None)


def test_bad_rows_get_a_status(spark, make_events):
    encoded = encode_log(make_events([(0, 0, 0, None), (0, 1, 0, "a 1")]))
    assert {r.seq: r.status for r in encoded.collect()} == {0: S.ENCODE_ERROR, 1: S.SUCCESS}
    broken = spark.createDataFrame(
        [
            (0, "a <i>", []),
            (1, "a <i>", [("d", None, None, "x")]),
            (2, "a", [("i", 1, None, None)]),
            (3, "a <i>", [("i", None, None, None)]),
            (4, None, None),
            (5, "a <f>", [("f", 5, 1, None)]),
        ],
        "seq long, logtype string, vars array<struct<k:string,num:long,scale:int,dict:string>>",
    )
    rows = {r.seq: (r.message, r.status) for r in decode_log(broken).collect()}
    assert rows.pop(5) == ("a 0.5", S.SUCCESS)
    assert set(rows.values()) == {(None, S.DECODE_ERROR)}
