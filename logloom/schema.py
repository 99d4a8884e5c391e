"""Column layouts of the log tables and the fixed values they share."""

from __future__ import annotations

from pyspark.sql import types as T

# Status names reported per stream or per row.
SUCCESS = "Success"
DECODE_ERROR = "DecodeError"
END_OF_IR = "EndOfIr"
CORRUPTED_IR = "CorruptedIr"
INCOMPLETE_IR = "IncompleteIr"
QUERY_NOT_FOUND = "QueryNotFound"
ENCODE_ERROR = "EncodeError"
UNSUPPORTED_VERSION = "UnsupportedVersion"

# Keys of the per-stream metadata JSON and its only valid type code.
META_REFERENCE_TS = "REFERENCE_TIMESTAMP"
META_PATTERN = "TIMESTAMP_PATTERN"
META_PATTERN_SYNTAX = "TIMESTAMP_PATTERN_SYNTAX"
META_TZ_ID = "TZ_ID"
METADATA_TYPE_JSON = 1

# Default search interval, half-open.
MIN_TS = 0
MAX_TS = 9223372036854775807

LOG_EVENTS = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

STREAMS_RAW = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("metadata_type", T.IntegerType()),
        T.StructField("metadata", T.StringType()),
    ]
)

STREAMS = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("ts_pattern", T.StringType()),
        T.StructField("ts_pattern_syntax", T.StringType()),
        T.StructField("tz_id", T.StringType()),
        T.StructField("reference_ts", T.LongType()),
        T.StructField("width", T.IntegerType()),
    ]
)

VAR = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("num", T.LongType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("dict", T.StringType()),
    ]
)

EVENT_KEY = ["stream_id", "seq"]
EVENT_COLS = ["stream_id", "seq", "ts_ms", "message"]
