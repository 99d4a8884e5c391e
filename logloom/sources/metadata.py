"""Per-stream metadata: from raw header JSON to the ``streams`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions.localtime import FALLBACK_ZONE, is_known_zone, render_in_zone, usable_zone
from logloom.plans.joins import attach


def _text_field(json: Column, key: str) -> Column:
    """A field that holds a JSON string; absent fields and other types count as null."""
    path = f"$.{key}"
    is_text = F.schema_of_variant(F.try_variant_get(json, path, "variant")) == "STRING"
    return F.when(is_text, F.try_variant_get(json, path, "string"))


def parse_metadata(raw: DataFrame) -> DataFrame:
    """``streams_raw`` to ``streams`` plus ``status``.

    Only JSON metadata (type 1) is known. Absent text fields become ''. The reference
    timestamp is a decimal string that counts for 4-byte streams; otherwise it is 0.
    Bad rows keep their stream with empty fields and say what is wrong.
    """
    parsed = raw.withColumn("_json", F.try_parse_json("metadata"))
    shape = F.schema_of_variant("_json")
    is_object = F.coalesce(shape.startswith("OBJECT") | (shape == "VOID"), F.lit(False))
    status = (
        F.when(F.col("metadata").isNull() | (F.col("metadata") == ""), S.INCOMPLETE_IR)
        .when(F.coalesce(F.col("metadata_type") != S.METADATA_TYPE_JSON, F.lit(True)), S.UNSUPPORTED_VERSION)
        .when(~is_object, S.CORRUPTED_IR)
        .otherwise(S.SUCCESS)
    )
    parsed = parsed.withColumn("status", status)

    def text(key: str) -> Column:
        return F.when(F.col("status") == S.SUCCESS, F.coalesce(_text_field(F.col("_json"), key), F.lit(""))).otherwise("")

    reference = text(S.META_REFERENCE_TS)
    number = F.when(reference.rlike("^[+-]?[0-9]+$"), reference.try_cast("bigint"))
    return parsed.select(
        "stream_id",
        text(S.META_PATTERN).alias("ts_pattern"),
        text(S.META_PATTERN_SYNTAX).alias("ts_pattern_syntax"),
        text(S.META_TZ_ID).alias("tz_id"),
        F.when(F.col("width") == 4, F.coalesce(number, F.lit(0))).otherwise(0).cast("bigint").alias("reference_ts"),
        "width",
        "status",
    )


def with_stream_info(events: DataFrame, streams: DataFrame) -> DataFrame:
    """Events with the pattern, syntax and zone of their stream."""
    info = streams.select("stream_id", "ts_pattern", "ts_pattern_syntax", "tz_id")
    return attach(events, info, ["stream_id"], "left")


def with_local_time(events: DataFrame, streams: DataFrame, known_patterns: Sequence[str] = ()) -> DataFrame:
    """Add ``local_time`` and ``zone_known`` by each stream's pattern and zone."""
    # Zone and pattern are settled once per stream, not per event.
    info = streams.select(
        "stream_id",
        "ts_pattern",
        "ts_pattern_syntax",
        "tz_id",
        usable_zone(F.col("tz_id")).alias("_zone"),
        is_known_zone(F.col("tz_id")).alias("_known"),
    )
    joined = attach(events, info, ["stream_id"], "left")
    zone = F.coalesce("_zone", F.lit(FALLBACK_ZONE))
    local = render_in_zone(F.col("ts_ms"), zone, F.col("ts_pattern"), known_patterns)
    named = joined.withColumn("local_time", local).withColumn("zone_known", F.coalesce("_known", F.lit(False)))
    return named.drop("_zone", "_known")
