"""Log views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.plans.dense import with_dense_id

# An odd factor permutes the places inside each block of ids, at every size.
_SCRAMBLE, _BLOCK = 7919, 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Event times carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_message() -> Column:
    def text(c: Column) -> Column:
        return c.cast("string")

    event_id = F.col("event_id")
    return F.concat(
        F.lit("user="), text(F.col("user_id")), F.lit(" action="), F.col("event_type"),
        F.lit(" took "), text(F.col("value")), F.lit(" ms, code"), text(event_id % 17),
        F.lit(" "), text(event_id % 5), F.lit(" "), F.col("props"),
    )


def _event_ts() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream per user; time never runs backwards within a stream."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stream_id"),
        F.col("event_id").alias("seq"),
        _event_ts().alias("ts_ms"),
        _event_message().alias("message"),
    )


def log_disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in eight streams; within blocks of ids the order is scrambled."""
    place = F.col("event_id") % _BLOCK
    return _table(spark, sf_dir, "events").select(
        (F.col("user_id") % 8).alias("stream_id"),
        (F.col("event_id") - place + place * _SCRAMBLE % _BLOCK).alias("seq"),
        _event_ts().alias("ts_ms"),
        _event_message().alias("message"),
    )


def log_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as long multi-line messages, one stream per source."""
    return _table(spark, sf_dir, "documents").select(
        # Sources of another form are the stream without an id.
        F.substring("source", 4, 20).try_cast("bigint").alias("stream_id"),
        F.col("doc_id").alias("seq"),
        F.lit(0).cast("bigint").alias("ts_ms"),
        F.col("text").alias("message"),
    )


def log_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as short dense streams."""
    return _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("stream_id"),
        F.col("turn").alias("seq"),
        (F.col("turn") * 1000).alias("ts_ms"),
        F.col("text").alias("message"),
    )


def streams_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows of the event streams: complete, sparse, odd and broken ones."""
    firsts = log_events(spark, sf_dir).groupBy("stream_id").agg(F.min("ts_ms").alias("first_ts"))
    kind = F.col("stream_id") % 9
    full = F.concat(
        F.lit('{"REFERENCE_TIMESTAMP":"'), F.col("first_ts").cast("string"),
        F.lit('","TIMESTAMP_PATTERN":"yyyy-MM-dd HH:mm:ss,SSS",'),
        F.lit('"TIMESTAMP_PATTERN_SYNTAX":"java::SimpleDateFormat","TZ_ID":"America/Toronto"}'),
    )
    metadata = (
        F.when(kind == 0, "{}")
        .when(kind == 1, '{"TZ_ID":"Asia/Kolkata"}')
        .when(kind == 2, "not json")
        .when(kind == 3, '{"REFERENCE_TIMESTAMP":"abc","TZ_ID":"Mars/Olympus"}')
        .when(kind == 4, '{"REFERENCE_TIMESTAMP":12345,"TIMESTAMP_PATTERN":7}')
        .when(kind == 5, "[1]")
        .when(kind == 6, "")
        .otherwise(full)
    )
    return firsts.select(
        "stream_id",
        F.when(F.col("stream_id") % 2 == 0, 4).otherwise(8).cast("int").alias("width"),
        F.when(F.col("stream_id") % 11 == 0, 2).otherwise(1).cast("int").alias("metadata_type"),
        metadata.alias("metadata"),
    )


def query_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search queries derived from what the events hold: ``(idx, query, case_sensitive)``."""
    code = F.col("event_id") % 17
    event_type = F.col("event_type")
    query = F.when(
        code % 3 == 0, F.concat(F.lit("*action="), event_type, F.lit('*"k": '), code.cast("string"), F.lit("?}*"))
    ).otherwise(F.concat(F.lit("*ACTION="), F.upper(event_type), F.lit("*CODE"), code.cast("string"), F.lit(" *")))
    found = (
        _table(spark, sf_dir, "events")
        .select(query.alias("query"), (code % 3 == 0).alias("case_sensitive"))
        .distinct()
    )
    return with_dense_id(found, "query", "idx")
