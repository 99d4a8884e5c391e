"""Template encoding of whole log tables and the dictionaries built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions import codec
from logloom.plans.dense import with_dense_id
from logloom.plans.joins import attach_materialized


def encode_log(events: DataFrame, width: int = 8) -> DataFrame:
    """Replace ``message`` by ``logtype`` and ``vars``; a null message gets status EncodeError."""
    message = F.col("message")
    pieces = events.withColumn("_fixed", codec.fixed_parts(message)).withColumn(
        "_tokens", codec.tokens(message)
    )
    return (
        pieces.withColumn("logtype", codec.logtype_of(F.col("_fixed"), F.col("_tokens"), width))
        .withColumn("vars", codec.vars_of(F.col("_tokens"), width))
        .withColumn("status", F.when(message.isNull(), S.ENCODE_ERROR).otherwise(S.SUCCESS))
        .drop("message", "_fixed", "_tokens")
    )


def decode_log(encoded: DataFrame) -> DataFrame:
    """Replace ``logtype`` and ``vars`` by ``message``; rows that do not fit get DecodeError."""
    logtype, variables = F.col("logtype"), F.col("vars")
    fits = codec.is_decodable(logtype, variables)
    return (
        encoded.withColumn("message", F.when(fits, codec.message_of(logtype, variables)))
        .withColumn("status", F.when(F.col("message").isNotNull(), S.SUCCESS).otherwise(S.DECODE_ERROR))
        .drop("logtype", "vars")
    )


def explode_vars(encoded: DataFrame) -> DataFrame:
    """One row per variable, ``pos`` counting from 0 within the message."""
    return encoded.select(*S.EVENT_KEY, F.posexplode("vars").alias("pos", "v")).select(
        *S.EVENT_KEY, "pos", "v.k", "v.num", "v.scale", "v.dict"
    )


def explode_dict_vars(encoded: DataFrame) -> DataFrame:
    """The string variables only, ``pos`` counting string variables from 0."""
    texts = F.transform(F.filter("vars", lambda v: v["k"] == "d"), lambda v: v["dict"])
    return encoded.select(*S.EVENT_KEY, F.posexplode(texts).alias("pos", "value"))


def logtype_dictionary(encoded: DataFrame) -> DataFrame:
    """``(logtype_id, logtype, n)`` with dense ids in log type order."""
    counts = (
        encoded.filter(F.col("logtype").isNotNull())
        .groupBy("logtype")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_dense_id(counts, "logtype", "logtype_id")


def var_dictionary(encoded: DataFrame) -> DataFrame:
    """``(var_id, value, n)`` of all string variables, with dense ids in value order."""
    texts = F.transform(F.filter("vars", lambda v: v["k"] == "d"), lambda v: v["dict"])
    counts = (
        encoded.select(F.explode(texts).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    return with_dense_id(counts, "value", "var_id")


def with_logtype_ids(encoded: DataFrame, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace ``logtype`` by its id; returns the rows and the stored dictionary.

    The dictionary is broadcast while it is small. Beyond that (prose, where nearly
    every message is its own template) rows are spread by salt, as one template may
    own a large share of them.
    """
    # A fresh dictionary already rests on stored rows, so reading it twice is cheap.
    stored = dictionary if dictionary is not None else logtype_dictionary(encoded)
    ids = stored.select("logtype", "logtype_id")
    # A null logtype (EncodeError) has no id and stays in the table with a null id.
    rows = attach_materialized(encoded, ids, ["logtype"], "left")
    return rows.drop("logtype"), stored


def with_logtypes(encoded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Replace ``logtype_id`` by the log type from a stored dictionary."""
    names = dictionary.select("logtype_id", "logtype")
    rows = attach_materialized(encoded, names, ["logtype_id"], "left")
    return rows.drop("logtype_id")
