"""Exact deduplication with a split of heavy hitters.

Two texts are equal when they are identical after each run of white space became one space.
Misra-Gries summaries find the digests that may be frequent; one aggregation over all rows
verifies them and gives each its winner and size. These winners, at most ``counters + 1``
rows, are broadcast, so that copies of frequent texts are settled map-side and never
shuffled. All other digests occur in at most ``2 / (counters + 1)`` of the rows each and go
through an ordinary shuffle.

Cases: a null text counts as empty; of equal texts the row with the smallest id stays, a null
id comes last, and of rows with the same id exactly one stays; an empty table gives no rows;
other columns are carried by :func:`keep_first` and ignored by :func:`exact_dedup`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import SPACE_RUN, stored, text_of
from logloom.llm.frequent import frequent_candidates

COUNTERS = 1024


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text_col), SPACE_RUN, " "), 256))


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_digest(text_col).alias("digest"))
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "digests")


def _order() -> Column:
    """Sort key of a row: rows without id last, then id, then place in the stored table."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("place"))


def frequent_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``(digest, winner, group_size)`` of the frequent digests, exact, at most ``counters + 1`` rows."""
    candidates = frequent_candidates(digests, "digest", counters).select("digest")
    return stored(
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.min(_order()).alias("winner"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``."""
    digests = _digests(docs, id_col, text_col)
    winners = frequent_winners(digests, counters)
    heavy = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = (
        digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("winner", F.min(_order()).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("place") == F.col("winner.place")).alias("kept"),
        "digest",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Rows that agree in id and normalised text but not in the raw text leave the one whose text
    sorts first.
    """
    winners = frequent_winners(_digests(docs, id_col, text_col), counters)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_of(text_col).alias("raw"),
        text_digest(text_col).alias("digest"),
    )
    heavy = (
        rows.join(F.broadcast(winners), "digest")
        .filter(F.col("doc_id").eqNullSafe(F.col("winner.doc_id")))
        .groupBy("digest")
        .agg(F.min_by("row", "raw").alias("row"))
    )
    first = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), "raw")
    light = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("rank", F.row_number().over(first))
        .filter("rank = 1")
    )
    return heavy.select("row.*").unionByName(light.select("row.*"))
