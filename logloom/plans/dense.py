"""Dense ids 0..n-1 in value order for a table of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import materialize

_ROW_BITS = (1 << 33) - 1
# Characters of a value that decide its range.
PREFIX = 128


def with_dense_id(distinct: DataFrame, value: str, out: str, start: int = 0, by_hash: bool = False) -> DataFrame:
    """Number the rows of ``distinct`` by ``value``; the order is global, the work is not.

    Ranges are cut by the first characters, or with ``by_hash`` by a hash (ids are then in hash
    order), so that the samples that reach the driver are small however long the values are. Range
    partitions are sorted on their own and stored, which fixes each row's place.
    The only global step sums the partition sizes: one row per partition.
    """
    placed = materialize(
        distinct.repartitionByRange(F.xxhash64(value) if by_hash else F.substring(value, 1, PREFIX))
        .sortWithinPartitions(*([F.xxhash64(value)] if by_hash else []), value)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    # One row per partition: the broadcast is bounded by the partition count.
    numbered = placed.join(F.broadcast(offsets), "_part")
    dense = F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_ROW_BITS)) + F.lit(start)
    return numbered.select(dense.cast("bigint").alias(out), *distinct.columns)
