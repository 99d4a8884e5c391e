"""Ordered per-stream state (previous value, running sum) without one task per stream.

A stream may hold a large share of all rows, so its rows are cut by position into
blocks of at most ``2**BLOCK_BITS`` rows (positions are unique within a stream), and
blocks into groups of as many blocks. Windows run inside blocks, inside groups and
over the groups of a stream; each level is small, and each level's result is carried
down to the next by an equi-join. Rows are shuffled once, on *(*stream, block)*; the
join that hands the carry to them finds them already partitioned that way. Block
numbers depend on the row alone, so recomputed tasks always agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.int64 import high_half, joined_halves, low_half

BLOCK_BITS = 18

_BLOCK, _GROUP = "_block", "_group"


def _with_block(df: DataFrame, seq: str, bits: int) -> DataFrame:
    return df.withColumn(_BLOCK, F.shiftright(F.col(seq), bits))


def _with_group(blocks: DataFrame, bits: int) -> DataFrame:
    return blocks.withColumn(_GROUP, F.shiftright(F.col(_BLOCK), bits))


def previous_value(
    df: DataFrame,
    value: str,
    out: str,
    stream: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``out``: the non-null ``value`` of the previous row of the stream, null on the first."""
    rows = _with_block(df, seq, bits)
    in_block = rows.withColumn(
        "_near", F.lag(value).over(Window.partitionBy(*stream, _BLOCK).orderBy(seq))
    )
    blocks = _with_group(
        rows.groupBy(*stream, _BLOCK).agg(F.max_by(value, seq).alias("_last")), bits
    )
    groups = blocks.groupBy(*stream, _GROUP).agg(F.max_by("_last", _BLOCK).alias("_group_last"))
    groups = groups.withColumn(
        "_far", F.lag("_group_last").over(Window.partitionBy(*stream).orderBy(_GROUP))
    ).drop("_group_last")
    blocks = blocks.withColumn(
        "_mid", F.lag("_last").over(Window.partitionBy(*stream, _GROUP).orderBy(_BLOCK))
    )
    carry = blocks.join(groups, [*stream, _GROUP], "left").select(
        *stream, _BLOCK, F.coalesce("_mid", "_far").alias("_carry")
    )
    joined = in_block.join(carry, [*stream, _BLOCK], "left")
    return joined.withColumn(out, F.coalesce("_near", "_carry")).drop(_BLOCK, "_near", "_carry")


def running_sum(
    df: DataFrame,
    value: str,
    out: str,
    stream: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``out``: the sum of the 64-bit ``value`` over the stream up to and with the row, modulo 2**64.

    Halves of the numbers are summed apart, so no sum can overflow; a null counts as zero.
    """
    halves = {"low": low_half, "high": high_half}
    rows = _with_block(df, seq, bits)

    def sums(names: dict[str, Column], window=None) -> dict[str, Column]:
        return {name: F.sum(x) if window is None else F.sum(x).over(window) for name, x in names.items()}

    def before(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    up_to_row = Window.partitionBy(*stream, _BLOCK).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    in_block = rows.withColumns(sums({f"_near_{h}": half(F.col(value)) for h, half in halves.items()}, up_to_row))
    totals = sums({f"_total_{h}": half(F.col(value)) for h, half in halves.items()})
    blocks = _with_group(rows.groupBy(*stream, _BLOCK).agg(*[x.alias(n) for n, x in totals.items()]), bits)
    group_totals = sums({f"_group_total_{h}": F.col(f"_total_{h}") for h in halves})
    groups = blocks.groupBy(*stream, _GROUP).agg(*[x.alias(n) for n, x in group_totals.items()])
    far = sums({f"_far_{h}": F.col(f"_group_total_{h}") for h in halves}, before(*stream, order=_GROUP))
    mid = sums({f"_mid_{h}": F.col(f"_total_{h}") for h in halves}, before(*stream, _GROUP, order=_BLOCK))
    groups = groups.withColumns(far).select(*stream, _GROUP, *far)
    carried = [(_or_zero(f"_mid_{h}") + _or_zero(f"_far_{h}")).alias(f"_carry_{h}") for h in halves]
    carry = blocks.withColumns(mid).join(groups, [*stream, _GROUP], "left").select(*stream, _BLOCK, *carried)
    joined = in_block.join(carry, [*stream, _BLOCK], "left")
    high, low = (_or_zero(f"_near_{h}") + F.col(f"_carry_{h}") for h in ("high", "low"))
    return joined.withColumn(out, joined_halves(high, low)).drop(_BLOCK, *[f"_{n}_{h}" for n in ("near", "carry") for h in halves])


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def first_per_stream(df: DataFrame, k: int, stream: str = "stream_id", seq: str = "seq") -> DataFrame:
    """The ``k`` rows of smallest ``seq`` per stream, with their 1-based ``rank``.

    Each task cuts what it read of a stream to ``k`` rows before the shuffle, so a hot stream
    is small when its rows meet.
    """
    rank = F.row_number().over(Window.partitionBy(stream).orderBy(seq))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)
