"""Joins of event rows with a per-stream (or per-template) side table.

The side table may be small or huge, and one key may own a large share of the event
rows. ``attach`` therefore computes the side once, measures it, and then either
broadcasts it or joins by shuffle. In a shuffle join adaptive execution splits the rows
of a hot key over several tasks, each with that key's one side row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.session import materialize

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_OVERHEAD = 32
_FIXED_WIDTH = 16


def measured_bytes(table: DataFrame) -> int:
    """Upper estimate of the in-memory size of a materialised table."""
    widths = [F.lit(_ROW_OVERHEAD)]
    for field in table.schema.fields:
        width = F.lit(_FIXED_WIDTH)
        if isinstance(field.dataType, T.StringType):
            width = F.coalesce(F.octet_length(field.name), F.lit(0)) + _FIXED_WIDTH
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0)) * 2 + _FIXED_WIDTH
        widths.append(width)
    total = table.agg(F.sum(reduce(lambda a, b: a + b, widths))).first()[0]
    return int(total or 0)


def attach(
    rows: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` joined with ``side`` (unique on ``on``); ``how`` keeps or filters rows."""
    return attach_materialized(rows, materialize(side), on, how, max_broadcast_bytes)


def attach_materialized(
    rows: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """As :func:`attach`, for a side that is already stored."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"rows must stay on the left of the join, got {how}")
    if measured_bytes(side) <= max_broadcast_bytes:
        return rows.join(F.broadcast(side), on, how)
    # Adaptive execution splits the tasks of hot keys; ``rows`` is the side that may hold them.
    return rows.join(side, on, how)
