"""Epoch milliseconds <-> local time text, with zone and pattern per stream.

Sessions use UTC as their time zone; the stream's own zone is applied explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: rendering for streams without a pattern.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
FALLBACK_ZONE = "UTC"


# Times further out have no microseconds since the epoch in 64 bits, in some zone.
MAX_CALENDAR_MS = (2**63 - 1) // 1000 - 2 * 86_400_000


def calendar_time(ts_ms: Column) -> Column:
    """The time as a timestamp; null where no calendar holds it."""
    return F.when(ts_ms.between(-MAX_CALENDAR_MS, MAX_CALENDAR_MS), F.timestamp_millis(ts_ms))


def is_known_zone(tz_id: Column) -> Column:
    """Whether Spark accepts the zone: regional names, short names and offsets."""
    return F.call_function("try_make_timestamp", *[F.lit(x) for x in (2000, 1, 1, 0, 0, 0)], tz_id).isNotNull()


def usable_zone(tz_id: Column) -> Column:
    """The zone, or UTC where it is absent or unknown (Spark fails on unknown zones)."""
    return F.when(is_known_zone(tz_id), tz_id).otherwise(FALLBACK_ZONE)


def _by_pattern(pattern: Column | str, known: Sequence[str], apply) -> Column:
    if isinstance(pattern, str):
        return apply(F.lit(pattern or ISO_PATTERN))
    # Literal patterns get one formatter per task; only patterns not listed in
    # ``known`` need one per row.
    filled = F.coalesce(F.nullif(pattern, F.lit("")), F.lit(ISO_PATTERN))
    case = F.when(filled == ISO_PATTERN, apply(F.lit(ISO_PATTERN)))
    for text in known:
        case = case.when(filled == text, apply(F.lit(text)))
    return case.otherwise(apply(filled))


def render_local(
    ts_ms: Column, tz_id: Column, pattern: Column | str, known_patterns: Sequence[str] = ()
) -> Column:
    """Local time text of an epoch time; null for times that no calendar holds."""
    return render_in_zone(ts_ms, usable_zone(tz_id), pattern, known_patterns)


def render_in_zone(
    ts_ms: Column, zone: Column, pattern: Column | str, known_patterns: Sequence[str] = ()
) -> Column:
    """As :func:`render_local`, for a zone that is known to be valid."""
    local = F.from_utc_timestamp(calendar_time(ts_ms), zone)
    return _by_pattern(pattern, known_patterns, lambda p: F.call_function("date_format", local, p))


def parse_local(
    text: Column, tz_id: Column, pattern: Column | str, known_patterns: Sequence[str] = ()
) -> Column:
    """Epoch milliseconds of a local time text; null where it does not fit the pattern."""
    zone = usable_zone(tz_id)
    return _by_pattern(
        pattern,
        known_patterns,
        lambda p: F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(text, p), zone)),
    )
