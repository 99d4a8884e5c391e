"""What a stored chunk says about its blocks, so that readers open only those they need.

Rows of a chunk are sorted by day, stream and position; each task numbers its rows and 4,096 of them make
a block. ``zones`` holds one row per (block, file, stream): file, first and last position, smallest
and largest time. ``seen`` holds one row per (block, file) with a Bloom filter over the log types and
the values of variables that occur in it: 32,768 bits, two per entry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 12
FILTER_BITS = 32_768
_SEEDS = (11, 23)

ZONE_SCHEMA = (
    "stream_id bigint, block bigint, file string, n_events bigint, first_seq bigint, last_seq bigint, "
    "min_ts bigint, max_ts bigint, chunk bigint"
)
SEEN_SCHEMA = "block bigint, file string, n_events bigint, min_ts bigint, max_ts bigint, filter binary, chunk bigint"


def block_of_row() -> Column:
    """The block of a row of a sorted table, before it is written."""
    return F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)


def file_of_row() -> Column:
    """Day folder and name of the file that a stored row was read from."""
    # A regular expression would try every character of the long path again for each row.
    return F.substring_index(F.col("_metadata.file_path"), "/", -2)


def variable_key(v: Column) -> Column:
    """A text that stands for kind and value of a variable."""
    value = F.when(v["k"] == "d", v["dict"]).otherwise(F.concat_ws("/", v["num"].cast("string"), v["scale"].cast("string")))
    return F.concat(v["k"], F.lit(":"), value)


def _positions(entry: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), entry), F.lit(FILTER_BITS)) for seed in _SEEDS]


def logtype_entry(logtype_id: Column) -> Column:
    return F.concat(F.lit("t:"), logtype_id.cast("string"))


def zones_of(rows: DataFrame) -> DataFrame:
    """Zones of ``rows (stream_id, seq, ts_ms, block, file)``."""
    return rows.groupBy("stream_id", "block", "file").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.min("ts_ms").alias("min_ts"),
        F.max("ts_ms").alias("max_ts"),
    )


def _bitmaps(places: DataFrame) -> DataFrame:
    """``filter`` with the bits ``place`` of each ``block, file``, laid out as by ``bitmap_construct_agg``.

    That function keeps its bitmap in a buffer that only a sort of all places can feed. Words of 64 bits are
    numbers and add up in a hash table; a block has at most ``FILTER_BITS / 64`` of them.
    """
    # The first of a word's eight bytes is its highest one, and is written first.
    bit = F.col("place").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")
    word = places.select("block", "file", F.shiftright("place", 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    word = word.groupBy("block", "file", "word").agg(F.bit_or("bits").alias("bits"))
    blocks = word.groupBy("block", "file").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))

    def text(w: Column, i: Column) -> Column:
        empty = w["word"] - F.coalesce(F.get("words", i - 1)["word"], F.lit(-1)) - 1
        return F.concat(F.repeat(F.lit("0" * 16), empty), F.lpad(F.hex(w["bits"]), 16, "0"))

    whole = F.rpad(F.array_join(F.transform("words", text), ""), FILTER_BITS // 4, "0")
    return blocks.select("block", "file", F.unhex(whole).alias("filter"))


def seen_of(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Filters of ``rows (block, file, logtype_id, vars)``, with the totals of the stored ``zones``."""
    entries = F.concat(F.array_compact(F.array(logtype_entry(F.col("logtype_id")))), F.coalesce(F.transform("vars", variable_key), F.array()))
    entry = rows.select("block", "file", F.explode(entries).alias("entry"))
    places = entry.select("block", "file", F.explode(F.array(*_positions(F.col("entry")))).alias("place"))
    filters = _bitmaps(places)
    totals = zones.groupBy("block", "file").agg(
        F.sum("n_events").alias("n_events"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts")
    )
    return totals.join(filters, ["block", "file"], "left")


def _bit(filter_: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(filter_, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def may_hold(entry: Column, filter_name: str = "filter") -> Column:
    """False only where no row of the block has the entry; blocks without a filter hold nothing."""
    test = F.lit(True)
    for place in _positions(entry):
        test = test & _bit(F.col(filter_name), place)
    return F.coalesce(test, F.lit(False))


def may_hold_any(entries: Sequence[Column], filter_name: str = "filter") -> Column:
    test = F.lit(False)
    for entry in entries:
        test = test | may_hold(entry, filter_name)
    return test
