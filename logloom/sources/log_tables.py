"""Encoded log tables on disk: append a chunk, read everything back.

Below one path lie Parquet tables, each cut into ``chunk=<n>/attempt=<id>`` folders:

* ``events``    rows with ``logtype_id``, ``vars`` and ``ts_ms`` (width 8) or ``ts_delta``, the time since
  the stream's reference (width 4), in ``event_day`` folders (days since the epoch in UTC, for any time),
  sorted by stream and position and numbered in blocks
* ``logtypes``  the log types first seen in that chunk, sorted by hash; ids go on across chunks. A later chunk
  reads the pages that hold hashes of its own log types, and chunks that brought none have no part in it
* ``streams``   one row per stream of the chunk with its header fields and a checksum of its events
* ``zones`` and ``seen``  what each block holds (:mod:`logloom.sources.zones`)

A chunk exists once :mod:`logloom.sources.manifest` names its attempt, which is the last thing a writer does.
Writing the newest chunk again replaces it, so a retried or restarted writer changes nothing; a write that is
killed leaves folders that no reader opens. A writer keeps intermediate columns in a ``staging`` folder
of its own attempt and removes that folder at the end. Of two writers at a time one fails.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom import schema as S
from logloom.functions.int64 import wrapping_add, wrapping_subtract
from logloom.operators.encoding import decode_log, encode_log, with_logtype_ids
from logloom.plans.dense import with_dense_id
from logloom.plans.joins import MAX_BROADCAST_BYTES
from logloom.session import materialize
from logloom.sources.manifest import Chunk, Manifest, commit, new_attempt, read_manifest, remove_folder
from logloom.sources.zones import SEEN_SCHEMA, ZONE_SCHEMA, block_of_row, file_of_row, seen_of, zones_of

# Message bytes that one write task sorts; with their variables, rows take up to ten times as much in memory. Small
# tables use all cores but no tiny tasks.
TASK_BYTES = 64 * 1024 * 1024
_SMALL_TASK_BYTES = 4 * 1024 * 1024
_ROW_BYTES = 32
#: Upper estimate of the size of a row of a few numbers and a file name in memory.
_NARROW_BYTES = 256
DAY_MS = 86_400_000
#: Rows of a Parquet page, so that a reader can skip the blocks between those it wants.
_PAGE_ROWS = "4096"
#: Hashes that are looked up one by one in the stored pages; for more, the dictionary is read as a whole.
MAX_LOOKUPS = 256

LOGTYPE_SCHEMA = "logtype_id bigint, logtype string, hash bigint, chunk bigint"
STREAM_SCHEMA = (
    "stream_id bigint, ts_pattern string, ts_pattern_syntax string, tz_id string, "
    "reference_ts bigint, width int, closed boolean, n_events bigint, n_bytes bigint, checksum decimal(38,0), chunk bigint"
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("ts_delta", T.LongType()),
        T.StructField("logtype_id", T.LongType()),
        T.StructField("vars", T.ArrayType(S.VAR)),
        T.StructField("block", T.LongType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("event_day", T.LongType()),
    ]
)
_EVENT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)


def day_of(ts_ms: Column) -> Column:
    """Whole days since the epoch, rounded down; integers only, so every time has one."""
    whole = F.call_function("div", ts_ms, F.lit(DAY_MS))
    return F.when(ts_ms % DAY_MS < 0, whole - 1).otherwise(whole)


def event_hash() -> Column:
    """A hash of an event; sums of it change when an event is lost, doubled or changed."""
    return F.xxhash64(*S.EVENT_COLS).cast("decimal(20,0)")


def broadcast_if_small(side: DataFrame, n_rows: int) -> DataFrame:
    """A table of ``n_rows`` narrow rows, marked for broadcast if that fits."""
    return F.broadcast(side) if n_rows * _NARROW_BYTES <= MAX_BROADCAST_BYTES else side


class Snapshot:
    """The tables of a stored log as of one manifest."""

    def __init__(self, spark: SparkSession, path: str, manifest: Manifest | None = None):
        self.spark, self.path = spark, path
        self.manifest = read_manifest(spark, path) if manifest is None else manifest

    def table(self, name: str, ddl: str, files: list[tuple[int, str]] | None = None) -> DataFrame:
        """A table of all committed chunks, or of ``files (chunk, path below the attempt)`` of them."""
        root = f"{self.path}/{name}"
        chunks = self.manifest.chunks
        wanted = [(n, "") for n in sorted(chunks)] if files is None else files
        if not wanted:
            return self.spark.createDataFrame([], ddl)
        paths = [f"{root}/chunk={n}/attempt={chunks[n].attempt}/{f}".rstrip("/") for n, f in wanted]
        # With its own folders left out of the schema, ``attempt`` would be guessed and added.
        return self.spark.read.schema(f"{ddl}, attempt string").option("basePath", root).parquet(*paths).drop("attempt")

    def events(self, files: list[tuple[int, str]] | None = None) -> DataFrame:
        return self.table("events", _EVENT_DDL, files)

    def events_by_file(self, files: list[tuple[int, str]] | None = None) -> DataFrame:
        """The events with the ``file`` that each was read from, as zones name it."""
        if files == [] or not self.manifest.chunks:
            return self.events([]).withColumn("file", F.lit(None).cast("string"))
        return self.events(files).withColumn("file", file_of_row())

    def logtypes(self) -> DataFrame:
        chunks = self.manifest.chunks
        return self.table("logtypes", LOGTYPE_SCHEMA, [(n, "") for n in sorted(chunks) if chunks[n].n_logtypes])

    def logtypes_among(self, found: DataFrame, max_lookups: int = MAX_LOOKUPS) -> DataFrame:
        """The stored log types that are in ``found (logtype, hash)``, a stored table."""
        hashes = [r["hash"] for r in found.select("hash").distinct().limit(max_lookups + 1).collect()]
        stored = self.logtypes()
        if len(hashes) <= max_lookups:
            # Equalities reach the column index of the files; a long IN would only reach it as a range.
            stored = stored.filter(reduce(Column.__or__, [F.col("hash") == h for h in hashes], F.lit(False)))
        return stored.join(found, ["hash", "logtype"], "left_semi")

    def streams(self) -> DataFrame:
        return self.table("streams", STREAM_SCHEMA)

    def zones(self) -> DataFrame:
        return self.table("zones", ZONE_SCHEMA)

    def seen(self) -> DataFrame:
        return self.table("seen", SEEN_SCHEMA)

    def timed(self, rows: DataFrame) -> DataFrame:
        """Events with ``ts_ms`` filled in where a chunk stores times since a reference; no ``ts_delta``."""
        chunks = self.manifest.chunks.values()
        if all(c.width == 8 for c in chunks):
            return rows.drop("ts_delta")
        side = self.streams().filter(F.col("width") == 4).select("chunk", "stream_id", "reference_ts")
        side = broadcast_if_small(side, sum(c.n_streams for c in chunks))
        time = wrapping_add(F.coalesce("reference_ts", F.lit(0).cast("bigint")), F.col("ts_delta"))
        timed = rows.join(side, ["chunk", "stream_id"], "left").withColumn("ts_ms", F.coalesce("ts_ms", time))
        return timed.drop("reference_ts", "ts_delta")

    def named(self, rows: DataFrame) -> DataFrame:
        """Events with their log type's text instead of its id."""
        names = self.logtypes().select("logtype_id", "logtype")
        # The manifest knows the size, so nothing is measured here.
        side = F.broadcast(names) if self.manifest.logtype_bytes <= MAX_BROADCAST_BYTES else names
        return rows.join(side, "logtype_id", "left").drop("logtype_id")

    def decoded(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the events with their messages and a status."""
        return decode_log(self.named(self.timed(rows)))


def read_logtypes(spark: SparkSession, path: str) -> DataFrame:
    return Snapshot(spark, path).logtypes()


def read_streams(spark: SparkSession, path: str) -> DataFrame:
    return Snapshot(spark, path).streams()


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    return Snapshot(spark, path).events()


def write_log(
    events: DataFrame,
    path: str,
    width: int = 4,
    tz_id: str | None = None,
    ts_pattern: str = "",
    ts_pattern_syntax: str = "",
    references: DataFrame | None = None,
    compression: str = "zstd",
    chunk: int = 0,
    closed: bool = True,
    streams: DataFrame | None = None,
) -> Manifest:
    """Encode ``events``, store them as one chunk and commit it.

    Defaults follow a plain writer: 4-byte encoding, the session's time zone, no
    pattern. The reference timestamp of a stream defaults to its first time in the
    chunk, so equal input gives equal tables. ``streams (stream_id, ts_pattern,
    ts_pattern_syntax, tz_id)`` gives streams headers of their own; the arguments hold for
    the others.
    """
    spark = events.sparkSession
    base = read_manifest(spark, path)
    if any(n > chunk for n in base.chunks):
        raise ValueError(f"chunk {chunk} is not the newest one: later chunks use its log types")
    zone = tz_id if tz_id is not None else spark.conf.get("spark.sql.session.timeZone")
    header = {"ts_pattern": ts_pattern, "ts_pattern_syntax": ts_pattern_syntax, "tz_id": zone}
    written = write_chunk(events, path, base, chunk, width, header, references, streams, compression, closed)
    return commit(spark, path, base.with_chunk(chunk, written))


def write_chunk(
    events: DataFrame,
    path: str,
    base: Manifest,
    chunk: int,
    width: int,
    header: dict[str, str],
    references: DataFrame | None = None,
    streams: DataFrame | None = None,
    compression: str = "zstd",
    closed: bool = True,
) -> Chunk:
    """Write all tables of a chunk under a new attempt; readers see them once the result is committed."""
    spark = events.sparkSession
    attempt = new_attempt()
    earlier = Snapshot(spark, path, base.before(chunk))
    mine = Snapshot(spark, path, Manifest(chunks={chunk: Chunk(attempt, width, n_logtypes=-1)}))  # not yet known

    def write(rows: DataFrame, table: str, *by: str) -> None:
        options = {"compression": compression, "parquet.page.row.count.limit": _PAGE_ROWS}
        rows.write.options(**options).parquet(f"{path}/{table}/chunk={chunk}/attempt={attempt}", partitionBy=list(by) or None)

    # The source is read and encoded once. The dictionary, the headers and the range
    # sampling of the sorted write all work on the staged columns.
    sized = events.select(*S.EVENT_COLS).withColumn("n_bytes", F.octet_length("message"))
    sized = sized.withColumn("hash", event_hash())
    staging = f"{path}/staging/attempt={attempt}"
    encoded = encode_log(sized, width).drop("status")
    encoded.write.option("compression", compression).parquet(staging)
    staged = spark.read.schema(encoded.schema).parquet(staging)

    found = staged.select("logtype").filter(F.col("logtype").isNotNull()).distinct()
    found = found.withColumn("hash", F.xxhash64("logtype"))
    start = 1 + max((c.top_logtype for c in earlier.manifest.chunks.values()), default=-1)
    known = earlier.logtypes()
    if start:
        found = materialize(found)
        known = materialize(earlier.logtypes_among(found))
        found = found.join(known, ["hash", "logtype"], "left_anti").select("logtype", "hash")
    write(with_dense_id(found, "logtype", "logtype_id", start, by_hash=True), "logtypes")
    n_new, type_bytes = mine.logtypes().agg(F.count(F.lit(1)), F.sum(F.octet_length("logtype"))).first()

    write(_headers(staged, width, header, references, streams, closed), "streams")
    n_streams, n_events, n_bytes = mine.streams().agg(F.count(F.lit(1)), F.sum("n_events"), F.sum("n_bytes")).first()
    mine.manifest.chunks[chunk] = Chunk(attempt, width, n_events or 0, n_streams, n_new)
    size = (n_bytes or 0) + (n_events or 0) * _ROW_BYTES
    cores = spark.sparkContext.defaultParallelism
    tasks = max(math.ceil(size / TASK_BYTES), min(cores, math.ceil(size / _SMALL_TASK_BYTES)), 1)

    dictionary = known.unionByName(mine.logtypes()).drop("chunk", "hash")
    rows, _ = with_logtype_ids(staged.drop("n_bytes", "hash").withColumn("event_day", day_of(F.col("ts_ms"))), dictionary)
    if width == 4:
        rows = rows.join(broadcast_if_small(mine.streams().select("stream_id", "reference_ts"), n_streams), "stream_id", "left")
        rows = rows.withColumn("ts_delta", wrapping_subtract(F.col("ts_ms"), F.coalesce("reference_ts", F.lit(0).cast("bigint"))))
        rows = rows.withColumn("ts_ms", F.lit(None).cast("bigint"))
    else:
        rows = rows.withColumn("ts_delta", F.lit(None).cast("bigint"))
    # The event key ends the range key, so even one hot stream spreads over tasks.
    layout = ["event_day", "stream_id", "seq"]
    placed = rows.select("stream_id", "seq", "ts_ms", "ts_delta", "logtype_id", "vars", "event_day")
    placed = placed.repartitionByRange(tasks, *layout).sortWithinPartitions(*layout).withColumn("block", block_of_row())
    write(placed, "events", "event_day")

    stored = mine.events_by_file()
    write(zones_of(mine.timed(stored)), "zones")
    write(seen_of(stored, mine.zones()), "seen")
    remove_folder(spark, staging)
    return Chunk(attempt, width, n_events or 0, n_streams, n_new, start + n_new - 1, type_bytes or 0)


def _headers(
    staged: DataFrame, width: int, header: dict[str, str], references: DataFrame | None, streams: DataFrame | None, closed: bool
) -> DataFrame:
    headers = staged.groupBy("stream_id").agg(
        F.min_by("ts_ms", "seq").alias("first_ts"),
        F.count(F.lit(1)).alias("n_events"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum("hash").cast("decimal(38,0)").alias("checksum"),
    )
    if references is not None:
        headers = headers.join(references.select("stream_id", "reference_ts"), "stream_id", "left")
    else:
        headers = headers.withColumn("reference_ts", F.col("first_ts"))
    if streams is not None:
        headers = headers.join(streams.select("stream_id", *header), "stream_id", "left")
    else:
        headers = headers.withColumns({c: F.lit(None).cast("string") for c in header})
    return headers.select(
        "stream_id",
        *[F.coalesce(c, F.lit(text)).alias(c) for c, text in header.items()],
        F.coalesce("reference_ts", F.lit(0)).cast("bigint").alias("reference_ts"),
        F.lit(width).cast("int").alias("width"),
        F.lit(closed).alias("closed"),
        "n_events",
        F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"),
        "checksum",
    )


def close_log(spark: SparkSession, path: str, streams: DataFrame | None = None) -> Manifest:
    """Close all streams of a log, or those of ``streams (stream_id)``, also ones without events.

    Nothing that is stored changes; the closed ids are added below ``closed``.
    """
    base = read_manifest(spark, path)
    ids = Snapshot(spark, path, base).streams() if streams is None else streams
    attempt = new_attempt()
    ids.select("stream_id").distinct().write.parquet(f"{path}/closed/attempt={attempt}")
    return commit(spark, path, base.with_closing(attempt))


def stream_ends(spark: SparkSession, path: str) -> DataFrame:
    """``(stream_id, closed)`` of a stored log: closed by its newest chunk or by :func:`close_log`."""
    log = Snapshot(spark, path)
    ends = log.streams().groupBy("stream_id").agg(F.max_by("closed", "chunk").alias("closed"))
    if not log.manifest.closings:
        return ends
    ids = spark.read.schema("stream_id bigint").parquet(*[f"{path}/closed/attempt={a}" for a in log.manifest.closings])
    both = ends.unionByName(ids.select("stream_id", F.lit(True).alias("closed")))
    return both.groupBy("stream_id").agg(F.max("closed").alias("closed"))


def read_log(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All events of a stored log, decoded: ``(stream_id, seq, ts_ms, message, status)``.

    ``version`` reads the log as that manifest left it.
    """
    log = Snapshot(spark, path, read_manifest(spark, path, version))
    return log.decoded(log.events()).select(*S.EVENT_COLS, "status")


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    """``(chunk, stream_id, n_events, n_stored, intact)``: whether what is read is what was written.

    Compares the counts and checksums that the writer took of its input with those of the decoded
    events; one lost, doubled or changed event shows, without the source table.
    """
    log = Snapshot(spark, path)
    keys = ["chunk", "stream_id"]
    found = log.decoded(log.events()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_stored"), F.sum(event_hash()).cast("decimal(38,0)").alias("sum"))
    heads = log.streams().select(*keys, "n_events", "checksum")
    joined = heads.join(found, keys, "full_outer")
    intact = F.col("n_events").eqNullSafe(F.col("n_stored")) & F.col("checksum").eqNullSafe(F.col("sum"))
    n = {c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_events", "n_stored")}
    return joined.select(*keys, *n.values(), intact.alias("intact"))
