"""Search on encoded tables that decodes only rows whose log type can match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions.templates import may_match
from logloom.operators.encoding import decode_log, with_logtypes
from logloom.operators.search import Queries, before_cutoff, in_interval, search, upper_cutoffs
from logloom.operators.stored import MAX_NAMED_FILES, early_stop_stored
from logloom.plans.joins import attach_materialized
from logloom.session import materialize
from logloom.sources.log_tables import Snapshot
from logloom.sources.zones import logtype_entry, may_hold_any

# Up to this many candidate ids go into the scan as a literal list.
PUSHED_IDS = 1000

# Up to this many candidate ids are looked up in the blocks' filters.
FILTERED_IDS = 32

# With fewer rows per log type than this, testing log types costs more than it saves.
MIN_ROWS_PER_LOGTYPE = 4


def _decoded(named: DataFrame) -> DataFrame:
    """Events of encoded rows; the generator keeps the decoding from being copied into each test."""
    keys = [c for c in S.EVENT_COLS if c != "message"]
    rows = decode_log(named)
    return rows.select(*keys, F.explode(F.array("message")).alias("message")).select(*S.EVENT_COLS)


def search_encoded(
    encoded: DataFrame,
    dictionary: DataFrame,
    queries: Queries,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    stop_at_upper: bool = False,
    n_rows: int | None = None,
) -> DataFrame:
    """Same rows as :func:`search` on the decoded table.

    Log types that no query can reach are dropped first, on the dictionary. Few
    remaining ids are pushed to the Parquet scan, whose files are sorted by id. The
    join that brings in the log type text drops the other rows before decoding, and
    the exact predicate runs on what is left. ``n_rows`` saves a count where known.
    """
    queries = list(queries)
    rows = encoded.filter(in_interval(lower, upper))
    n_rows = encoded.count() if n_rows is None else n_rows
    if dictionary.count() * MIN_ROWS_PER_LOGTYPE > n_rows:
        # Nearly every row has its own log type (prose): nothing to gain from pruning.
        hits = search(_decoded(with_logtypes(rows, dictionary)), queries, lower, upper)
        return before_cutoff(hits, upper_cutoffs(encoded, upper)) if stop_at_upper else hits
    candidates = materialize(
        dictionary.select("logtype_id", "logtype").filter(may_match(queries, "logtype"))
    )
    ids = [r[0] for r in candidates.select("logtype_id").limit(PUSHED_IDS + 1).collect()]
    if len(ids) <= PUSHED_IDS:
        rows = rows.filter(F.col("logtype_id").isin(ids))
    named = attach_materialized(rows, candidates, ["logtype_id"], "inner")
    hits = search(_decoded(named), queries, lower, upper)
    return before_cutoff(hits, upper_cutoffs(encoded, upper)) if stop_at_upper else hits


def search_log(
    spark: SparkSession,
    path: str,
    queries: Queries,
    lower: int = S.MIN_TS,
    upper: int = S.MAX_TS,
    stop_at_upper: bool = False,
) -> DataFrame:
    """:func:`search` over a stored log: prunes log types, then blocks, and decodes only what is left.

    Blocks outside the interval, and blocks whose filter knows none of few candidate log types, are not opened.
    """
    queries = list(queries)
    if stop_at_upper:
        return early_stop_stored(spark, path, queries, lower, upper)
    log = Snapshot(spark, path)
    chunks = log.manifest.chunks.values()
    blocks = log.seen().filter((F.col("max_ts") >= F.lit(lower)) & (F.col("min_ts") < F.lit(upper)))
    if sum(c.n_logtypes for c in chunks) * MIN_ROWS_PER_LOGTYPE > sum(c.n_events for c in chunks):
        # Nearly every row has its own log type (prose): nothing to gain from pruning by type.
        rows = _rows_of_blocks(log, blocks).filter(in_interval(lower, upper))
        return search(_decoded(log.named(rows)), queries, lower, upper)
    candidates = materialize(log.logtypes().select("logtype_id", "logtype").filter(may_match(queries, "logtype")))
    ids = [r[0] for r in candidates.select("logtype_id").limit(PUSHED_IDS + 1).collect()]
    if len(ids) <= FILTERED_IDS:
        blocks = blocks.filter(may_hold_any([logtype_entry(F.lit(i)) for i in ids]))
    rows = _rows_of_blocks(log, blocks).filter(in_interval(lower, upper))
    if len(ids) <= PUSHED_IDS:
        rows = rows.filter(F.col("logtype_id").isin(ids))
    named = attach_materialized(rows, candidates, ["logtype_id"], "inner")
    return search(_decoded(named), queries, lower, upper)


def _rows_of_blocks(log: Snapshot, blocks: DataFrame) -> DataFrame:
    """The timed rows of the files that hold ``blocks``; the other tests are made on the rows."""
    files = blocks.select("chunk", "file").distinct().limit(MAX_NAMED_FILES + 1).collect()
    return log.timed(log.events(None if len(files) > MAX_NAMED_FILES else sorted((r.chunk, r.file) for r in files)))
