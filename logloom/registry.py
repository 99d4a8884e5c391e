"""The registered queries: one callable per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions import pattern_columns
from logloom.functions.glob import WildcardQuery
from logloom.functions.localtime import calendar_time, parse_local, render_local, usable_zone
from logloom.operators import cursor, encoding, pruned, quality, search, stored, timestamps
from logloom.session import scratch_path
from logloom.sources import log_tables, metadata, text, views
from logloom.streaming import jobs
from logloom.streaming.outcome import start_outcome

Query = Callable[[SparkSession, str], DataFrame]

# The search interval and the seek time used by the registered queries.
LOWER, UPPER = 1704412800000, 1705708800000
PATTERN = "yyyy-MM-dd HH:mm:ss,SSS"

ERROR_THEN_PURCHASE = [WildcardQuery("*error*"), WildcardQuery("*purchase*")]
MIXED_CASE = [
    WildcardQuery("*ACTION=CLICK*"),
    WildcardQuery("*action=CLICK*code1?*", case_sensitive=False),
    WildcardQuery("user=1*SIGNUP*", case_sensitive=False),
    WildcardQuery("*took ?.?? ms*"),
]

QUERIES: dict[str, Query] = {}


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- scans, sources, sinks ---------------------------------------------------------


@registered
def scan_events(spark, sf):
    wall = F.date_format(calendar_time(F.col("ts_ms")), "yyyy-MM-dd HH:mm:ss.SSS")
    return views.log_events(spark, sf).withColumn("wall_time", wall)


@registered
def scan_decode(spark, sf):
    path = scratch_path(spark, "scan")
    log_tables.write_log(views.log_conv(spark, sf), path, width=8)
    return log_tables.read_log(spark, path)


@registered
def stream_metadata(spark, sf):
    return metadata.parse_metadata(views.streams_raw(spark, sf))


@registered
def events_with_stream_info(spark, sf):
    streams = metadata.parse_metadata(views.streams_raw(spark, sf))
    return metadata.with_stream_info(views.log_events(spark, sf), streams)


@registered
def write_read_roundtrip(spark, sf):
    events = views.log_events(spark, sf)
    parts = []
    for width, codec in ((4, "zstd"), (8, "none")):
        path = scratch_path(spark, f"roundtrip{width}")
        log_tables.write_log(events, path, width=width, compression=codec)
        parts.append(log_tables.read_log(spark, path).withColumn("variant", F.lit(f"{width}/{codec}")))
    return parts[0].unionByName(parts[1])


@registered
def write_read_roundtrip_docs(spark, sf):
    path = scratch_path(spark, "roundtrip-docs")
    log_tables.write_log(views.log_docs(spark, sf), path)
    return log_tables.read_log(spark, path)


@registered
def append_chunks(spark, sf):
    events = views.log_events(spark, sf)
    path = scratch_path(spark, "chunks")
    log_tables.write_log(events.filter(F.col("ts_ms") < LOWER), path, chunk=0, closed=False)
    log_tables.write_log(events.filter(F.col("ts_ms") >= LOWER), path, chunk=1)
    return log_tables.read_log(spark, path).drop("status")


@registered
def scan_text(spark, sf):
    """Events as text lines "<local time> <message>" in compressed files, read and parsed again."""
    path = scratch_path(spark, "text")
    events = views.log_events(spark, sf)
    zone = F.lit("America/Toronto")
    line = F.concat_ws(" ", render_local(F.col("ts_ms"), zone, PATTERN), F.col("message"))
    events.repartitionByRange("seq").sortWithinPartitions("seq").select(line.alias("value")).write.text(path)
    lines = text.read_text_log(spark, path)
    # Files are named in range order: a line's place in the log is its place after the files before.
    before = Window.orderBy("stream_name").rowsBetween(Window.unboundedPreceding, -1)
    files = lines.groupBy("stream_name").agg(F.count(F.lit(1)).alias("n"))
    files = files.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    head = F.substring("message", 1, 23)
    return lines.join(files, "stream_name").select(
        (F.col("base") + F.col("seq")).alias("place"),
        parse_local(head, zone, PATTERN).alias("ts_ms"),
        F.expr("substring(message, 25)").alias("message"),
    )


# --- filters -----------------------------------------------------------------------


def _one(view: str, query: str, case_sensitive: bool = True) -> Query:
    def run(spark, sf):
        return search.search(getattr(views, view)(spark, sf), [WildcardQuery(query, case_sensitive)])

    return run


QUERIES["wildcard_star"] = _one("log_events", "user=1*click*code*{*}")
QUERIES["wildcard_qmark"] = _one("log_events", "*took ??.? ms, code? ?*")
QUERIES["wildcard_escape"] = lambda spark, sf: search.search(
    views.log_events(spark, sf), [r"*\**", r"*\?*", r'*\{"\k": ?\}']
)
QUERIES["wildcard_anchored"] = _one("log_events", "user=1? action=view*")
QUERIES["wildcard_nocase"] = _one("log_docs", "*THE*of*", False)
QUERIES["wildcard_cleanup"] = _one("log_events", "**err**or*\\")


@registered
def multi_query_first_match(spark, sf):
    return search.search(views.log_events(spark, sf), ERROR_THEN_PURCHASE, LOWER, UPPER)


@registered
def multi_query_first_match_docs(spark, sf):
    queries = [
        WildcardQuery("*license*", case_sensitive=False),
        WildcardQuery("*@*.*"),
        WildcardQuery("*the*of*and*"),
        WildcardQuery("*é?e*"),
    ]
    return search.search(views.log_docs(spark, sf), queries)


@registered
def multi_query_mixed_case(spark, sf):
    return search.search(views.log_events(spark, sf), MIXED_CASE)


@registered
def query_table_join(spark, sf):
    return search.search_query_table(views.log_events(spark, sf), views.query_table(spark, sf))


@registered
def query_table_slices(spark, sf):
    """A log with repeated rows: each stays a row of its own, for few queries and for many."""
    events, queries = views.log_events(spark, sf), views.query_table(spark, sf)
    twice = events.unionByName(events.filter(F.col("seq") % 7 == 0))
    few = search.search_query_table(twice, queries.filter("idx < 9"))
    return search.search_query_table(twice, queries).unionByName(few)


@registered
def empty_query_set(spark, sf):
    return search.search(views.log_events(spark, sf), [], LOWER, UPPER)


@registered
def time_interval(spark, sf):
    return views.log_events(spark, sf).filter(search.in_interval(LOWER, UPPER))


@registered
def time_interval_wildcard(spark, sf):
    return search.search(views.log_events(spark, sf), [WildcardQuery("*error*code1? *")], LOWER, UPPER)


@registered
def time_interval_early_stop(spark, sf):
    events = views.log_disordered(spark, sf)
    return search.search(events, ["*error*"], LOWER, UPPER, stop_at_upper=True)


@registered
def search_whole_stream(spark, sf):
    return search.search(views.log_disordered(spark, sf), ["*purchase*"])


@registered
def contains(spark, sf):
    return search.contains(views.log_events(spark, sf), "code13")


@registered
def prefix(spark, sf):
    return search.prefix(views.log_events(spark, sf), "user=12")


@registered
def suffix(spark, sf):
    return search.suffix(views.log_events(spark, sf), '"k": 7}')


@registered
def predicate_column(spark, sf):
    wanted = (F.length("message") % 7 == 3) & (F.col("ts_ms") % 2 == 0)
    return search.where(views.log_events(spark, sf), wanted)


@registered
def predicate_udf(spark, sf):
    return search.where(
        views.log_events(spark, sf), lambda ts, msg: (msg.str.len() % 7 == 3) & (ts % 2 == 0)
    )


# --- cursors -----------------------------------------------------------------------


@registered
def seek_epoch(spark, sf):
    return cursor.seek(views.log_disordered(spark, sf), LOWER)


@registered
def next_match_after(spark, sf):
    events = views.log_events(spark, sf)
    first_errors = search.contains(events, "error").groupBy("stream_id").agg(F.min("seq").alias("after_seq"))
    return cursor.next_match(events, ["*purchase*", "*signup*"], first_errors)


@registered
def next_where_after(spark, sf):
    events = views.log_events(spark, sf)
    first_errors = search.contains(events, "error").groupBy("stream_id").agg(F.min("seq").alias("after_seq"))
    return cursor.next_where(events, F.endswith("message", F.lit("1}")), first_errors)


@registered
def first_k_matches(spark, sf):
    return cursor.first_k_matches(views.log_events(spark, sf), ERROR_THEN_PURCHASE, 3)


@registered
def read_from_epoch(spark, sf):
    return cursor.read_from(views.log_disordered(spark, sf), UPPER)


# --- encode and decode -------------------------------------------------------------


def _encoded(view: str, width: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: encoding.encode_log(getattr(views, view)(spark, sf), width)


def _logtypes(view: str, width: int) -> Query:
    return lambda spark, sf: _encoded(view, width)(spark, sf).select(*S.EVENT_KEY, "logtype", "status")


def _vars(view: str, width: int) -> Query:
    return lambda spark, sf: encoding.explode_vars(_encoded(view, width)(spark, sf))


QUERIES["encode_logtype"] = _logtypes("log_events", 8)
QUERIES["encode_logtype_docs"] = _logtypes("log_docs", 8)
QUERIES["encode_logtype_w4"] = _logtypes("log_docs", 4)
QUERIES["encode_vars_exploded"] = _vars("log_events", 8)
QUERIES["encode_vars_exploded_docs"] = _vars("log_docs", 8)
QUERIES["encode_vars_exploded_w4"] = _vars("log_docs", 4)


@registered
def dict_vars_exploded(spark, sf):
    return encoding.explode_dict_vars(_encoded("log_docs", 8)(spark, sf))


def _decoded(view: str, width: int) -> Query:
    return lambda spark, sf: encoding.decode_log(_encoded(view, width)(spark, sf))


QUERIES["decode_roundtrip"] = _decoded("log_events", 8)
QUERIES["decode_roundtrip_docs"] = _decoded("log_docs", 4)


@registered
def logtype_dictionary(spark, sf):
    return encoding.logtype_dictionary(_encoded("log_events", 8)(spark, sf))


@registered
def logtype_dictionary_docs(spark, sf):
    return encoding.logtype_dictionary(_encoded("log_docs", 8)(spark, sf))


@registered
def encoded_with_ids(spark, sf):
    rows, _ = encoding.with_logtype_ids(_encoded("log_events", 8)(spark, sf))
    return rows.select(*S.EVENT_KEY, "ts_ms", "logtype_id", F.size("vars").alias("n_vars"))


@registered
def var_dictionary(spark, sf):
    return encoding.var_dictionary(_encoded("log_events", 8)(spark, sf))


@registered
def var_dictionary_docs(spark, sf):
    return encoding.var_dictionary(_encoded("log_docs", 8)(spark, sf))


@registered
def roundtrip_audit(spark, sf):
    parts = [
        quality.roundtrip_audit(getattr(views, view)(spark, sf), width).select(
            F.lit(view).alias("log"), F.lit(width).alias("width"), "*"
        )
        for view in ("log_events", "log_docs", "log_conv")
        for width in (8, 4)
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- time --------------------------------------------------------------------------


@registered
def ts_delta_encode(spark, sf):
    events = views.log_disordered(spark, sf).drop("message")
    return timestamps.delta_encode(events, timestamps.reference_timestamps(events))


@registered
def ts_delta_restore(spark, sf):
    events = views.log_disordered(spark, sf)
    # Small blocks, so that every carry level is used also on small tables.
    deltas = timestamps.delta_encode(events, LOWER, bits=6)
    return timestamps.delta_restore(deltas, LOWER, bits=6)


@registered
def local_time_render(spark, sf):
    streams = metadata.parse_metadata(views.streams_raw(spark, sf))
    rows = metadata.with_local_time(views.log_events(spark, sf), streams, [PATTERN])
    return rows.select(*S.EVENT_KEY, "tz_id", "local_time", "zone_known")


@registered
def local_time_parse(spark, sf):
    streams = metadata.parse_metadata(views.streams_raw(spark, sf))
    rows = metadata.with_stream_info(views.log_events(spark, sf), streams)
    zone, pattern = F.col("tz_id"), F.col("ts_pattern")
    local = render_local(F.col("ts_ms"), zone, pattern, [PATTERN])
    return rows.select(
        *S.EVENT_KEY,
        usable_zone(zone).alias("zone"),
        local.alias("local_time"),
        parse_local(local, zone, pattern, [PATTERN]).alias("parsed_ms"),
    )


# --- quality -----------------------------------------------------------------------


@registered
def stream_status(spark, sf):
    """Event streams have gaps; a conversation is closed when the assistant had the last word."""
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    conv_streams = conv.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"))
    events, talks = views.log_events(spark, sf), views.log_conv(spark, sf)
    streams = conv_streams.select(
        (-F.col("conv_id") - 1).alias("stream_id"), (F.col("last_role") == "assistant").alias("closed")
    ).unionByName(events.select("stream_id", F.lit(True).alias("closed")).distinct())
    rows = events.unionByName(talks.withColumn("stream_id", -F.col("stream_id") - 1))
    return quality.stream_status(rows, streams)


@registered
def search_outcome(spark, sf):
    return quality.search_outcome(views.log_events(spark, sf), ["*error*code1? *"], LOWER, UPPER)


# --- pruned search -----------------------------------------------------------------


@registered
def search_encoded(spark, sf):
    path = scratch_path(spark, "encoded")
    log_tables.write_log(views.log_events(spark, sf), path, width=8)
    return pruned.search_log(spark, path, ["*error*code1? *"], LOWER, UPPER)


@registered
def search_encoded_docs(spark, sf):
    path = scratch_path(spark, "encoded-docs")
    log_tables.write_log(views.log_docs(spark, sf), path)
    return pruned.search_log(spark, path, [WildcardQuery("*THE*of*", False), WildcardQuery("*1?3*")])


@registered
def search_encoded_edges(spark, sf):
    """Times at every edge, also ones that no calendar holds; the reader is in another zone."""
    edges = [-1, 0, 1, 253402300800000, S.MAX_TS - 1, S.MAX_TS]
    at = F.element_at(F.array(*[F.lit(e) for e in edges]), (F.col("seq") % 12 + 1).cast("int"))
    events = views.log_events(spark, sf).withColumn("ts_ms", F.when(F.col("seq") % 12 < 6, at).otherwise(F.col("ts_ms")))
    path = scratch_path(spark, "encoded-edges")
    log_tables.write_log(events, path, width=8)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        return pruned.search_log(spark, path, ["*error*"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@registered
def stream_status_stored(spark, sf):
    """Dense event streams in two chunks; one in five streams is closed later, one in seven lacks a row."""
    events = views.log_events(spark, sf)
    dense = events.withColumn("seq", F.row_number().over(Window.partitionBy("stream_id").orderBy("seq")).cast("bigint") - 1)
    path = scratch_path(spark, "status")
    whole = dense.filter((F.col("stream_id") % 7 != 0) | (F.col("seq") != 1))
    log_tables.write_log(whole.filter("seq < 4"), path, chunk=0, closed=False)
    log_tables.write_log(whole.filter("seq >= 4 and stream_id % 5 <> 0"), path, chunk=1, closed=True)
    fifth = whole.filter("stream_id % 5 = 0").select("stream_id")
    log_tables.close_log(spark, path, fifth.filter("stream_id % 2 = 0"))
    stored = log_tables.read_log(spark, path)
    return quality.stream_status(stored, log_tables.stream_ends(spark, path))


@registered
def search_outcome_all_streams(spark, sf):
    """As ``search_outcome``, with streams that hold no event: one closed, one not."""
    events = views.log_events(spark, sf)
    named = events.select("stream_id", F.lit(True).alias("closed")).distinct()
    empty = events.agg(F.max("stream_id").alias("top")).select(F.explode(F.expr("array(struct(top + 1 as stream_id, true as closed), struct(top + 2 as stream_id, false as closed))")).alias("s")).select("s.*")
    return quality.search_outcome(events, ["*error*code1? *"], LOWER, UPPER, named.unionByName(empty))


@registered
def wildcard_nocase_unicode(spark, sf):
    """Every message of a log with letters of odd case matches itself and its capitals without case."""
    odd = F.element_at(F.array(*[F.lit(x) for x in ("ΟΔΟΣ", "οδος", "xΣ", "straße", "Ärger", "ÉCOLE")]), (F.col("seq") % 6 + 1).cast("int"))
    events = views.log_docs(spark, sf).withColumn("message", F.concat(odd, F.lit(" "), F.col("message")))
    return search.search(events, [WildcardQuery(q, False) for q in ("*ΟΔΟΣ*", "Xς*", "*STRAßE*", "ärger*", "école *")])


@registered
def wildcard_nocase_unicode_whole(spark, sf):
    """As ``wildcard_nocase_unicode``, on whole messages between letters of odd case."""
    odd = F.element_at(F.array(*[F.lit(x) for x in ("ΟΔΟΣ", "οδος", "xΣ", "straße", "Ärger", "ÉCOLE")]), (F.col("seq") % 6 + 1).cast("int"))
    events = views.log_docs(spark, sf).withColumn("message", F.concat(odd, F.lit(" "), F.col("message"), F.lit(" "), odd))
    return search.search(events, [WildcardQuery(q, False) for q in ("*ΟΔΟΣ", "Xς*", "*STRAßE", "*ärger", "école *")])


@registered
def local_time_zones(spark, sf):
    """Short zone names and offsets next to regional and unknown ones."""
    zones = F.array(*[F.lit(z) for z in ("CET", "+05:30", "Japan", "America/Toronto", "Mars/Olympus", "")])
    events = views.log_events(spark, sf).withColumn("tz_id", F.element_at(zones, (F.col("stream_id") % 6 + 1).cast("int")))
    return events.select(
        *S.EVENT_KEY, "tz_id", usable_zone(F.col("tz_id")).alias("zone"), render_local(F.col("ts_ms"), F.col("tz_id"), PATTERN).alias("local_time")
    )


@registered
def codec_errors(spark, sf):
    """Null messages and damaged rows keep their place and carry a status."""
    events = views.log_conv(spark, sf)
    damaged = events.withColumn("message", F.when(F.col("seq") % 3 != 1, F.col("message")))
    encoded = encoding.encode_log(damaged)
    broken = encoded.withColumn("logtype", F.when(F.col("seq") % 3 == 2, F.concat("logtype", F.lit("<i>"))).otherwise(F.col("logtype")))
    decoded = encoding.decode_log(broken.drop("status"))
    return decoded.join(encoded.select(*S.EVENT_KEY, F.col("status").alias("encode_status")), S.EVENT_KEY).select(*S.EVENT_KEY, "encode_status", "status")


# --- stored logs: commits, zones, cursors ------------------------------------------


def _in_two_chunks(spark, events: DataFrame, label: str, width: int = 8) -> str:
    """A log of two chunks, cut at a time: streams whose time runs backwards have overlapping chunks."""
    path = scratch_path(spark, label)
    log_tables.write_log(events.filter(F.col("ts_ms") < LOWER + 5 * 86_400_000), path, width, chunk=0, closed=False)
    log_tables.write_log(events.filter(F.col("ts_ms") >= LOWER + 5 * 86_400_000), path, width, chunk=1)
    return path


@registered
def stored_commits(spark, sf):
    """What readers see: before and after a write that stopped without its commit, after its retry, and of the past."""
    events = views.log_events(spark, sf)
    path = scratch_path(spark, "commits")
    old, new = events.filter(F.col("ts_ms") < LOWER), events.filter(F.col("ts_ms") >= LOWER)
    base = log_tables.write_log(old, path, width=8, closed=False)
    header = {"ts_pattern": "", "ts_pattern_syntax": "", "tz_id": "UTC"}
    log_tables.write_chunk(new, path, base, 1, 8, header)  # all tables are there, but no commit
    stopped = log_tables.read_log(spark, path)
    done = log_tables.write_log(new, path, width=8, chunk=1)
    seen = {"stopped": stopped, "done": log_tables.read_log(spark, path), "past": log_tables.read_log(spark, path, done.version - 1)}
    parts = [rows.drop("status").withColumn("state", F.lit(name)) for name, rows in seen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registered
def stored_seek(spark, sf):
    return stored.seek_stored(spark, _in_two_chunks(spark, views.log_disordered(spark, sf), "seek"), LOWER)


@registered
def stored_read_from(spark, sf):
    return stored.read_from_stored(spark, _in_two_chunks(spark, views.log_disordered(spark, sf), "read", 4), UPPER)


@registered
def stored_early_stop(spark, sf):
    path = _in_two_chunks(spark, views.log_disordered(spark, sf), "stop", 4)
    return stored.early_stop_stored(spark, path, ["*error*"], LOWER, UPPER)


def _first_errors(events: DataFrame) -> DataFrame:
    return search.contains(events, "error").groupBy("stream_id").agg(F.min("seq").alias("after_seq"))


@registered
def stored_next_match(spark, sf):
    events = views.log_events(spark, sf)
    path = _in_two_chunks(spark, events, "next")
    return stored.next_match_stored(spark, path, ["*purchase*", "*signup*"], _first_errors(events))


@registered
def stored_first_k(spark, sf):
    path = _in_two_chunks(spark, views.log_disordered(spark, sf), "first-k", 4)
    return stored.first_k_stored(spark, path, lambda e: search.search(e, ERROR_THEN_PURCHASE), 3)


@registered
def stored_contains(spark, sf):
    """The next event of each stream that contains, begins with or ends with a text, or for which a function holds."""
    path = _in_two_chunks(spark, views.log_disordered(spark, sf), "contains")
    message = F.col("message")
    tests = {
        "contains": F.contains(message, F.lit("code13")),
        "prefix": F.startswith(message, F.lit("user=12")),
        "suffix": F.endswith(message, F.lit('"k": 7}')),
        "function": lambda ts, msg: (msg.str.len() % 7 == 3) & (ts % 2 == 0),
    }
    parts = [stored.next_where_stored(spark, path, t).withColumn("test", F.lit(name)) for name, t in tests.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@registered
def stored_var_lookup(spark, sf):
    """All events that hold the user id of the last event as a variable, and all that hold a string variable."""
    events = views.log_events(spark, sf)
    path = scratch_path(spark, "lookup")
    log_tables.write_log(events, path, width=8)
    user = events.agg(F.max_by("stream_id", "seq")).first()[0]
    found = {"user": stored.lookup_variable(spark, path, str(user)), "code": stored.lookup_variable(spark, path, "code16")}
    parts = [rows.withColumn("value", F.lit(name)) for name, rows in found.items()]
    return parts[0].unionByName(parts[1])


@registered
def stored_audit(spark, sf):
    return log_tables.audit_log(spark, _in_two_chunks(spark, views.log_events(spark, sf), "audit", 4))


@registered
def stored_headers_roundtrip(spark, sf):
    """Streams with headers of their own, as parsed from metadata, and the defaults of the writer for the others."""
    events = views.log_events(spark, sf)
    heads = metadata.parse_metadata(views.streams_raw(spark, sf)).filter(F.col("status") == S.SUCCESS)
    path = scratch_path(spark, "headers")
    log_tables.write_log(
        events, path, width=4, tz_id="Asia/Tokyo", ts_pattern="HH:mm", ts_pattern_syntax="plain",
        references=heads.filter("width = 4").select("stream_id", "reference_ts"), streams=heads,
    )
    stored_heads = log_tables.read_streams(spark, path)
    counts = log_tables.read_log(spark, path).groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_read"), F.min("ts_ms").alias("first_ts"))
    kept = ["stream_id", "ts_pattern", "ts_pattern_syntax", "tz_id", "reference_ts", "n_events", "n_read", "first_ts"]
    return stored_heads.join(counts, "stream_id").select(*kept)


def _edge_times(spark, sf) -> DataFrame:
    """Events of which every second has a time at some edge, the smallest and largest 64-bit ones among them."""
    edges = [-(2**63), -5, -1, 0, 1, 253402300800000, S.MAX_TS - 1, S.MAX_TS]
    at = F.element_at(F.array(*[F.lit(e) for e in edges]), (F.col("seq") % 16 + 1).cast("int"))
    return views.log_events(spark, sf).withColumn("ts_ms", F.when(F.col("seq") % 16 < 8, at).otherwise(F.col("ts_ms")))


@registered
def stored_time_edges(spark, sf):
    parts = []
    for width in (4, 8):
        path = scratch_path(spark, f"edges{width}")
        log_tables.write_log(_edge_times(spark, sf), path, width=width)
        parts.append(log_tables.read_log(spark, path).withColumn("width", F.lit(width)))
        parts.append(pruned.search_log(spark, path, ["*error*"]).withColumnRenamed("idx", "width").withColumns({"status": F.lit("found"), "width": F.lit(width)}))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@registered
def local_time_edges(spark, sf):
    """Local time where a calendar has it, else null."""
    events = _edge_times(spark, sf).filter(~F.col("ts_ms").isin(-5, 253402300800000))
    return events.select(*S.EVENT_KEY, render_local(F.col("ts_ms"), F.lit("Asia/Kolkata"), PATTERN).alias("local_time"))


# --- queries that are data ---------------------------------------------------------


def _pairs(spark, sf) -> DataFrame:
    """Every event with a query made from another column of its row; one in three differs in case only."""
    parts = F.split("message", " ")
    event_type, n = F.get(parts, F.lit(1)), F.col("seq") % 6
    query = (
        F.when(n == 0, F.concat(F.lit("*"), event_type, F.lit(" took ??.*")))
        .when(n == 1, F.concat(F.lit("user=*"), F.upper(event_type), F.lit("*")))
        .when(n == 2, F.concat(F.lit(r"*\{*\k*"), (F.col("seq") % 10).cast("string"), F.lit("}")))
        .when(n == 3, F.lit(r"*\*"))
        .when(n == 4, F.concat(F.lit("**code1?*"), event_type, F.lit("*")))
        .otherwise(F.concat(F.lit("USER=*code*? *"), F.lit("}")))
    )
    return views.log_events(spark, sf).withColumns({"query": query, "case_sensitive": F.col("seq") % 4 < 2})


@registered
def wildcard_match_columns(spark, sf):
    """By a side table of the distinct queries, and by the SQL function."""
    pairs = _pairs(spark, sf)
    pattern_columns.register_sql(spark)
    by_table = pattern_columns.match_columns(pairs, "message", "query", "case_sensitive")
    by_sql = by_table.withColumn(
        "by_sql",
        F.expr("if(case_sensitive, wildcard_query_match(message, query), wildcard_query_match_nocase(message, query))"),
    )
    return by_sql.select(*S.EVENT_KEY, "query", "case_sensitive", "matches", "by_sql")


@registered
def query_table_long(spark, sf):
    """A query table of some thousand queries, with escapes, without plain texts and of one letter among them."""
    events = views.log_events(spark, sf)
    rare = events.filter("seq % 40 = 0").select(
        F.concat(F.lit("user="), F.col("stream_id").cast("string"), F.lit(" *took "), F.regexp_extract("message", r"took (\S+)", 1), F.lit("*")).alias("query"),
        (F.col("seq") % 80 == 0).alias("case_sensitive"),
    )
    odd = spark.createDataFrame([(r"*\z?q*", True), ("*Z?Q*", False), ("?", True), ("", True), (r"*\?*", True), ("*~*", True), (r"*\{\}", False)], "query string, case_sensitive boolean")
    table = rare.unionByName(odd).distinct()
    order = F.row_number().over(Window.orderBy("query", "case_sensitive")) - 1
    return search.search_query_table(events, table.withColumn("idx", order.cast("int")))


# --- streaming ---------------------------------------------------------------------


def _arriving(spark, rows: DataFrame, start, slices: int = 3) -> tuple[str, str]:
    """Write ``rows`` in ``seq`` order as ``slices`` arrivals; run the job after each.

    Each run picks up the checkpoint of the one before, as a restarted job would. Gives the
    folders of the arrivals and of the checkpoint.
    """
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "offsets")
    lo, hi = rows.agg(F.min("seq"), F.max("seq")).first()
    step = (hi - lo) // slices + 1
    for i in range(slices):
        part = rows.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.write.mode("append").parquet(inbox)
        source = spark.readStream.schema(rows.schema).parquet(inbox)
        start(source, checkpoint).awaitTermination()
    return inbox, checkpoint


@registered
def stream_search(spark, sf):
    out = scratch_path(spark, "stream-search")
    _arriving(
        spark,
        views.log_events(spark, sf),
        lambda source, ckpt: jobs.start_search(source, ERROR_THEN_PURCHASE, out, ckpt, LOWER, UPPER),
    )
    return spark.read.parquet(out)


@registered
def stream_ts_restore(spark, sf):
    out = scratch_path(spark, "stream-restore")
    events = views.log_disordered(spark, sf)
    references = timestamps.reference_timestamps(events)
    deltas = timestamps.delta_encode(events, references)
    _arriving(spark, deltas, lambda source, ckpt: jobs.start_restore(source, references, out, ckpt))
    return spark.read.parquet(f"{out}/events").drop("epoch")


@registered
def stream_early_stop(spark, sf):
    out = scratch_path(spark, "stream-stop")
    _arriving(
        spark,
        views.log_disordered(spark, sf),
        lambda source, ckpt: jobs.start_early_stop_search(source, ["*error*"], LOWER, UPPER, out, ckpt),
    )
    return spark.read.parquet(f"{out}/events").drop("epoch")


@registered
def stream_encode_append(spark, sf):
    path = scratch_path(spark, "stream-encode")
    _arriving(
        spark, views.log_events(spark, sf), lambda source, ckpt: jobs.start_encode_append(source, path, ckpt)
    )
    return log_tables.read_log(spark, path)


@registered
def stream_outcome(spark, sf):
    """As ``search_outcome_all_streams``, on arriving rows; one stream in three is never closed and falls silent."""
    events = views.log_events(spark, sf)
    out, notices = scratch_path(spark, "stream-outcome"), scratch_path(spark, "notices")
    top = events.agg(F.max("stream_id").alias("top"))
    empty = top.select(F.explode(F.expr("sequence(top + 1, top + 3)")).alias("stream_id"))
    ids = events.select("stream_id").distinct().unionByName(empty)
    heads = ids.select("stream_id", F.lit(False).alias("closed"))
    heads.write.parquet(notices)

    def start(silent_ms):
        def job(source, ckpt):
            ends = spark.readStream.schema(heads.schema).parquet(notices)
            return start_outcome(source, ["*error*code1? *"], LOWER, UPPER, out, ckpt, silent_ms, ends)

        return job

    # Nothing counts as silent while events arrive; then two in three streams are closed, and the others wait for a timer.
    inbox, checkpoint = _arriving(spark, events, start(3_600_000))
    heads.withColumn("closed", F.col("stream_id") % 3 != 0).write.mode("append").parquet(notices)
    for _ in range(2):
        start(1)(spark.readStream.schema(events.schema).parquet(inbox), checkpoint).awaitTermination()
        heads.limit(0).coalesce(1).write.mode("append").parquet(notices)  # the time of the next batch
    return spark.read.parquet(out)
