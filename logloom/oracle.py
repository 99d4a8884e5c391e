"""Expected results of the registered queries, as SQL over the same tables.

The statements are written independently of the Spark plans: they cut messages into
single segments, rank and sum with plain windows, and match with LIKE.
"""

from __future__ import annotations

LOWER, UPPER = 1704412800000, 1705708800000

_MESSAGE = (
    "concat('user=', user_id, ' action=', event_type, ' took ', CAST(value AS VARCHAR), ' ms, code', "
    "event_id % 17, ' ', event_id % 5, ' ', props)"
)

_VIEWS = {
    "log_events": f"""log_events AS (
  SELECT user_id AS stream_id, event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, {_MESSAGE} AS message
  FROM events)""",
    "log_disordered": f"""log_disordered AS (
  SELECT user_id % 8 AS stream_id, event_id - event_id % 1024 + ((event_id % 1024) * 7919) % 1024 AS seq, epoch_us(ts) // 1000 AS ts_ms,
         {_MESSAGE} AS message
  FROM events)""",
    "log_docs": """log_docs AS (
  SELECT TRY_CAST(substr(source, 4, 20) AS BIGINT) AS stream_id, doc_id AS seq, CAST(0 AS BIGINT) AS ts_ms,
         text AS message
  FROM documents)""",
    "log_conv": """log_conv AS (
  SELECT conv_id AS stream_id, turn AS seq, turn * 1000 AS ts_ms, text AS message FROM conversations)""",
    "streams_raw": """streams_raw AS (
  SELECT stream_id, CAST(CASE WHEN stream_id % 2 = 0 THEN 4 ELSE 8 END AS INTEGER) AS width,
         CASE WHEN stream_id % 11 = 0 THEN 2 ELSE 1 END AS metadata_type,
         CASE stream_id % 9
           WHEN 0 THEN '{}'
           WHEN 1 THEN '{"TZ_ID":"Asia/Kolkata"}'
           WHEN 2 THEN 'not json'
           WHEN 3 THEN '{"REFERENCE_TIMESTAMP":"abc","TZ_ID":"Mars/Olympus"}'
           WHEN 4 THEN '{"REFERENCE_TIMESTAMP":12345,"TIMESTAMP_PATTERN":7}'
           WHEN 5 THEN '[1]'
           WHEN 6 THEN ''
           ELSE concat('{"REFERENCE_TIMESTAMP":"', min(ts_ms),
                       '","TIMESTAMP_PATTERN":"yyyy-MM-dd HH:mm:ss,SSS",',
                       '"TIMESTAMP_PATTERN_SYNTAX":"java::SimpleDateFormat","TZ_ID":"America/Toronto"}')
         END AS metadata
  FROM log_events GROUP BY stream_id)""",
    "streams": """checked AS (
  SELECT *, CASE WHEN metadata = '' THEN 'IncompleteIr'
                 WHEN metadata_type <> 1 THEN 'UnsupportedVersion'
                 WHEN NOT json_valid(metadata) THEN 'CorruptedIr'
                 WHEN json_type(CASE WHEN json_valid(metadata) THEN metadata END) NOT IN ('OBJECT', 'NULL')
                   THEN 'CorruptedIr'
                 ELSE 'Success' END AS status
  FROM streams_raw),
good AS (SELECT *, CAST(CASE WHEN status = 'Success' THEN metadata ELSE '{}' END AS JSON) AS j FROM checked),
fields AS (
  SELECT stream_id, width, status,
    CASE WHEN json_type(j, '$.TIMESTAMP_PATTERN') = 'VARCHAR'
         THEN json_extract_string(j, '$.TIMESTAMP_PATTERN') ELSE '' END AS ts_pattern,
    CASE WHEN json_type(j, '$.TIMESTAMP_PATTERN_SYNTAX') = 'VARCHAR'
         THEN json_extract_string(j, '$.TIMESTAMP_PATTERN_SYNTAX') ELSE '' END AS ts_pattern_syntax,
    CASE WHEN json_type(j, '$.TZ_ID') = 'VARCHAR' THEN json_extract_string(j, '$.TZ_ID') ELSE '' END AS tz_id,
    CASE WHEN json_type(j, '$.REFERENCE_TIMESTAMP') = 'VARCHAR'
         THEN TRY_CAST(json_extract_string(j, '$.REFERENCE_TIMESTAMP') AS BIGINT) END AS ref
  FROM good),
streams AS (
  SELECT stream_id, ts_pattern, ts_pattern_syntax, tz_id,
         CASE WHEN width = 4 THEN coalesce(ref, 0) ELSE 0 END AS reference_ts, width, status
  FROM fields)""",
    "query_table": """query_table AS (
  SELECT CAST(row_number() OVER (ORDER BY query) - 1 AS INTEGER) AS idx, query, case_sensitive
  FROM (SELECT DISTINCT
          CASE WHEN (event_id % 17) % 3 = 0
               THEN concat('*action=', event_type, '*"k": ', event_id % 17, '?}*')
               ELSE concat('*ACTION=', upper(event_type), '*CODE', event_id % 17, ' *') END AS query,
          (event_id % 17) % 3 = 0 AS case_sensitive
        FROM events))""",
}


def _with(*views: str, rest: str) -> str:
    return "WITH " + ",\n".join(_VIEWS.get(v, v) for v in views) + "\n" + rest


def _search(view: str, case: str, where: str = "TRUE") -> str:
    rest = f"""SELECT * FROM (
  SELECT stream_id, seq, ts_ms, message, CAST({case} AS INTEGER) AS idx
  FROM {view} WHERE ts_ms >= 0 AND ts_ms < 9223372036854775807 AND {where})
WHERE idx IS NOT NULL"""
    return _with(view, rest=rest)


def _like(pattern: str, idx: int = 0, column: str = "message") -> str:
    quoted = pattern.replace("'", "''")
    return f"WHEN {column} LIKE '{quoted}' ESCAPE '^' THEN {idx}"


def _case(*branches: str) -> str:
    return "CASE " + " ".join(branches) + " END"


_IN_TIME = f"ts_ms >= {LOWER} AND ts_ms < {UPPER}"
_ERROR_THEN_PURCHASE = _case(_like("%error%", 0), _like("%purchase%", 1))


def _segments(view: str, width: int) -> str:
    """CTEs ``seg`` (typed segments of every message) and ``lt`` (log types)."""
    whole = r"'^(0|-?[1-9][0-9]{0,17})$'"
    decimal = r"'^-?(0|[1-9][0-9]{0,7})\.[0-9]{1,8}$'"
    int_ok = "TRUE" if width == 8 else "TRY_CAST(tok AS BIGINT) BETWEEN -2147483648 AND 2147483647"
    dec_ok = (
        "TRUE" if width == 8 else "TRY_CAST(replace(tok, '.', '') AS BIGINT) BETWEEN -2147483648 AND 2147483647"
    )
    return rf"""parts AS (
  SELECT stream_id, seq, regexp_extract_all(message, '([A-Za-z0-9+\-._\\]+|[^A-Za-z0-9+\-._\\]+)') AS s
  FROM {view}),
flat AS (
  SELECT stream_id, seq, unnest(range(1, len(s) + 1)) AS pos, unnest(s) AS tok,
         unnest(list_prepend('', s[1:len(s) - 1])) AS prev
  FROM parts),
seg AS (
  SELECT stream_id, seq, pos, tok,
    CASE WHEN regexp_matches(tok, '[^A-Za-z0-9+\-._\\]') THEN NULL
         WHEN regexp_matches(tok, {whole}) AND {int_ok} THEN 'i'
         WHEN regexp_matches(tok, {decimal}) AND NOT regexp_matches(tok, '^-0\.0+$') AND {dec_ok} THEN 'f'
         WHEN regexp_matches(tok, '[0-9]') THEN 'd'
         WHEN prev LIKE '%=' AND regexp_matches(tok, '[A-Za-z]') THEN 'd' END AS k
  FROM flat),
lt AS (
  SELECT stream_id, seq,
         string_agg(CASE WHEN k IS NOT NULL THEN '<' || k || '>'
                         ELSE replace(replace(tok, '&', '&amp;'), '<', '&lt;') END, '' ORDER BY pos) AS logtype
  FROM seg GROUP BY stream_id, seq)"""


_VARS = """SELECT stream_id, seq,
  CAST(row_number() OVER (PARTITION BY stream_id, seq ORDER BY pos) - 1 AS INTEGER) AS pos, k,
  CASE WHEN k = 'i' THEN CAST(tok AS BIGINT)
       WHEN k = 'f' THEN CAST(replace(tok, '.', '') AS BIGINT) END AS num,
  CASE WHEN k = 'f' THEN CAST(length(tok) - instr(tok, '.') AS INTEGER) END AS scale,
  CASE WHEN k = 'd' THEN tok END AS dict
FROM seg WHERE k IS NOT NULL"""

_DICT_VARS = """SELECT stream_id, seq,
  CAST(row_number() OVER (PARTITION BY stream_id, seq ORDER BY pos) - 1 AS INTEGER) AS pos, tok AS value
FROM seg WHERE k = 'd'"""

_LOGTYPE_DICT = """SELECT row_number() OVER (ORDER BY logtype) - 1 AS logtype_id, logtype, n
FROM (SELECT logtype, count(*) AS n FROM lt GROUP BY logtype)"""

_VAR_DICT = """SELECT row_number() OVER (ORDER BY value) - 1 AS var_id, value, n
FROM (SELECT tok AS value, count(*) AS n FROM seg WHERE k = 'd' GROUP BY tok)"""


def _logtypes(view: str, width: int) -> str:
    return _with(
        view, _segments(view, width), rest="SELECT stream_id, seq, logtype, 'Success' AS status FROM lt"
    )


_DECODED = "SELECT stream_id, seq, ts_ms, message, 'Success' AS status FROM "

_ZONE = "CASE WHEN tz_id IN ('America/Toronto', 'Asia/Kolkata') THEN tz_id ELSE 'UTC' END"
_LOCAL_TEXT = """CASE WHEN ts_pattern = ''
         THEN strftime(timezone(zone, make_timestamptz(ts_ms * 1000)), '%Y-%m-%dT%H:%M:%S.%g')
         ELSE strftime(timezone(zone, make_timestamptz(ts_ms * 1000)), '%Y-%m-%d %H:%M:%S,%g') END"""

_EARLY_STOP = f"""SELECT stream_id, seq, ts_ms, message, CAST(0 AS INTEGER) AS idx FROM (
  SELECT *, max(ts_ms) OVER (PARTITION BY stream_id ORDER BY seq) AS high FROM log_disordered)
WHERE high < {UPPER} AND ts_ms >= {LOWER} AND message LIKE '%error%'"""

_INTERVAL_WILDCARD = _search(
    "log_events", _case(_like("%error%code1_ %")), _IN_TIME
)

ORACLE_SQL: dict[str, str] = {
    "scan_events": _with(
        "log_events",
        rest="""SELECT stream_id, seq, ts_ms, message,
  strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS wall_time FROM log_events""",
    ),
    "scan_decode": _with("log_conv", rest=_DECODED + "log_conv"),
    "stream_metadata": _with("log_events", "streams_raw", "streams", rest="SELECT * FROM streams"),
    "events_with_stream_info": _with(
        "log_events",
        "streams_raw",
        "streams",
        rest="""SELECT e.*, s.ts_pattern, s.ts_pattern_syntax, s.tz_id
FROM log_events e LEFT JOIN streams s USING (stream_id)""",
    ),
    "write_read_roundtrip": _with(
        "log_events",
        rest="""SELECT stream_id, seq, ts_ms, message, 'Success' AS status, variant
FROM log_events, (VALUES ('4/zstd'), ('8/none')) v(variant)""",
    ),
    "write_read_roundtrip_docs": _with("log_docs", rest=_DECODED + "log_docs"),
    "append_chunks": _with("log_events", rest="SELECT * FROM log_events"),
    "scan_text": _with("log_events", rest="SELECT row_number() OVER (ORDER BY seq) - 1 AS place, ts_ms, message FROM log_events"),
    "wildcard_star": _search("log_events", _case(_like("user=1%click%code%{%}"))),
    "wildcard_qmark": _search("log_events", _case(_like("%took __._ ms, code_ _%"))),
    "wildcard_escape": _search(
        "log_events", _case(_like("%*%", 0), _like("%?%", 1), _like("%{\"k\": _}", 2))
    ),
    "wildcard_anchored": _search("log_events", _case(_like("user=1_ action=view%"))),
    "wildcard_nocase": _search("log_docs", _case(_like("%the%of%", 0, "lower(message)"))),
    "wildcard_cleanup": _search("log_events", _case(_like("%err%or%"))),
    "multi_query_first_match": _search("log_events", _ERROR_THEN_PURCHASE, _IN_TIME),
    "multi_query_first_match_docs": _search(
        "log_docs",
        _case(
            _like("%license%", 0, "lower(message)"),
            _like("%@%.%", 1),
            _like("%the%of%and%", 2),
            _like("%é_e%", 3),
        ),
    ),
    "multi_query_mixed_case": _search(
        "log_events",
        _case(
            _like("%ACTION=CLICK%", 0),
            _like("%action=click%code1_%", 1, "lower(message)"),
            _like("user=1%signup%", 2, "lower(message)"),
            _like("%took _.__ ms%", 3),
        ),
    ),
    "query_table_join": _with(
        "log_events",
        "query_table",
        rest="""SELECT stream_id, seq, ts_ms, message, min(idx) AS idx
FROM log_events JOIN query_table ON CASE WHEN case_sensitive
  THEN message LIKE replace(replace(query, '*', '%'), '?', '_') ESCAPE '^'
  ELSE lower(message) LIKE lower(replace(replace(query, '*', '%'), '?', '_')) ESCAPE '^' END
GROUP BY stream_id, seq, ts_ms, message""",
    ),
    "empty_query_set": _search("log_events", "0", _IN_TIME),
    "time_interval": _with("log_events", rest=f"SELECT * FROM log_events WHERE {_IN_TIME}"),
    "time_interval_wildcard": _INTERVAL_WILDCARD,
    "time_interval_early_stop": _with("log_disordered", rest=_EARLY_STOP),
    "search_whole_stream": _search("log_disordered", _case(_like("%purchase%"))),
    "contains": _with("log_events", rest="SELECT * FROM log_events WHERE contains(message, 'code13')"),
    "prefix": _with("log_events", rest="SELECT * FROM log_events WHERE starts_with(message, 'user=12')"),
    "suffix": _with("log_events", rest="""SELECT * FROM log_events WHERE ends_with(message, '"k": 7}')"""),
    "predicate_column": _with(
        "log_events", rest="SELECT * FROM log_events WHERE length(message) % 7 = 3 AND ts_ms % 2 = 0"
    ),
    "seek_epoch": _with(
        "log_disordered",
        rest=f"""SELECT * FROM log_disordered WHERE ts_ms >= {LOWER}
QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY seq) = 1""",
    ),
    "next_match_after": _with(
        "log_events",
        rest="""SELECT e.stream_id, e.seq, e.ts_ms, e.message,
  CAST(CASE WHEN message LIKE '%purchase%' THEN 0 ELSE 1 END AS INTEGER) AS idx
FROM log_events e LEFT JOIN (
  SELECT stream_id, min(seq) AS after_seq FROM log_events WHERE contains(message, 'error') GROUP BY stream_id
) c USING (stream_id)
WHERE (after_seq IS NULL OR seq > after_seq) AND ts_ms >= 0
  AND (message LIKE '%purchase%' OR message LIKE '%signup%')
QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY seq) = 1""",
    ),
    "next_where_after": _with(
        "log_events",
        rest="""SELECT e.stream_id, e.seq, e.ts_ms, e.message
FROM log_events e LEFT JOIN (
  SELECT stream_id, min(seq) AS after_seq FROM log_events WHERE contains(message, 'error') GROUP BY stream_id
) c USING (stream_id)
WHERE (after_seq IS NULL OR seq > after_seq) AND ends_with(message, '1}')
QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY seq) = 1""",
    ),
    "first_k_matches": f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS INTEGER) AS rank
  FROM ({_search("log_events", _ERROR_THEN_PURCHASE)})) WHERE rank <= 3""",
    "read_from_epoch": _with(
        "log_disordered",
        rest=f"""SELECT e.* FROM log_disordered e JOIN (
  SELECT stream_id, min(seq) AS first_seq FROM log_disordered WHERE ts_ms >= {UPPER} GROUP BY stream_id
) f USING (stream_id) WHERE seq >= first_seq""",
    ),
    "encode_logtype": _logtypes("log_events", 8),
    "encode_logtype_docs": _logtypes("log_docs", 8),
    "encode_logtype_w4": _logtypes("log_docs", 4),
    "encode_vars_exploded": _with("log_events", _segments("log_events", 8), rest=_VARS),
    "encode_vars_exploded_docs": _with("log_docs", _segments("log_docs", 8), rest=_VARS),
    "encode_vars_exploded_w4": _with("log_docs", _segments("log_docs", 4), rest=_VARS),
    "dict_vars_exploded": _with("log_docs", _segments("log_docs", 8), rest=_DICT_VARS),
    "decode_roundtrip": _with("log_events", rest=_DECODED + "log_events"),
    "decode_roundtrip_docs": _with("log_docs", rest=_DECODED + "log_docs"),
    "logtype_dictionary": _with("log_events", _segments("log_events", 8), rest=_LOGTYPE_DICT),
    "logtype_dictionary_docs": _with("log_docs", _segments("log_docs", 8), rest=_LOGTYPE_DICT),
    "encoded_with_ids": _with(
        "log_events",
        _segments("log_events", 8),
        f"dict AS ({_LOGTYPE_DICT})",
        "vars AS (SELECT stream_id, seq, count(k) AS n FROM seg GROUP BY stream_id, seq)",
        rest="""SELECT e.stream_id, e.seq, e.ts_ms, d.logtype_id, CAST(v.n AS INTEGER) AS n_vars
FROM log_events e JOIN lt USING (stream_id, seq) JOIN dict d USING (logtype)
JOIN vars v USING (stream_id, seq)""",
    ),
    "var_dictionary": _with("log_events", _segments("log_events", 8), rest=_VAR_DICT),
    "var_dictionary_docs": _with("log_docs", _segments("log_docs", 8), rest=_VAR_DICT),
    "roundtrip_audit": _with(
        "log_events",
        "log_docs",
        "log_conv",
        rest="""SELECT log, CAST(width AS INTEGER) AS width, stream_id, count(*) AS n_events,
  CAST(0 AS BIGINT) AS n_lossy, CAST(0 AS BIGINT) AS n_failed
FROM (SELECT 'log_events' AS log, stream_id FROM log_events
      UNION ALL SELECT 'log_docs', stream_id FROM log_docs
      UNION ALL SELECT 'log_conv', stream_id FROM log_conv), (VALUES (8), (4)) w(width)
GROUP BY log, width, stream_id""",
    ),
    "ts_delta_encode": _with(
        "log_disordered",
        rest="""SELECT stream_id, seq, ts_ms - lag(ts_ms, 1, ts_ms) OVER (PARTITION BY stream_id ORDER BY seq)
  AS ts_delta FROM log_disordered""",
    ),
    "ts_delta_restore": _with("log_disordered", rest="SELECT * FROM log_disordered"),
    "local_time_render": _with(
        "log_events",
        "streams_raw",
        "streams",
        rest=f"""SELECT stream_id, seq, tz_id, {_LOCAL_TEXT} AS local_time, zone = tz_id AS zone_known
FROM (SELECT e.stream_id, e.seq, e.ts_ms, s.tz_id, s.ts_pattern, {_ZONE} AS zone
      FROM log_events e JOIN streams s USING (stream_id))""",
    ),
    "local_time_parse": _with(
        "log_events",
        "streams_raw",
        "streams",
        rest=f"""SELECT stream_id, seq, zone, {_LOCAL_TEXT} AS local_time, ts_ms AS parsed_ms
FROM (SELECT e.stream_id, e.seq, e.ts_ms, s.ts_pattern, {_ZONE} AS zone
      FROM log_events e JOIN streams s USING (stream_id))""",
    ),
    "stream_status": _with(
        "log_events",
        "log_conv",
        rest="""SELECT stream_id, n_events, closed,
  CASE WHEN NOT closed THEN 'IncompleteIr' WHEN span <> n_events THEN 'CorruptedIr' ELSE 'Success' END AS status
FROM (
  SELECT stream_id, count(*) AS n_events, max(seq) - min(seq) + 1 AS span, TRUE AS closed
  FROM log_events GROUP BY stream_id
  UNION ALL
  SELECT -conv_id - 1, count(*), max(turn) - min(turn) + 1, arg_max(role, turn) = 'assistant'
  FROM conversations GROUP BY conv_id)""",
    ),
    "search_outcome": _with(
        "log_events",
        rest=f"""SELECT s.stream_id, CASE WHEN hit THEN s.seq END AS seq,
  CASE WHEN hit THEN CAST(0 AS INTEGER) END AS idx,
  CASE WHEN hit THEN 'Success' WHEN cut_seq IS NOT NULL THEN 'QueryNotFound' ELSE 'EndOfIr' END AS status
FROM (
  SELECT a.stream_id, cut_seq, m.seq, m.seq IS NOT NULL AND (cut_seq IS NULL OR m.seq < cut_seq) AS hit
  FROM (SELECT stream_id, min(CASE WHEN ts_ms >= {UPPER} THEN seq END) AS cut_seq
        FROM log_events GROUP BY stream_id) a
  LEFT JOIN (SELECT stream_id, min(seq) AS seq FROM log_events
             WHERE {_IN_TIME} AND message LIKE '%error%code1_ %' GROUP BY stream_id) m USING (stream_id)
) s""",
    ),
    "search_encoded": _INTERVAL_WILDCARD,
    "search_encoded_docs": _search(
        "log_docs", _case(_like("%the%of%", 0, "lower(message)"), _like("%1_3%", 1))
    ),
}
_TABLE_MATCH = """CASE WHEN case_sensitive
  THEN message LIKE replace(replace(query, '*', '%'), '?', '_') ESCAPE '^'
  ELSE lower(message) LIKE lower(replace(replace(query, '*', '%'), '?', '_')) ESCAPE '^' END"""
ORACLE_SQL["query_table_slices"] = _with(
    "log_events",
    "query_table",
    rest=f"""SELECT stream_id, seq, ts_ms, message, idx
FROM (SELECT stream_id, seq, ts_ms, message, min(idx) AS idx, few
      FROM log_events, (VALUES (TRUE), (FALSE)) AS v(few) JOIN query_table ON (NOT few OR idx < 9) AND {_TABLE_MATCH}
      GROUP BY stream_id, seq, ts_ms, message, few),
     (VALUES (1), (2)) AS copies(copy)
WHERE copy = 1 OR seq % 7 = 0""",
)
ORACLE_SQL["search_encoded_edges"] = _with(
    "log_events",
    rest="""SELECT stream_id, seq, ts_ms, message, CAST(0 AS INTEGER) AS idx FROM (
  SELECT stream_id, seq, message, CASE WHEN seq % 12 < 6
    THEN [-1, 0, 1, 253402300800000, 9223372036854775806, 9223372036854775807][seq % 12 + 1] ELSE ts_ms END AS ts_ms
  FROM log_events)
WHERE ts_ms >= 0 AND ts_ms < 9223372036854775807 AND message LIKE '%error%'""",
)
ORACLE_SQL["stream_status_stored"] = _with(
    "log_events",
    rest="""SELECT stream_id, n_events, closed,
  CASE WHEN NOT closed THEN 'IncompleteIr' WHEN span <> n_events THEN 'CorruptedIr' ELSE 'Success' END AS status
FROM (
  SELECT stream_id, count(*) AS n_events, max(place) - min(place) + 1 AS span,
    CASE WHEN stream_id % 5 = 0 THEN stream_id % 2 = 0 ELSE max(place) >= 4 END AS closed
  FROM (SELECT stream_id, row_number() OVER (PARTITION BY stream_id ORDER BY seq) - 1 AS place FROM log_events)
  WHERE (stream_id % 7 <> 0 OR place <> 1) AND (place < 4 OR stream_id % 5 <> 0)
  GROUP BY stream_id)""",
)
ORACLE_SQL["search_outcome_all_streams"] = f"""SELECT * FROM ({ORACLE_SQL["search_outcome"]})
UNION ALL SELECT max(user_id) + 1, NULL, NULL, 'EndOfIr' FROM events
UNION ALL SELECT max(user_id) + 2, NULL, NULL, 'IncompleteIr' FROM events"""
_ODD_CASE = "['ΟΔΟΣ', 'οδος', 'xΣ', 'straße', 'Ärger', 'ÉCOLE'][seq % 6 + 1]"
ORACLE_SQL["wildcard_nocase_unicode"] = _with(
    "log_docs",
    rest=f"""SELECT stream_id, seq, ts_ms, message,
  CAST(CASE WHEN m LIKE '%οδοσ%' THEN 0 WHEN m LIKE 'xσ%' THEN 1 WHEN m LIKE '%straße%' THEN 2
            WHEN m LIKE 'ärger%' THEN 3 WHEN m LIKE 'école %' THEN 4 END AS INTEGER) AS idx
FROM (SELECT *, replace(lower(message), 'ς', 'σ') AS m FROM (
  SELECT stream_id, seq, ts_ms, concat({_ODD_CASE}, ' ', message) AS message FROM log_docs))""",
)
ORACLE_SQL["wildcard_nocase_unicode_whole"] = _with(
    "log_docs",
    rest=f"""SELECT stream_id, seq, ts_ms, message,
  CAST(CASE WHEN m LIKE '%οδοσ' THEN 0 WHEN m LIKE 'xσ%' THEN 1 WHEN m LIKE '%straße' THEN 2
            WHEN m LIKE '%ärger' THEN 3 WHEN m LIKE 'école %' THEN 4 END AS INTEGER) AS idx
FROM (SELECT *, replace(lower(message), 'ς', 'σ') AS m FROM (
  SELECT stream_id, seq, ts_ms, concat({_ODD_CASE}, ' ', message, ' ', {_ODD_CASE}) AS message FROM log_docs))""",
)
ORACLE_SQL["local_time_zones"] = _with(
    "log_events",
    rest="""SELECT stream_id, seq, tz_id, zone,
  strftime(make_timestamp(ts_ms * 1000) + to_hours(h) + to_minutes(m), '%Y-%m-%d %H:%M:%S,%g') AS local_time
FROM log_events JOIN (VALUES (0, 'CET', 'CET', 1, 0), (1, '+05:30', '+05:30', 5, 30), (2, 'Japan', 'Japan', 9, 0),
  (3, 'America/Toronto', 'America/Toronto', -5, 0), (4, 'Mars/Olympus', 'UTC', 0, 0), (5, '', 'UTC', 0, 0)
) AS z(k, tz_id, zone, h, m) ON stream_id % 6 = k""",
)
ORACLE_SQL["codec_errors"] = _with(
    "log_conv",
    rest="""SELECT stream_id, seq, CASE WHEN seq % 3 = 1 THEN 'EncodeError' ELSE 'Success' END AS encode_status,
  CASE WHEN seq % 3 = 0 THEN 'Success' ELSE 'DecodeError' END AS status FROM log_conv""",
)
# Queries with the same result as another one.
ORACLE_SQL["predicate_udf"] = ORACLE_SQL["predicate_column"]
ORACLE_SQL["stream_search"] = ORACLE_SQL["multi_query_first_match"]
ORACLE_SQL["stream_ts_restore"] = ORACLE_SQL["ts_delta_restore"]
ORACLE_SQL["stream_early_stop"] = ORACLE_SQL["time_interval_early_stop"]
ORACLE_SQL["stream_encode_append"] = ORACLE_SQL["decode_roundtrip"]
_NEVER_CLOSED = "CASE WHEN status = 'EndOfIr' AND stream_id % 3 = 0 THEN 'IncompleteIr' ELSE status END AS status"
ORACLE_SQL["stream_outcome"] = f"""SELECT stream_id, seq, idx, {_NEVER_CLOSED} FROM ({ORACLE_SQL["search_outcome"]}
UNION ALL SELECT max(user_id) + n, NULL, NULL, 'EndOfIr' FROM events, (VALUES (1), (2), (3)) AS s(n) GROUP BY n)"""
ORACLE_SQL["stored_commits"] = _with(
    "log_events",
    rest=f"""SELECT stream_id, seq, ts_ms, message, state
FROM log_events, (VALUES ('stopped'), ('done'), ('past')) AS s(state) WHERE state = 'done' OR ts_ms < {LOWER}""",
)
ORACLE_SQL["stored_seek"] = ORACLE_SQL["seek_epoch"]
ORACLE_SQL["stored_read_from"] = ORACLE_SQL["read_from_epoch"]
ORACLE_SQL["stored_early_stop"] = ORACLE_SQL["time_interval_early_stop"]
ORACLE_SQL["stored_next_match"] = ORACLE_SQL["next_match_after"]
ORACLE_SQL["stored_first_k"] = f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS INTEGER) AS rank
  FROM ({_search("log_disordered", _ERROR_THEN_PURCHASE)})) WHERE rank <= 3"""
ORACLE_SQL["stored_contains"] = _with(
    "log_disordered",
    rest="""SELECT stream_id, seq, ts_ms, message, test FROM log_disordered,
  (VALUES ('contains'), ('prefix'), ('suffix'), ('function')) AS t(test)
WHERE CASE test WHEN 'contains' THEN contains(message, 'code13') WHEN 'prefix' THEN starts_with(message, 'user=12')
  WHEN 'suffix' THEN ends_with(message, '"k": 7}') ELSE length(message) % 7 = 3 AND ts_ms % 2 = 0 END
QUALIFY row_number() OVER (PARTITION BY stream_id, test ORDER BY seq) = 1""",
)
ORACLE_SQL["stored_var_lookup"] = _with(
    "log_events",
    _segments("log_events", 8),
    "held AS (SELECT DISTINCT stream_id, seq, k, tok FROM seg WHERE k IN ('i', 'd'))",
    "last AS (SELECT CAST(arg_max(user_id, event_id) AS VARCHAR) AS id FROM events)",
    rest="""SELECT e.*, v.value FROM log_events e JOIN held USING (stream_id, seq), last, (VALUES ('user'), ('code')) AS v(value)
WHERE CASE v.value WHEN 'user' THEN k = 'i' AND tok = id ELSE k = 'd' AND tok = 'code16' END""",
)
ORACLE_SQL["stored_audit"] = _with(
    "log_events",
    rest=f"""SELECT CAST(CASE WHEN ts_ms < {LOWER + 5 * 86_400_000} THEN 0 ELSE 1 END AS BIGINT) AS chunk, stream_id,
  count(*) AS n_events, count(*) AS n_stored, TRUE AS intact
FROM log_events GROUP BY ALL""",
)
ORACLE_SQL["stored_headers_roundtrip"] = _with(
    "log_events",
    "streams_raw",
    "streams",
    rest="""SELECT e.stream_id, coalesce(any_value(s.ts_pattern), 'HH:mm') AS ts_pattern,
  coalesce(any_value(s.ts_pattern_syntax), 'plain') AS ts_pattern_syntax, coalesce(any_value(s.tz_id), 'Asia/Tokyo') AS tz_id,
  coalesce(any_value(CASE WHEN s.width = 4 THEN s.reference_ts END), 0) AS reference_ts,
  count(*) AS n_events, count(*) AS n_read, min(e.ts_ms) AS first_ts
FROM log_events e LEFT JOIN (SELECT * FROM streams WHERE status = 'Success') s USING (stream_id) GROUP BY e.stream_id""",
)
_EDGE_TIMES = """edges AS (
  SELECT stream_id, seq, message, CASE WHEN seq % 16 < 8 THEN
    [-9223372036854775808, -5, -1, 0, 1, 253402300800000, 9223372036854775806, 9223372036854775807][seq % 16 + 1]
    ELSE ts_ms END AS ts_ms
  FROM log_events)"""
ORACLE_SQL["stored_time_edges"] = _with(
    "log_events",
    _EDGE_TIMES,
    rest="""SELECT stream_id, seq, CAST(ts_ms AS BIGINT) AS ts_ms, message, status, CAST(width AS INTEGER) AS width
FROM edges, (VALUES (4), (8)) AS w(width), (VALUES ('Success'), ('found')) AS s(status)
WHERE status = 'Success' OR (ts_ms >= 0 AND ts_ms < 9223372036854775807 AND message LIKE '%error%')""",
)
ORACLE_SQL["local_time_edges"] = _with(
    "log_events",
    _EDGE_TIMES,
    rest="""SELECT stream_id, seq, CASE WHEN abs(CAST(ts_ms AS HUGEINT)) < 9000000000000000000
  THEN strftime(make_timestamp(CAST(ts_ms AS BIGINT) * 1000) + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S,%g') END AS local_time
FROM (SELECT stream_id, seq, CASE WHEN abs(CAST(ts_ms AS HUGEINT)) < 9000000000000000 THEN ts_ms ELSE 9223372036854775807 END AS ts_ms
      FROM edges WHERE ts_ms NOT IN (-5, 253402300800000))""",
)
_PAIRS = r"""pairs AS (
  SELECT *, seq % 4 < 2 AS case_sensitive, split_part(message, ' ', 2) AS kind,
    CASE seq % 6 WHEN 0 THEN concat('*', split_part(message, ' ', 2), ' took ??.*')
      WHEN 1 THEN concat('user=*', upper(split_part(message, ' ', 2)), '*')
      WHEN 2 THEN concat('*\{*\k*', seq % 10, '}') WHEN 3 THEN '*\*'
      WHEN 4 THEN concat('**code1?*', split_part(message, ' ', 2), '*') ELSE 'USER=*code*? *}' END AS query
  FROM log_events),
liked AS (
  SELECT *, CASE seq % 6 WHEN 2 THEN concat('%{%k%', seq % 10, '}') WHEN 3 THEN '%*'
    ELSE replace(replace(query, '*', '%'), '?', '_') END AS p
  FROM pairs)"""
ORACLE_SQL["wildcard_match_columns"] = _with(
    "log_events",
    _PAIRS,
    rest="""SELECT stream_id, seq, query, case_sensitive, hit AS matches, hit AS by_sql FROM (
  SELECT *, CASE WHEN case_sensitive THEN message LIKE p ESCAPE '^' ELSE lower(message) LIKE lower(p) ESCAPE '^' END AS hit
  FROM liked)""",
)
ORACLE_SQL["query_table_long"] = _with(
    "log_events",
    r"""long_table AS (
  SELECT *, CAST(row_number() OVER (ORDER BY query, case_sensitive) - 1 AS INTEGER) AS idx FROM (
    SELECT DISTINCT concat('user=', stream_id, ' *took ', regexp_extract(message, 'took (\S+)', 1), '*') AS query, seq % 80 = 0 AS case_sensitive,
      concat('user=', stream_id, ' %took ', regexp_extract(message, 'took (\S+)', 1), '%') AS p
    FROM log_events WHERE seq % 40 = 0
    UNION ALL SELECT * FROM (VALUES ('*\z?q*', TRUE, '%z_q%'), ('*Z?Q*', FALSE, '%z_q%'), ('?', TRUE, '_'), ('', TRUE, ''),
      ('*\?*', TRUE, '%?%'), ('*~*', TRUE, '%~%'), ('*\{\}', FALSE, '%{}')) AS t))""",
    rest="""SELECT stream_id, seq, ts_ms, message, min(idx) AS idx
FROM log_events JOIN long_table ON CASE WHEN case_sensitive THEN message LIKE p ESCAPE '^' ELSE lower(message) LIKE lower(p) ESCAPE '^' END
GROUP BY stream_id, seq, ts_ms, message""",
)
