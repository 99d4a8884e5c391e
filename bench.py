"""Time the headline queries at ``$BENCH_SF_DIR`` and print one JSON line.

Sources are the raw tables, and log tables stored beforehand (not timed). Every query
runs warm into the ``noop`` sink; the median of the runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logloom.functions.glob import WildcardQuery  # noqa: E402
from logloom.operators import cursor, encoding, pruned, quality, search, timestamps  # noqa: E402
from logloom.operators import stored as stored_log  # noqa: E402
from logloom.registry import ERROR_THEN_PURCHASE, LOWER, QUERIES, UPPER  # noqa: E402
from logloom.session import local_session, scratch_path  # noqa: E402
from logloom.sources import log_tables, views  # noqa: E402


def folder_bytes(path: str) -> int:
    local = path.removeprefix("file:")
    return sum(
        os.path.getsize(os.path.join(root, name))
        for root, _, names in os.walk(local)
        for name in names
        if name.endswith(".parquet")
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "16g"))

    stored = {}
    for name in ("log_events", "log_disordered", "log_docs"):
        path = scratch_path(spark, f"bench-{name}")
        view = getattr(views, name)(spark, sf_dir)
        view.repartitionByRange(int(cpus), "seq").sortWithinPartitions("stream_id", "seq").write.option(
            "compression", "zstd"
        ).parquet(path)
        stored[name] = (path, spark.read.parquet(path))
    events, disordered, docs = (stored[n][1] for n in ("log_events", "log_disordered", "log_docs"))
    encoded = {}
    for name, width in (("log_events", 8), ("log_docs", 8)):
        encoded[name] = scratch_path(spark, f"bench-encoded-{name}")
        log_tables.write_log(stored[name][1], encoded[name], width=width)

    one = [WildcardQuery("*error*code1? *")]
    doc_queries = [
        WildcardQuery("*license*", False),
        WildcardQuery("*@*.*"),
        WildcardQuery("*the*of*and*"),
        WildcardQuery("*é?e*"),
    ]
    cases = {
        "time_interval_wildcard": lambda: search.search(events, one, LOWER, UPPER),
        "multi_query_first_match": lambda: search.search(events, ERROR_THEN_PURCHASE, LOWER, UPPER),
        "multi_query_first_match_docs": lambda: search.search(docs, doc_queries),
        "query_table_join": lambda: search.search_query_table(events, query_table),
        "time_interval_early_stop": lambda: search.search(disordered, ["*error*"], LOWER, UPPER, stop_at_upper=True),
        "seek_epoch": lambda: cursor.seek(disordered, LOWER),
        "next_match": lambda: cursor.next_match(events, ["*purchase*"]),
        "first_k_matches": lambda: cursor.first_k_matches(events, ERROR_THEN_PURCHASE, 3),
        "encode_events": lambda: encoding.encode_log(events),
        "encode_docs": lambda: encoding.encode_log(docs),
        "decode_events": lambda: log_tables.read_log(spark, encoded["log_events"]),
        "decode_docs": lambda: log_tables.read_log(spark, encoded["log_docs"]),
        "logtype_dictionary": lambda: encoding.logtype_dictionary(encoding.encode_log(events)),
        "var_dictionary": lambda: encoding.var_dictionary(encoding.encode_log(events)),
        "ts_delta_encode": lambda: timestamps.delta_encode(disordered),
        "search_encoded": lambda: pruned.search_log(spark, encoded["log_events"], one, LOWER, UPPER),
        "search_encoded_docs": lambda: pruned.search_log(spark, encoded["log_docs"], doc_queries),
        "stored_seek": lambda: stored_log.seek_stored(spark, encoded["log_events"], LOWER),
        "stored_next_match": lambda: stored_log.next_match_stored(spark, encoded["log_events"], ["*purchase*"]),
        "stored_lookup": lambda: stored_log.lookup_variable(spark, encoded["log_events"], "77"),
        "search_outcome": lambda: quality.search_outcome(events, one, LOWER, UPPER),
        "roundtrip_audit_events": lambda: quality.roundtrip_audit(events, 8),
        "roundtrip_audit_docs": lambda: quality.roundtrip_audit(docs, 4),
        "local_time_render": lambda: QUERIES["local_time_render"](spark, sf_dir),
    }
    query_table = views.query_table(spark, sf_dir)

    seconds = {}
    for name, build in cases.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    # Writers are timed once each: they store their result instead of a noop sink.
    for name, width in (("write_log_w8", 8), ("write_log_w4", 4)):
        start = time.perf_counter()
        log_tables.write_log(events, scratch_path(spark, "bench-write"), width=width)
        seconds[name] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "stored_bytes": {
                    name: {"plain": folder_bytes(stored[name][0]), "encoded": folder_bytes(path)}
                    for name, path in encoded.items()
                },
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
