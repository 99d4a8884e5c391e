import collections
import random

import pytest
from pyspark.sql import functions as F

from logloom import schema as S
from logloom.functions import pattern_columns
from logloom.functions.glob import WildcardQuery
from logloom.functions.templates import may_match
from logloom.operators import cursor, pruned, quality, search
from logloom.operators.encoding import encode_log
from logloom.session import scratch_path
from logloom.sources.log_tables import read_encoded, write_log
from tests.test_plans import plan_of

EDGE = [(0, i, t, f"m{i}") for i, t in enumerate([-1, 0, 99, 100, 199, 200, S.MAX_TS - 1, S.MAX_TS])]


def seqs(df):
    return sorted(r.seq for r in df.collect())


def read_sequentially(events, matches, lower, upper, after=None):
    """Plain reading of one stream: stop at ``upper``, skip below ``lower``, test the text."""
    found = []
    for stream, seq, ts, msg in sorted(events):
        if ts >= upper:
            return found, S.QUERY_NOT_FOUND
        if ts >= lower and matches(msg):
            found.append(seq)
    return found, S.END_OF_IR


def test_interval_is_half_open(make_events):
    events = make_events(EDGE)
    assert seqs(search.search(events, ["*"], 100, 200)) == [3, 4]
    assert seqs(search.search(events, [], 100, 200)) == [3, 4]


def test_default_interval_leaves_out_negative_and_last_time(make_events):
    assert seqs(search.search(make_events(EDGE), ["*"])) == [1, 2, 3, 4, 5, 6]


def test_early_stop_equals_sequential_reading(make_events):
    rng = random.Random(5)
    rows = [(s, i * 3, rng.randint(0, 120), rng.choice(["error", "ok"])) for s in range(6) for i in range(200)]
    events = make_events(rows)
    for upper in (100, 119, 121):
        want, outcome = [], {}
        for s in range(6):
            found, end = read_sequentially([r for r in rows if r[0] == s], "error".__eq__, 20, upper)
            want += [(s, q) for q in found]
            outcome[s] = (found[0], S.SUCCESS) if found else (None, end)
        got = search.search(events, ["*err*"], 20, upper, stop_at_upper=True)
        assert sorted((r.stream_id, r.seq) for r in got.collect()) == sorted(want)
        report = quality.search_outcome(events, ["*err*"], 20, upper)
        assert {r.stream_id: (r.seq, r.status) for r in report.collect()} == outcome


def test_disordered_stream(make_events):
    events = make_events([(0, i, t, "x") for i, t in enumerate([10, 50, 20, 90, 30, 60])])
    assert seqs(search.search(events, ["x"], 0, 90, stop_at_upper=True)) == [0, 1, 2]
    assert seqs(cursor.seek(events, 40)) == [1]
    assert seqs(cursor.read_from(events, 40)) == [1, 2, 3, 4, 5]
    assert seqs(cursor.seek(events, 91)) == []


def test_next_match_walks_through_all_matches(spark, make_events):
    events = make_events([(s, i, i, "hit" if i % (s + 2) == 0 else "miss") for s in range(3) for i in range(12)])
    cursors, seen = None, []
    while rows := cursor.next_match(events, ["hit"], cursors).collect():
        seen += [(r.stream_id, r.seq) for r in rows]
        at = {r.stream_id: r.seq for r in rows}
        done = [(s, at.get(s, 10**6)) for s in range(3)]
        cursors = spark.createDataFrame(done, "stream_id long, after_seq long")
    assert sorted(seen) == [(s, i) for s in range(3) for i in range(12) if i % (s + 2) == 0]


def test_next_where_takes_columns_and_functions(make_events):
    events = make_events([(0, i, i, f"line {i}") for i in range(9)])
    assert seqs(cursor.next_where(events, F.endswith("message", F.lit("7")))) == [7]
    assert seqs(cursor.next_where(events, lambda ts, msg: ts > 4)) == [5]


@pytest.mark.parametrize(("more", "plain"), [(0, 0), (30, 256), (30, 10)])
def test_query_tables_of_any_length(spark, make_events, monkeypatch, more, plain):
    monkeypatch.setattr(search, "PLAIN_QUERIES", plain)
    events = make_events([(0, i, i, f"a{i % 5}b{i % 3}") for i in range(30)] + [(0, 99, 1, None)])
    queries = [(3, "*A4*", True), (5, "*B1", False), (8, "a?b*", True), (9, "*", True), (11, "a2*", True)]
    queries += [(100 + i, f"*none{i}?x*", i % 2 == 0) for i in range(more)]
    table = spark.createDataFrame(queries, "idx int, query string, case_sensitive boolean")
    got = search.search_query_table(events, table)
    want = search.search(events, [WildcardQuery(q, c) for _, q, c in queries])
    places = {i: q[0] for i, q in enumerate(queries)}
    assert {r.seq: r.idx for r in got.collect()} == {r.seq: places[r.idx] for r in want.collect()}


def test_query_table_needs_unique_places(spark, make_events):
    for rows in ([(1, "a", True), (1, "b", True)], [(None, "a", True)]):
        table = spark.createDataFrame(rows, "idx int, query string, case_sensitive boolean")
        with pytest.raises(ValueError):
            search.search_query_table(make_events(EDGE), table)


def test_equal_event_rows_stay_apart(spark, make_events):
    events = make_events([(0, 1, 5, "x a"), (0, 1, 5, "x a"), (0, 2, 6, "x b")])
    for n in (2, 40):
        table = spark.createDataFrame([(i, "x*" if i == 0 else f"no{i}", True) for i in range(n)], "idx int, query string, case_sensitive boolean")
        assert search.search_query_table(events, table).count() == 3


def test_empty_query_table_matches_all(spark, make_events):
    table = spark.createDataFrame([], "idx int, query string, case_sensitive boolean")
    assert seqs(search.search_query_table(make_events(EDGE), table, 0, 100)) == [1, 2]


def test_pruning_is_sound_and_useful(spark, make_events):
    rng = random.Random(2)
    words = ["error", "Load", "x=1", "id7", "3.5", "-12", "a<b", "&", "take", "Error9"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(600)]
    encoded = encode_log(make_events([(0, i, i, m) for i, m in enumerate(texts)]))
    rows = encoded.join(make_events([(0, i, i, m) for i, m in enumerate(texts)]).select("seq", "message"), "seq")
    pruned_any = 0
    parts = ["*", "?", "er", "ror", "7", "3.", "-1", "<", "&", " ", "E", "a", "é", "\\"]
    for _ in range(25):
        q = WildcardQuery("".join(rng.choice(parts) for _ in range(rng.randint(1, 5))), rng.random() < 0.5)
        checked = rows.select(may_match([q], "logtype").alias("kept"), q.matches(F.col("message")).alias("hit"))
        unsound, dropped = checked.agg(
            F.count_if(F.col("hit") & ~F.col("kept")), F.count_if(~F.col("kept"))
        ).first()
        assert unsound == 0, q
        pruned_any += dropped
    assert pruned_any > 0


@pytest.mark.parametrize("width", [8, 4])
@pytest.mark.parametrize("stop", [False, True])
def test_stored_search_equals_plain_search(spark, make_events, width, stop):
    rng = random.Random(9)
    kinds = ["error %d in disk", "login %d ok", "took %d.5 ms"]
    rows = [
        (s, i, 1704067200000 + i * 3 * 10**6 + rng.randint(0, 10**8), rng.choice(kinds) % i)
        for s in range(3)
        for i in range(300)
    ]
    events = make_events(rows)
    path = scratch_path(spark, "stored")
    write_log(events, path, width=width)
    args = (["*error 1?? *", "*took*5.5*"], 1704067200000 + 10**7, 1704067200000 + 9 * 10**8, stop)
    plain = sorted(map(tuple, search.search(events, *args).select("stream_id", "seq", "ts_ms", "idx").collect()))
    found = pruned.search_log(spark, path, *args).select("stream_id", "seq", "ts_ms", "idx")
    assert sorted(map(tuple, found.collect())) == plain and plain
    assert read_encoded(spark, path).count() == len(rows)


def test_long_query_tables_agree_with_expressions(spark, make_events, monkeypatch):
    rng = random.Random(6)
    parts = ["a", "B", "é", "ς", "Σ", "*", "?", "\\z", "\\*", "\\?", "\\\\", "zX", " ", "ab", ".", "(", "{"]
    texts = ["".join(rng.choice(["a", "b", "É", "σ", "zXq", "*", "?", "\\", " ", ".", "(", "\n", "😀"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    events = make_events([(0, i, i, t) for i, t in enumerate(texts)] + [(0, 500, 1, None)])
    queries = {("".join(rng.choice(parts) for _ in range(rng.randint(0, 6))), rng.random() < 0.5) for _ in range(120)}
    table = spark.createDataFrame([(i, q, c) for i, (q, c) in enumerate(sorted(queries))] + [(900, r"*\z?q*", True)], "idx int, query string, case_sensitive boolean")
    found = []
    for plain in (1000, 0):
        monkeypatch.setattr(search, "PLAIN_QUERIES", plain)
        rows = search.search_query_table(events, table)
        if plain == 0:
            plan = plan_of(rows)
            assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "NestedLoop"))
        found.append(sorted((r.seq, r.idx) for r in rows.collect()))
    assert found[0] == found[1] and len(found[0]) > 50


def test_queries_in_columns(spark):
    cases = [("abc", "a*c", True), ("aBc", "A?C", False), ("a*c", r"a\*c", True), ("abc", r"a\*c", True), ("", "", True), ("x", "", True), ("", "*", True)]
    cases += [("a\nb", "a?b", True), ("(x)", "(?)", True), ("oδοσ", "*Σ", False), ("ab", "ab\\", True), (None, "*", True), ("a", None, True), ("aXbXc", "a*X?", True)]
    rows = spark.createDataFrame(cases, "target string, query string, exact boolean")
    expected = []
    for target, query, exact in cases:
        one = spark.createDataFrame([(target,)], "t string")
        expected.append(None if query is None else one.select(WildcardQuery(query, exact).matches(F.col("t"))).first()[0])
    pattern_columns.register_sql(spark)
    got = pattern_columns.match_columns(rows, "target", "query", "exact").withColumn("direct", pattern_columns.wildcard_match("target", "query", "exact"))
    got = got.withColumn("by_sql", F.expr("if(exact, wildcard_query_match(target, query), wildcard_query_match_nocase(target, query))"))
    found = {(r.target, r.query, r.exact): (r.matches, r.direct, r.by_sql) for r in got.collect()}
    assert found == {c: (e,) * 3 for c, e in zip(cases, expected, strict=True)}


@pytest.mark.parametrize(("few", "limit"), [(0, 0), (32, 0), (4, 64), (32, 1 << 26)])
def test_long_query_tables_look_up_what_few_queries_share(spark, make_events, monkeypatch, few, limit):
    messages = [f"user={i % 40} did x{i % 3} took {i % 7}.25 ms" for i in range(400)] + ["", "~", "User=3 took 5.25", "user=1"]
    events = make_events([(0, i, i, m) for i, m in enumerate(messages)] + [(0, 1, 1, messages[1]), (0, 900, 1, None)])
    queries = [(f"user={i} *took {i % 7}.25*", i % 2 == 0) for i in range(40)] + [(f"*x{i % 3} took {i % 7}.25 ms", True) for i in range(0, 21, 4)]
    queries += [("", True), ("*~*", False), ("USER=1", False), ("?", True), ("user=1", True)]
    table = spark.createDataFrame([(i, q, c) for i, (q, c) in enumerate(queries)], "idx int, query string, case_sensitive boolean")
    plain = sorted((r.seq, r.idx) for r in search.search_query_table(events, table).collect())
    keyed = pattern_columns.keyed_queries(table).collect()
    shared = collections.Counter((r.exact, r.start, r.gram) for r in keyed)
    assert len(keyed) == len(queries) and max(shared.values()) <= 3
    monkeypatch.setattr(search, "PLAIN_QUERIES", 0)
    monkeypatch.setattr(pattern_columns, "FEW", few)
    monkeypatch.setattr(pattern_columns, "MAX_BROADCAST_BYTES", limit)
    assert sorted((r.seq, r.idx) for r in search.search_query_table(events, table).collect()) == plain and len(plain) > 50
