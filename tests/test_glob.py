import random

import pytest
from pyspark.sql import functions as F

from logloom.functions.glob import Glob, WildcardQuery, any_match, first_match_index


def brute_match(text, query):
    """Plain backtracking reading of the query grammar."""
    if not query:
        return text == ""
    head, rest = query[0], query[1:]
    if head == "*":
        return brute_match(text, rest) or (text != "" and brute_match(text[1:], query))
    if head == "\\":
        if not rest:
            return text == ""
        return text[:1] == rest[0] and brute_match(text[1:], rest[1:])
    return text != "" and head in ("?", text[0]) and brute_match(text[1:], rest)


QUERY_CASES = [
    "", "*", "**", "?", "??*", "a**b", r"a\*b", r"a\?b", r"\x", "tail\\", "%", "_", "100%_^", "a?b", "*b*",
    "a*", "*b", "a*b*c", "*a*a", "*aa", "aab*aab", r"*\\*", "é?", "?é*", "a\nb", "*\n*", "a.b", "*[*", "*a?*b",
]
MESSAGES = [
    "", "a", "b", "ab", "aab", "a*b", "a?b", "x", "tail", "tail\\", "%", "_", "100%_^", "axb", "abc", "a-b-c",
    "aa", "aabaab", "aabxaab", "back\\slash", "éa", "aé", "a\nb", "a.b", "[", "ABC", "bab", "caab", "A", "ÉA",
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(m,) for m in MESSAGES], "message string")


@pytest.mark.parametrize("query", QUERY_CASES)
@pytest.mark.parametrize("case_sensitive", [True, False])
def test_matches_brute_force(messages, query, case_sensitive):
    q = WildcardQuery(query, case_sensitive)
    got = {r.message for r in messages.filter(q.matches(F.col("message"))).collect()}
    fold = (lambda s: s) if case_sensitive else str.lower
    assert got == {m for m in MESSAGES if brute_match(fold(m), fold(query))}


def test_random_queries(spark):
    rng = random.Random(11)
    texts = sorted({"".join(rng.choice("ab.\n") for _ in range(rng.randint(0, 9))) for _ in range(300)})
    queries = ["".join(rng.choice("ab.*?*\\") for _ in range(rng.randint(0, 7))) for _ in range(120)]
    df = spark.createDataFrame([(m,) for m in texts], "message string")
    cols = [WildcardQuery(q).matches(F.col("message")).alias(f"q{i}") for i, q in enumerate(queries)]
    for row in df.select("message", *cols).collect():
        for i, q in enumerate(queries):
            assert row[f"q{i}"] == brute_match(row.message, q), (row.message, q)


@pytest.mark.parametrize(
    "query,cleaned",
    [("**err**or*\\", "*err*or*"), (r"\x\*", r"x\*"), ("a***", "a*"), ("***", "*"), ("", ""), ("?*?", "?*?")],
)
def test_cleaning(query, cleaned):
    assert Glob.parse(query).text() == cleaned


def test_first_query_wins_and_null_never_matches(spark):
    df = spark.createDataFrame([("error here",), ("ERROR",), ("none",), (None,)], "message string")
    queries = [WildcardQuery("*here"), WildcardQuery("*ERROR*", False), WildcardQuery("*error*")]
    rows = df.select("message", first_match_index(queries, F.col("message")).alias("i")).collect()
    assert {r.message: r.i for r in rows} == {"error here": 0, "ERROR": 1, "none": None, None: None}
    empty = df.select(first_match_index([], F.col("message")).alias("i"), any_match([], F.col("message")).alias("m"))
    assert sorted((str(r.i), r.m) for r in empty.collect()) == [("0", True)] * 3 + [("None", False)]


def test_many_queries_compile(spark):
    df = spark.createDataFrame([(f"event {i} end",) for i in range(400)], "message string")
    queries = [f"*event {i} *" for i in range(400)]
    rows = df.select("message", first_match_index(queries, F.col("message")).alias("i")).collect()
    assert all(r.message == f"event {r.i} end" for r in rows)


def test_long_message_has_no_backtracking(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("ab"), 200000), F.lit("!")).alias("message"))
    q = WildcardQuery("*a*b*a*b*a?b*a*b*c")
    assert df.filter(q.matches(F.col("message"))).count() == 0
    assert df.filter(WildcardQuery("*a*b*a?a*b!").matches(F.col("message"))).count() == 1
