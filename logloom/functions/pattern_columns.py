r"""Wildcard queries that are data: patterns in a column, compiled with built-in functions.

The same query language as :mod:`logloom.functions.glob`, stated as SQL over a column of query texts. A
query becomes a regular expression that commits to the leftmost match of each piece; the match itself is
one ``rlike``. :func:`register_sql` makes it a SQL function.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.glob import FINAL_SIGMA, folded
from logloom.plans.joins import MAX_BROADCAST_BYTES, attach_materialized, measured_bytes
from logloom.session import materialize

#: Lengths of the texts by which long query tables are looked up, and the largest of a query's beginning.
SIZES = (1, 2, 3, 8)
START = 32
#: Queries that may share a beginning for it to be looked up before rarer texts.
SHARED = 64
#: Queries that are tested as one expression next to those that are looked up.
FEW = 32
#: Upper estimate of the size of a hash in a broadcast table.
_KEY_BYTES = 64

# An escaped character, a star, or any other character; a lone last escape is none of them.
_TOKENS = r"regexp_extract_all({query}, r'(?s)(\\.|[^\\])', 1)"
_CHARACTER = r"if(length({token}) = 2 and startswith({token}, r'\'), substring({token}, 2), {token})"
# ASCII punctuation and blanks are quoted; other characters stand for themselves.
_QUOTED = r"regexp_replace({text}, r'^([!-/:-@\[-`{{-~ ])$', r'\\$1')"


def tokens_sql(query: str) -> str:
    return _TOKENS.format(query=query)


def regex_sql(query: str) -> str:
    """SQL of the regular expression, in Java syntax, that a query text stands for."""
    element = "if(t = '?', '.', " + _QUOTED.format(text=_CHARACTER.format(token="t")) + ")"
    opened = "concat(if(s.starred, '(?>.*?', '(?>'), s.piece, ')')"
    return (
        f"aggregate({tokens_sql(query)}, "
        "named_struct('done', '', 'piece', '', 'starred', false, 'ended', false), "
        "(s, t) -> if(t = '*', "
        f"named_struct('done', concat(s.done, if(s.piece = '', '', {opened})), 'piece', '', 'starred', true, 'ended', true), "
        f"named_struct('done', s.done, 'piece', concat(s.piece, {element}), 'starred', s.starred, 'ended', false)), "
        r"s -> concat(r'(?s)\A', s.done, case when s.piece <> '' then concat(if(s.starred, '.*', ''), s.piece, r'\z') "
        r"when s.ended then '' else r'\z' end))"
    )


def folded_sql(text: str) -> str:
    return f"translate(lower({text}), '{FINAL_SIGMA[0]}', '{FINAL_SIGMA[1]}')"


def match_sql(target: str, query: str, case_sensitive: str) -> str:
    exact = f"rlike({target}, {regex_sql(query)})"
    loose = f"rlike({folded_sql(target)}, {regex_sql(folded_sql(query))})"
    return f"if({case_sensitive}, {exact}, {loose})"


def wildcard_match(target: str, query: str, case_sensitive: str = "true") -> Column:
    """Whether the text in one column matches the query in another; arguments are column names or SQL."""
    return F.expr(match_sql(target, query, case_sensitive))


def register_sql(spark: SparkSession) -> None:
    """Create the temporary SQL functions ``wildcard_query_match`` and ``wildcard_query_match_nocase``."""
    for name, flag in (("wildcard_query_match", "true"), ("wildcard_query_match_nocase", "false")):
        body = match_sql("target", "query", flag)
        spark.sql(f"create or replace temporary function {name}(target string, query string) returns boolean return {body}")


def match_columns(rows: DataFrame, target: str, query: str, case_sensitive: str, out: str = "matches") -> DataFrame:
    """``rows`` with ``out``: whether ``target`` matches ``query``, each distinct query compiled once."""
    asked = rows.select(F.col(query).alias("_query"), F.coalesce(F.col(case_sensitive), F.lit(True)).alias("_exact")).distinct()
    regex = F.when(F.col("_exact"), F.expr(regex_sql("_query"))).otherwise(F.expr(regex_sql(folded_sql("_query"))))
    side = materialize(asked.filter("_query is not null").withColumn("_regex", regex))
    keyed = rows.withColumns({"_query": F.col(query), "_exact": F.coalesce(F.col(case_sensitive), F.lit(True))})
    joined = attach_materialized(keyed, side, ["_query", "_exact"], "left")
    text = F.when(F.col("_exact"), F.col(target)).otherwise(folded(F.col(target)))
    return joined.withColumn(out, F.rlike(text, F.col("_regex"))).drop("_query", "_exact", "_regex")


def grams(text: Column, n: int) -> Column:
    """The distinct texts of ``n`` characters in a text."""
    # An empty match at every place that looks ahead: one pass, however long the text.
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def keyed_queries(queries: DataFrame) -> DataFrame:
    """``idx, exact, start, size, gram, regex`` of ``queries (idx, query, case_sensitive)``.

    Every message that matches a query holds the query's ``gram``, at its start if ``start``. A query that begins with
    plain characters has those (at most ``START``) if at most ``SHARED`` queries begin so; else the gram is that of the
    query's plain texts of ``SIZES`` characters that the fewest queries have, among the longest, or its
    beginning if fewer have that. ``size`` is its length, 0 for queries without plain characters.
    """
    # Numbered queries often come from one task.
    dealt = queries.repartition(2 * queries.sparkSession.sparkContext.defaultParallelism, "idx")
    rows = dealt.select(
        F.col("idx").cast("int").alias("idx"),
        F.col("case_sensitive").alias("exact"),
        F.when(F.col("case_sensitive"), F.col("query")).otherwise(folded(F.col("query"))).alias("text"),
    )
    rows = rows.withColumn("regex", F.expr(regex_sql("text"))).withColumn("tokens", F.expr(tokens_sql("text")))
    # Plain texts between stars and question marks; the marks are told from escaped ones by their length.
    plain = F.expr(
        "transform(tokens, t -> if(t in ('*', '?'), null, " + _CHARACTER.format(token="t") + "))"
    )
    rows = rows.withColumn("plain", plain).drop("tokens", "text")
    at = F.expr(
        f"filter(flatten(transform(array({', '.join(map(str, SIZES))}), n -> transform(sequence(1, greatest(size(plain) - n + 1, 1)), "
        "i -> named_struct('start', false, 'size', n, 'chars', slice(plain, i, n))))), g -> size(g.chars) = g.size and not exists(g.chars, c -> c is null))"
    )
    opening = F.expr(
        f"aggregate(slice(plain, 1, {START}), named_struct('chars', cast(array() as array<string>), 'open', true), "
        "(s, c) -> if(s.open and c is not null, named_struct('chars', s.chars || array(c), 'open', true), named_struct('chars', s.chars, 'open', false)), "
        "s -> named_struct('start', true, 'size', size(s.chars), 'chars', s.chars))"
    )
    rows = rows.withColumn("held", at).withColumn("top", F.coalesce(F.array_max(F.transform("held", lambda g: g["size"])), F.lit(0)))
    longest = F.filter("held", lambda g: g["size"] == F.col("top"))
    held = F.concat(longest, F.filter(F.array(opening), lambda g: g["size"] > 0))
    texts = F.transform(held, lambda g: F.struct(g["start"].alias("start"), g["size"].alias("size"), F.array_join(g["chars"], "").alias("gram")))
    none = F.array(F.struct(F.lit(False).alias("start"), F.lit(0).alias("size"), F.lit("").alias("gram")))
    rows = rows.withColumn("key", F.explode(F.when(F.col("top") == 0, none).otherwise(F.array_distinct(texts))))
    rows = rows.select("idx", "exact", "regex", "key.start", "key.size", "key.gram")
    shared = rows.groupBy("exact", "start", "gram").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(shared, ["exact", "start", "gram"])
    # A message has one beginning of a size but many texts, so a beginning that few share is looked up first.
    order = F.struct(~(F.col("start") & (F.col("n") <= SHARED)), "n", "gram", "start")
    return rows.groupBy("idx", "exact", "regex").agg(F.min_by(F.struct("start", "size", "gram"), order).alias("key")).select("idx", "exact", "regex", "key.*")


def _key(exact: Column, start: Column, gram: Column) -> Column:
    return F.xxhash64(exact, start, gram)


def _looks(held: Column, exact: Column, start: Column) -> Column:
    nothing = F.lit(None).cast("int").alias("idx")
    return F.transform(held, lambda gram: F.struct(_key(exact, start, gram).alias("key"), gram.alias("gram"), exact.alias("exact"), nothing))


def first_in_table(events: DataFrame, keyed: DataFrame, message: str = "message") -> DataFrame:
    """``events`` that match a query of ``keyed`` (stored), with the smallest ``idx``, in one scan.

    The grams of a message find the queries that it may match by an equi-join; only those are tested. Kinds of grams
    (fold, place, size) that no more than ``FEW`` queries have together are tested as one expression instead.
    Grams that no query has are dropped by their hashes before messages travel. Rows are numbered, so repeated events stay apart.
    """
    columns = events.columns
    rows = events.filter(F.col(message).isNotNull()).withColumn("_row", F.monotonically_increasing_id())
    # At most two folds of START beginnings and of the sizes of grams.
    kinds = sorted(keyed.groupBy("exact", "start", "size").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: (r["n"], r["exact"], r["start"], r["size"]))
    if not kinds:
        return events.limit(0).withColumn("idx", F.lit(None).cast("int"))
    few, left = [], FEW
    while kinds and kinds[0]["n"] <= left:
        left -= kinds[0]["n"]
        few.append(kinds.pop(0))
    loose = folded(F.col(message))
    texts = {True: F.col(message), False: loose}
    none = F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("string").alias("gram"), F.lit(None).cast("boolean").alias("exact")
    looks = []
    if few:
        of_kind = reduce(Column.__or__, [(F.col("exact") == k["exact"]) & (F.col("start") == k["start"]) & (F.col("size") == k["size"]) for k in few])
        tests = keyed.filter(of_kind).select("idx", "exact", "regex").collect()
        found = F.array_min(F.array(*[F.when(F.rlike(texts[t["exact"]], F.lit(t["regex"])), F.lit(t["idx"])) for t in tests]))
        looks.append(F.filter(F.array(F.struct(*none, found.alias("idx"))), lambda look: look["idx"].isNotNull()))
    for k in kinds:
        text, exact, start = texts[k["exact"]], F.lit(k["exact"]), F.lit(k["start"])
        if k["size"] == 0:
            held = F.array(F.lit(""))
        elif k["start"]:
            held = F.array(F.substring(text, 1, k["size"]))
        else:
            held = grams(text, k["size"])
        looks.append(_looks(held, exact, start))
    looked = rows.withColumn("_look", F.explode(F.concat(*looks))).select(*columns, "_row", *[F.col(f"_look.{c}").alias(f"_{c}") for c in ("key", "gram", "exact", "idx")])
    side = keyed.filter(~of_kind) if few else keyed
    side = side.select(_key(F.col("exact"), F.col("start"), F.col("gram")).alias("_key"), F.col("gram").alias("_held"), F.col("idx").alias("_asked"), "regex")
    if measured_bytes(keyed) <= MAX_BROADCAST_BYTES:
        side = F.broadcast(side)
    elif keyed.select("exact", "start", "gram").distinct().count() * _KEY_BYTES <= MAX_BROADCAST_BYTES:
        keys = side.select("_key").distinct().withColumn("_known", F.lit(True))
        looked = looked.join(F.broadcast(keys), "_key", "left").filter("_known or _idx is not null").drop("_known")
    # Rows that only carry what the expression found have no key and meet no query.
    met = looked.join(side, "_key", "left")
    text = F.when(F.col("_exact"), F.col(message)).otherwise(loose)
    hits = met.filter(F.col("_idx").isNotNull() | ((F.col("_gram") == F.col("_held")) & F.rlike(text, F.col("regex"))))
    whole = F.first(F.struct(*columns)).alias("event")
    return hits.groupBy("_row").agg(F.min(F.coalesce("_idx", "_asked")).alias("idx"), whole).select("event.*", "idx")
