"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import (
    bpe,
    collocations,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    near_dup,
    periodic_runs,
    simhash,
    suffix_dedup,
    token_tree_lm,
    topk_search,
    toxicity,
)
from logloom.llm.common import text_of, words_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- mixing ------------------------------------------------------------------------

MIX_WEIGHTS = [3, 1, 2]


@registered
def op2_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sizes = mixing.document_sizes(docs, keep={"doc_key": "doc_id"})
    mix = mixing.mix_sources(sizes, MIX_WEIGHTS)
    sources = mix.sources.select(F.col("source").alias("s"), "source_size", "target")
    return (
        sizes.join(mixing.taken_words(mix), "place", "left")
        .join(sources, F.col("source").eqNullSafe(F.col("s")))
        .select(
            F.col("doc_key").alias("doc_id"),
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        )
    )


# --- exact dedup -------------------------------------------------------------------


@registered
def op4_exact_dedup(spark, sf_dir):
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE_SQL["op4_exact_dedup"] = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM digests WINDOW g AS (PARTITION BY text_sha256)
"""

# --- exact top-k search ------------------------------------------------------------


@registered
def op5_topk_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.topk_search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), same_length=False)


ORACLE_SQL["op5_topk_search"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""

# --- license scans -----------------------------------------------------------------


@registered
def op3_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


# --- toxicity ----------------------------------------------------------------------


@registered
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_severity(docs, toxicity.fit_severity(docs, table(spark, sf_dir, "labels")))


# --- language ID -------------------------------------------------------------------


@registered
def op9_language_id(spark, sf_dir):
    """Documents with their declared language and source, and pages with markup and address."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    models = language_id.fit_text_models(docs)
    of_docs = language_id.identify(docs, models, declared_col="lang", host_col="source", keep=["doc_id"])
    pages = pages.select(
        "page_id",
        language_id.visible_text(F.col("html")).alias("text"),
        language_id.declared_in_markup(F.col("html")).alias("declared"),
        language_id.host_of(F.col("url")).alias("host"),
    )
    of_pages = language_id.identify(pages, models, declared_col="declared", host_col="host", keep=["page_id"])
    return of_docs.withColumn("page_id", F.lit(None).cast("bigint")).unionByName(
        of_pages.withColumn("doc_id", F.lit(None).cast("bigint"))
    )

# --- byte-level BPE ----------------------------------------------------------------


def multi_vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@registered
def op1_byte_bpe(spark, sf_dir):
    rows = bpe.round_trip(table(spark, sf_dir, "documents"), multi_vocabulary(), keep=["doc_id"])
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

# --- n-gram Jaccard join -----------------------------------------------------------


@registered
def op10_ngram_jaccard(spark, sf_dir):
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


ORACLE_SQL["op10_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""

# --- LM scoring --------------------------------------------------------------------


@registered
def op8_lm_scores(spark, sf_dir):
    return token_tree_lm.score_texts(table(spark, sf_dir, "documents"))

# --- suffix-array dedup ------------------------------------------------------------


@registered
def op6_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

# --- periodic runs -----------------------------------------------------------------


def made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one document in ten repeats a stretch of its words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"))
    words = words.withColumn("w", F.when(F.col("h") % 10 == 0, words_of(text_of("text"))))
    n, g = F.size("w"), F.floor(F.col("h") / 10).cast("bigint")
    placed = words.withColumn("a", (g % F.nullif(n, F.lit(0))).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    left = n - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), left)), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@registered
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.collapse_runs(made_periodic(table(spark, sf_dir, "documents")))
    runs = F.coalesce("runs", F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>"))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.get(periodic_runs.by_exponent(F.col("runs")), F.lit(0))
    rows = found.select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
    milli = F.expr("(1000 * best.length) div best.period").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")

# --- SimHash near-dedup ------------------------------------------------------------


@registered
def op12_simhash_near_dup(spark, sf_dir):
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

# --- phrase collocations -----------------------------------------------------------


@registered
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
phrases AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY lang, k, phrase),
often AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM freq WHERE k > 1 AND f >= 30),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM freq WHERE k = 1 GROUP BY lang),
parts AS (SELECT lang, phrase, f, w, k, unnest(range(1, k)) AS cut FROM often),
cuts AS (
  SELECT p.lang, p.phrase, p.f AS a, p.cut, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * p.f) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM parts p
  JOIN freq x ON x.lang = p.lang AND x.phrase = array_to_string(p.w[1:p.cut], ' ')
  JOIN freq y ON y.lang = p.lang AND y.phrase = array_to_string(p.w[p.cut + 1:p.k], ' ')),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS part
    FROM often, (VALUES (2), (3)) AS lengths(m) WHERE m < k)
  GROUP BY lang, part)
SELECT * FROM (
  SELECT e.lang, row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM least e JOIN totals t ON t.lang = e.lang LEFT JOIN held h ON h.lang = e.lang AND h.part = e.phrase
  WHERE h.f IS NULL OR CAST(100 AS HUGEINT) * h.f < CAST(80 AS HUGEINT) * a)
WHERE rank <= 2000
"""
