"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence meet in one posterior over the languages of the training labels: the
likelihood of the text under hashed byte-trigram models, the declared language, the suffix of
the address, and the host's prior. How far a declaration or a suffix can be trusted is counted
from the table itself: ``P(declared | language)`` and ``P(suffix | language)`` come from grouped
aggregation of text votes, and so do host priors, which are smoothed towards their site and the
site towards the whole table. A row's own vote is left out of what it is judged by.

The text models are fitted on a bounded sample of labelled rows (about ``max_labelled``); all
counts cover every row. Only models and per-language totals reach the driver; the count tables
are joined by key and stay distributed, and a hot host is pre-aggregated before its shuffle.

Cases: a null or empty text and a text without letters have no text evidence and cast no vote;
missing declarations, suffixes or hosts are neutral; with no evidence at all the language is
null and the row is rejected; without labelled rows every language is null; an empty table gives
no rows; rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import give_back, stored

MAX_LABELLED = 4000
BUCKETS = 1 << 15
MIN_CONFIDENCE = 0.6
SMOOTHING = 4.0
#: Each byte is part of three trigrams; this keeps the text from being counted three times.
TEXT_WEIGHT = 1 / 3
_CHUNK = 1 << 20


def trigram_buckets(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of the byte trigrams of a text, in chunks of bounded size."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    for at in range(0, max(0, len(data) - 2), _CHUNK):
        part = data[at : at + _CHUNK + 2].astype(np.uint32)
        code = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        yield ((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(buckets)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass
class TextModels:
    """``scores[l, b]``: log probability of bucket ``b`` in language ``l``."""

    languages: list[str]
    scores: np.ndarray

    def log_likelihoods(self, text: str) -> np.ndarray:
        total = np.zeros(len(self.languages))
        for part in trigram_buckets(text, self.scores.shape[1]):
            counts = np.bincount(part, minlength=self.scores.shape[1]) if len(part) > 65536 else None
            total += self.scores @ counts if counts is not None else self.scores[:, part].sum(axis=1, dtype=np.float64)
        return total


def fit_text_models(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_labelled: int = MAX_LABELLED, buckets: int = BUCKETS
) -> TextModels:
    """Trigram models of the labels of about ``max_labelled`` rows, taken by a hash of the text."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    n = max(1, rows.count())
    sample = rows.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(n)) < max_labelled)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    sums[lang] = np.zeros(buckets, np.int64)
                for part in trigram_buckets(text, buckets):
                    sums[lang] += np.bincount(part, minlength=buckets)
        for lang, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], ["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.full((len(languages), buckets), 0.5)
    place = {lang: i for i, lang in enumerate(languages)}
    counts[table["lang"].map(place).to_numpy(int), table["bucket"].to_numpy(int)] += table["n"].to_numpy(float)
    return TextModels(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def _votes(rows: DataFrame, key: str, n: int, out: str) -> DataFrame:
    """``(key, out)``: text votes per language of each value of ``key``."""
    counts = F.array(*[F.count_if(F.col("vote") == i) for i in range(n)])
    return rows.filter(F.col(key).isNotNull() & F.col("vote").isNotNull()).groupBy(key).agg(counts.alias(out))


def identify(
    rows: DataFrame,
    models: TextModels,
    text_col: str = "text",
    declared_col: str | None = None,
    host_col: str | None = None,
    keep: list[str] | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """The columns ``keep`` with ``language, confidence, text_language, accepted``."""
    keep = keep or []
    n = len(models.languages)
    null = F.lit(None).cast("string")
    host = F.lower(F.col(host_col).cast("string")) if host_col else null
    parts = F.split(host, r"\.")
    dotted = F.size(parts) > 1
    picked = rows.select(
        F.struct(*[rows[c] for c in keep], F.lit(0).alias("_none")).alias("kept"),
        F.col(text_col).alias("text"),
        (F.lower(F.col(declared_col).cast("string")) if declared_col else null).alias("declared"),
        host.alias("host"),
        F.when(dotted, F.concat_ws(".", F.slice(parts, -2, 2))).alias("site"),
        F.when(dotted, F.element_at(parts, -1)).alias("suffix"),
        has_letters(F.col(text_col)).alias("lettered"),
    )

    @F.pandas_udf("array<double>")
    def likelihoods(texts, lettered):
        found = texts.combine(lettered, lambda t, ok: models.log_likelihoods(t) if ok and t else None)
        give_back()
        return found

    scored = picked.withColumn("scores", likelihoods("text", "lettered") if n else F.lit(None).cast("array<double>"))
    best = F.array_position("scores", F.array_max("scores")) - 1
    scored = stored(scored.withColumn("vote", best.cast("int")).drop("text", "lettered"), "language-scores")

    if not n:
        none = scored.select("kept.*", null.alias("language"), F.lit(0.0).alias("confidence"), null.alias("text_language"), F.lit(False).alias("accepted"))
        return none.drop("_none")

    # Per-language totals: a few numbers for the whole table.
    totals = scored.agg(
        *[F.count_if(F.col("vote") == i).alias(f"all_{i}") for i in range(n)],
        *[F.count_if((F.col("vote") == i) & F.col(c).isNotNull()).alias(f"{c}_{i}") for c in ("declared", "suffix") for i in range(n)],
        *[F.approx_count_distinct(c).alias(f"{c}_values") for c in ("declared", "suffix")],
    ).first()
    everyone = [totals[f"all_{i}"] for i in range(n)]
    joined = scored
    for key in ("declared", "suffix", "site", "host"):
        joined = joined.join(_votes(scored, key, n, f"{key}_votes"), key, "left")

    def less_own(votes: str, i: int) -> Column:
        own = F.when(F.col("vote") == i, 1).otherwise(0)
        return F.coalesce(F.element_at(votes, i + 1) - own, F.lit(0))

    def likelihood(key: str, i: int) -> Column:
        of_all = totals[f"{key}_{i}"] + smoothing * max(1, totals[f"{key}_values"])
        return F.when(F.col(key).isNull(), F.lit(0.0)).otherwise(F.log((less_own(f"{key}_votes", i) + smoothing) / F.lit(float(of_all))))

    def size_of(votes: str) -> Column:
        own = F.when(F.col("vote").isNotNull(), 1).otherwise(0)
        return F.coalesce(F.aggregate(votes, F.lit(0).cast("bigint"), lambda a, b: a + b) - own, F.lit(0))

    def prior(i: int) -> Column:
        whole = F.lit((everyone[i] + 1) / (sum(everyone) + n))
        site = (less_own("site_votes", i) + smoothing * whole) / (size_of("site_votes") + smoothing)
        return F.log((less_own("host_votes", i) + smoothing * site) / (size_of("host_votes") + smoothing))

    evidence = F.array(
        *[
            F.coalesce(F.element_at("scores", i + 1) * TEXT_WEIGHT, F.lit(0.0)) + likelihood("declared", i) + likelihood("suffix", i) + prior(i)
            for i in range(n)
        ]
    )
    weighed = joined.withColumn("evidence", evidence).withColumn("top", F.array_max("evidence"))
    weighed = weighed.withColumn("mass", F.aggregate("evidence", F.lit(0.0), lambda a, e: a + F.exp(e - F.col("top"))))
    known = F.col("scores").isNotNull() | F.col("declared").isNotNull() | F.col("suffix").isNotNull() | F.col("host").isNotNull()
    names = F.array(*[F.lit(x) for x in models.languages])
    language = F.when(known, F.element_at(names, F.array_position("evidence", F.col("top")).cast("int")))
    confidence = F.when(known, 1 / F.col("mass")).otherwise(0.0)
    text_language = F.when(F.col("vote").isNotNull(), F.element_at(names, F.col("vote") + 1))
    return weighed.select(
        "kept.*",
        language.alias("language"),
        confidence.alias("confidence"),
        text_language.alias("text_language"),
        # Without text there is nothing to train on, whatever the other evidence says.
        (F.col("scores").isNotNull() & (confidence >= min_confidence)).alias("accepted"),
    ).drop("_none")


def keep_accepted(docs: DataFrame, models: TextModels, text_col: str = "text", declared_col: str | None = None, host_col: str | None = None, **options) -> DataFrame:
    """The accepted rows of ``docs``, all columns unchanged.

    Texts are scored where they are read; only a key of each rejected row is joined back. Rows with
    the same text, declaration and host have the same key and the same verdict.
    """
    used = [c for c in (text_col, declared_col, host_col) if c]
    key = F.xxhash64(*[docs[c] for c in used], *[docs[c].isNull() for c in used])
    judged = identify(docs.select(*[docs[c] for c in used], key.alias("_row_key")), models, text_col, declared_col, host_col, ["_row_key"], **options)
    rejected = judged.filter("not accepted").select("_row_key").distinct()
    return docs.join(rejected, key == F.col("_row_key"), "left_anti")


def host_of(url: Column) -> Column:
    """Lower-case host name of an address, without user, port and path; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def declared_in_markup(html: Column) -> Column:
    """Primary language tag declared on the root element of a page; null if there is none."""
    tag = F.regexp_extract(F.lower(html), r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,8})", 1)
    return F.when(tag != "", tag)


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
