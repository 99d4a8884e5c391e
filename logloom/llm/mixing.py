"""Mixing sources to target weights, with DataFrame functions only.

The words of each source are packed into blocks of fixed length. Targets are weights times
what is left after capped sources took their cap. For every output shard, source counts are
drawn from the multinomial given by the targets; what a source got beyond its blocks goes, in
order, to sources that got too few, so totals are exact. The slots of a source are mapped
through a keyed permutation of its block indexes, a new one for each pass over the source,
and blocks are joined by index. A block is taken once per pass, so with a cap of two passes
no document is taken more than twice.

No step gathers a source: packing runs in hash buckets of about ``BUCKET_ROWS`` rows, sums run
in two levels, and joins are on (source, block), which at most ``block_words`` documents share.

Cases: a null text has size 0; a null source is a source of its own, last in order; documents
without words are taken 0 times; equal rows are separate documents; an empty table gives no
rows; reruns agree because every draw is a hash of the seed and an index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import prefix_sum, stored, text_of, word_count, words_of
from logloom.plans.dense import with_dense_id
from logloom.session import settle

BLOCK_WORDS = 256
SHARD_SLOTS = 65536
BUCKET_ROWS = 1024
ROUNDS = 32
_EXACT = "decimal(38,0)"


@dataclass
class Mix:
    """``sources``: targets; ``slots``: the mix, one row per slot; ``pieces``: which words of which
    document make up each block."""

    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def document_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text", keep: dict | None = None) -> DataFrame:
    """``(place, source, size, ...)``: one stored row per document; ``keep`` names further columns."""
    rows = docs.select(
        F.col(source_col).cast("string").alias("source"),
        word_count(text_of(text_col)).alias("size"),
        *[F.col(c).alias(name) for name, c in (keep or {}).items()],
    )
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "sizes")


def source_targets(sizes: DataFrame, weights: list[int], share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """``(source, rank, source_size, target)``; targets share ``share`` of all sizes by weight.

    Weights repeat over the sources in code point order, null last. A source stops at ``cap``
    times its size and its excess is shared again by weight, until none is above.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = with_dense_id(totals.filter("source is not null"), "source", "rank")
    n_named = totals.agg(F.count("source")).first()[0]
    nameless = totals.filter("source is null").withColumn("rank", F.lit(n_named).cast("bigint"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(
        named.select("source", "rank", "source_size")
        .unionByName(nameless.select("source", "rank", "source_size"))
        .withColumn("weight", weight.cast("bigint")),
        "ranked",
    )
    # level = over / under is the words per unit of weight; whole numbers keep every round exact.
    limit, each = F.col("source_size") * cap, F.col("weight").cast(_EXACT)
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share[0]
    over, under = 0, 1
    while True:
        at_limit = each * F.lit(over).cast(_EXACT) >= limit.cast(_EXACT) * F.lit(under).cast(_EXACT)
        used, free = ranked.agg(F.sum(F.when(at_limit, limit)), F.sum(F.when(~at_limit, F.col("weight")))).first()
        if not free:
            break
        level = budget - (used or 0) * share[1], free * share[1]
        if level == (over, under):
            break
        over, under = level
    at_limit = each * F.lit(over).cast(_EXACT) >= limit.cast(_EXACT) * F.lit(under).cast(_EXACT)
    target = F.when(at_limit, limit.cast("double")).otherwise(F.col("weight") * F.lit(float(over)) / F.lit(float(under)))
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def _with_slots(sources: DataFrame, block_words: int) -> DataFrame:
    """Per source: whole passes, words of the last pass, blocks, slots, and the first slot of all."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    rows = (
        sources.withColumn("words", F.floor(F.col("target") + 0.5).cast("bigint"))
        .withColumn("passes", F.floor(F.col("words") / size).cast("bigint"))
        .withColumn("rest", F.col("words") % size)
        .withColumn("full", F.floor(F.col("source_size") / block_words).cast("bigint"))
        .withColumn("tail", F.col("source_size") % block_words)
        .withColumn("blocks", F.col("full") + (F.col("tail") > 0).cast("bigint"))
        .withColumn("n_slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("bigint"))
    )
    return stored(prefix_sum(rows, "rank", "n_slots", "first_slot"), "source-slots")


def _locate(points: DataFrame, at: str, intervals: DataFrame, start: str, length: str, total: int, bins: int) -> DataFrame:
    """Join each point with the interval that holds it; the intervals tile ``[0, total)``.

    Intervals are entered into every bin they touch, so this is an equality join on the bin.
    """
    width = max(1, -(-total // max(1, bins)))
    last = F.floor((F.col(start) + F.col(length) - 1) / width)
    entered = intervals.filter(F.col(length) > 0).withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col(start) / width), last))
    )
    return (
        points.withColumn("_bin", F.floor(F.col(at) / width))
        .join(entered, "_bin")
        .filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(start) + F.col(length)))
        .drop("_bin")
    )


def permuted(index: Column, n: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """A keyed pseudorandom permutation of ``[0, n)``: swap-or-not rounds, one to one for every n."""

    def one_round(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, F.lit("shift"), *key), n) - x, n)
        swap = F.pmod(F.xxhash64(r, F.greatest(x, partner), *key), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("bigint"), one_round)


def _draw(sources: DataFrame, n_slots: int, n_sources: int, shard_slots: int, seed: int) -> DataFrame:
    """``(shard, rank, t)``: slot ``t`` of a source stands in an output shard; exact totals per source."""
    spark = sources.sparkSession
    draws = spark.range(n_slots).select(
        F.floor(F.col("id") / shard_slots).cast("bigint").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(n_slots)).alias("at"),
    )
    quota = sources.select("rank", "n_slots", "first_slot")
    drawn = _locate(draws, "at", quota, "first_slot", "n_slots", n_slots, 4 * n_sources)
    counts = drawn.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"), F.first("n_slots").alias("n_slots"))
    so_far = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(
        counts.withColumn("first", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        .withColumn("used", F.greatest(F.lit(0), F.least(F.col("n"), F.col("n_slots") - F.col("first"))))
        .drop("n_slots"),
        "counts",
    )
    held = counts.filter("used > 0").withColumn("t", F.explode(F.expr("sequence(first, first + used - 1)")))
    # Draws beyond a source's quota, numbered by shard and source, fill the open slots in order.
    beyond = counts.filter("n > used").select("shard", "rank", (F.col("n") - F.col("used")).alias("extra"))
    inside = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.range(-(-n_slots // shard_slots)).withColumnRenamed("id", "shard")
    per_shard = shards.join(beyond.groupBy("shard").agg(F.sum("extra").alias("sum")), "shard", "left").fillna(0, "sum")
    units = (
        beyond.withColumn("_in", F.coalesce(F.sum("extra").over(inside), F.lit(0)))
        .join(prefix_sum(per_shard, "shard", "sum", "_before").drop("sum"), "shard")
        .withColumn("unit", F.explode(F.expr("sequence(_before + _in, _before + _in + extra - 1)")))
        .select("shard", "unit")
    )
    taken = counts.groupBy("rank").agg(F.sum("used").alias("got"))
    open_slots = sources.select("rank", "n_slots").join(taken, "rank", "left").fillna(0, "got")
    open_slots = prefix_sum(open_slots.withColumn("lack", F.col("n_slots") - F.col("got")), "rank", "lack", "start")
    filled = _locate(units, "unit", open_slots, "start", "lack", n_slots, 4 * n_sources)
    filled = filled.withColumn("t", F.col("got") + F.col("unit") - F.col("start"))
    return held.select("shard", "rank", "t").unionByName(filled.select("shard", "rank", "t"))


def _slots(sources: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """``(shard, rank, pass, block, words)``: the block and its first words that each slot takes."""
    n_slots, n_sources = sources.agg(F.sum("n_slots"), F.count(F.lit(1))).first()
    placed = _draw(sources, n_slots or 0, n_sources, shard_slots, seed)
    rows = placed.join(sources.select("rank", "full", "tail", "blocks", "passes", "rest"), "rank")
    index = F.col("t") % F.col("blocks")
    rows = rows.withColumn("pass", F.floor(F.col("t") / F.col("blocks")).cast("bigint")).withColumn("index", index)
    key = [F.lit(seed), F.col("rank"), F.col("pass")]
    block = F.when(F.col("index") >= F.col("full"), F.col("full")).otherwise(
        permuted(F.col("index"), F.greatest(F.col("full"), F.lit(1)), key)
    )
    length = F.when(F.col("index") >= F.col("full"), F.col("tail")).otherwise(F.lit(block_words))
    left = F.col("rest") - F.col("index") * block_words
    words = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, left))
    return rows.select("shard", "rank", "pass", block.alias("block"), words.cast("bigint").alias("words"))


def _pieces(sizes: DataFrame, sources: DataFrame, block_words: int, seed: int) -> DataFrame:
    """``(place, rank, block, from, to, at)``: words ``[from, to)`` of a block are a document's words from ``at``."""
    n_rows = sizes.count()
    buckets = max(1, -(-n_rows // BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_key", "size"), F.lit(buckets))
    rows = sizes.filter("size > 0").withColumn("bucket", bucket)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("sum").over(over), F.lit(0)))
    ranks = sources.select(F.col("source").alias("s"), "rank")
    sums = sums.join(ranks, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "rank", "base"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("doc_key", "size", "place")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    rows = rows.join(sums, same).withColumn("start", F.col("base") + F.col("_in"))
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    begin, end = F.col("block") * block_words, (F.col("block") + 1) * block_words
    return rows.select(
        "place",
        "rank",
        "block",
        (F.greatest(F.col("start"), begin) - begin).alias("from"),
        (F.least(F.col("start") + F.col("size"), end) - begin).alias("to"),
        (F.greatest(F.col("start"), begin) - F.col("start")).alias("at"),
    )


def mix_sources(
    sizes: DataFrame,
    weights: list[int],
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 0,
) -> Mix:
    """The mix of stored document ``sizes`` (with a column ``doc_key`` that orders documents)."""
    sources = _with_slots(source_targets(sizes, weights, share, cap), block_words)
    slots = stored(_slots(sources, block_words, shard_slots, seed), "slots")
    return Mix(sources, slots, _pieces(sizes, sources, block_words, seed))


def taken_words(mix: Mix) -> DataFrame:
    """``(place, taken)``: words that the mix takes of each document, repeats counted."""
    per_block = mix.slots.groupBy("rank", "block", "words").agg(F.count(F.lit(1)).alias("times"))
    per_block = per_block.groupBy("rank", "block").agg(F.collect_list(F.struct("words", "times")).alias("takes"))
    overlap = F.aggregate(
        "takes",
        F.lit(0).cast("bigint"),
        lambda sum_, take: sum_
        + F.greatest(F.lit(0), F.least(F.col("to"), take["words"]) - F.col("from")) * take["times"],
    )
    return mix.pieces.join(per_block, ["rank", "block"]).groupBy("place").agg(F.sum(overlap).alias("taken"))


def mixed_documents(docs: DataFrame, weights: list[int], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: one row per document and pass.

    A document that a pass takes whole keeps its text; of one that it takes in part, the words
    taken stay, in order, with single spaces. Documents that are not taken are left out.
    """
    settle(docs.sparkSession)
    held = stored(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("place")), "mix-input")
    sizes = stored(
        held.select(
            "place",
            F.col(f"row.`{id_col}`").alias("doc_key"),
            F.col(f"row.`{source_col}`").cast("string").alias("source"),
            word_count(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))).alias("size"),
        ),
        "sizes",
    )
    mix = mix_sources(sizes, weights)
    settle(docs.sparkSession)
    end = F.least(F.col("to"), F.col("words"))
    spans = (
        mix.pieces.join(mix.slots, ["rank", "block"])
        .filter(end > F.col("from"))
        .groupBy("place", "pass")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", (end - F.col("from")).alias("length")))).alias("spans"),
            F.sum(end - F.col("from")).alias("n_taken"),
        )
    )
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    part = F.flatten(
        F.transform(
            "spans", lambda s: F.slice(F.col("all_words"), (s["at"] + 1).cast("int"), s["length"].cast("int"))
        )
    )
    rows = (
        held.join(sizes.select("place", "size"), "place")
        .join(spans, "place")
        .withColumn("all_words", F.when(F.col("n_taken") < F.col("size"), words_of(text)))
        .withColumn("new_text", F.when(F.col("n_taken") < F.col("size"), F.array_join(part, " ")).otherwise(text))
    )
    out = [F.col("new_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return rows.select(*out)
