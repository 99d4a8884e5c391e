"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct word shingles. The global order of n-grams is
their hash order; it is cut into fragments (``n_fragments`` grows with the text), and every
document sends each of its n-grams to its fragment, one row each. A fragment holds all occurrences of its
n-grams, so it knows their exact document frequency. N-grams that occur once overlap with nothing:
sets with more than ``1 - similarity`` of their n-grams unique cannot be similar to any other. The
first n-grams, ``FIRST`` of the order, counted one by one, already show this for most sets, which are then gone; only
the rest send all fragments, and n-grams that occur once among them are dropped.

Candidates: with unique n-grams first, then by ``(frequency, hash)``, two similar sets share one of
the first ``n - ceil(similarity * n) + 1`` n-grams of each. Only pairs of a set and the leader of
such an n-gram are compared first, the leader of most of its n-grams before the others: overlaps are counted per fragment and
summed per pair, exactly. The leader is the member whose n-grams are the most frequent on average,
so of edited copies it is the one they were made from. Linked sets are joined into components; then
only sets of *different* components that share such an n-gram are compared, unless their numbers of
shared n-grams inside and outside of their leader, the classes of the n-grams in which they differ from it, or
the triangle inequality of the Jaccard distance through it, prove that they are not similar. So a group of copies
costs its size, not its square, and no link between different components is lost.

Sets are named by a 64-bit hash of their content; documents with equal sets are one set. No step
gathers documents, links or components on the driver.

Cases: a null or empty text, or one without words, has the empty set: no n-grams, a component of its
own; fewer words than ``n`` make one shingle of all words; rows that repeat an id are members like
others, the component id is the smallest id of all, null ids come last and are named only if all ids
of a component are null; ties and repeated rows are equal sets; an empty table gives no rows; other
columns are ignored. Hashes have 64 bits: a pair of different shingles agrees with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import LOWER, UPPER, give_back, giving_back, stored
from logloom.plans.joins import attach
from logloom.session import settle

SHINGLE = 5
SIMILARITY = 80
#: Of the n-grams, eight bytes each, of the sets that are left after the first n-grams.
FRAGMENT_BYTES = 8_000_000
#: Share of the global order that is looked at first.
FIRST = 5 / 16
#: Fragments in which the overlaps of candidate pairs are counted.
PARTS = 8
_WORDS = 200_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the distinct shingles of a text, sorted."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > _WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        out = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            out = _mixed(out * _MULT + codes[i : len(codes) - n + 1 + i])
        return np.unique(out)


def _set_key(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def set_members(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``doc_id, text_key, key, n``: the set of each row; ``key`` is null for the empty set."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            keys, sizes = [], []
            for text in batch.column(2):
                hashes = shingler.hashes(text.as_py())
                keys.append(_set_key(hashes) if len(hashes) else None)
                sizes.append(len(hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "text_key", "key", "n"])

    return rows.mapInArrow(giving_back(work), "doc_id long, text_key long, key long, n long")


def _first_grams(docs: DataFrame, text_col: str, n: int, share: float) -> DataFrame:
    """``key, gram``: the n-grams of the set of each row in the first ``share`` of the order."""
    top = np.uint64(min(int(share * (1 << 64)), (1 << 64) - 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, ends, grams = [], [], []
                for text in batch.column(0).slice(at, 256):
                    hashes = shingler.hashes(text.as_py())
                    if len(hashes):
                        keys.append(_set_key(hashes))
                        grams.append(hashes[: np.searchsorted(hashes, top)])
                        ends.append(len(grams[-1]))
                if keys:
                    owners = np.repeat(np.array(keys, np.int64), ends)
                    yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.concatenate(grams).view(np.int64))], ["key", "gram"])

    return docs.select(text_col).mapInArrow(giving_back(work), "key long, gram long")


def _fragments(docs: DataFrame, text_col: str, n: int, n_fragments: int) -> DataFrame:
    """``fragment, key, n, gram``: the n-grams of the set of each row, by fragment of the order; as many rows at any ``n_fragments``."""
    bounds = np.array([((1 << 64) - 1) * i // n_fragments for i in range(1, n_fragments)], np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [h for h in (shingler.hashes(text.as_py()) for text in batch.column(0).slice(at, 256)) if len(h)]
                if found:
                    lengths = [len(h) for h in found]
                    keys, sizes = np.repeat(np.array([_set_key(h) for h in found], np.int64), lengths), np.repeat(lengths, lengths)
                    grams = np.concatenate(found)
                    cells = np.searchsorted(bounds, grams, "right"), keys, sizes, grams.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["fragment", "key", "n", "gram"])

    return docs.select(text_col).mapInArrow(giving_back(work), "fragment long, key long, n long, gram long")


def _gathered(table: pa.Table) -> pa.Table:
    """``key, n, part`` of the rows of one fragment: the distinct n-grams of each set, eight bytes each."""
    keys, sizes, grams = (table[c].to_numpy() for c in ("key", "n", "gram"))
    grams = grams.view(np.uint64)
    order = np.lexsort((grams, keys))
    keys, sizes, grams = keys[order], sizes[order], grams[order]
    # Rows of equal sets are equal.
    new = np.append(True, (keys[1:] != keys[:-1]) | (grams[1:] != grams[:-1]))[: len(keys)]
    keys, sizes, grams = keys[new], sizes[new], grams[new]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    offsets = (8 * np.append(first, len(keys))).astype(np.int32)
    parts = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(grams.tobytes())])
    return pa.table({"key": pa.array(keys[first]), "n": pa.array(sizes[first]), "part": parts})


def _fragment_grams(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of one fragment: distinct sets with their sizes, and owner, n-gram and frequency of each entry."""
    keys = table["key"].to_numpy()
    parts = table["part"].to_pylist()
    distinct, first = np.unique(keys, return_index=True)  # rows of equal sets are equal
    lengths = np.array([len(parts[i]) // 8 for i in first], np.int64)
    owner = np.repeat(np.arange(len(distinct), dtype=np.int32), lengths)
    grams = np.frombuffer(b"".join([parts[i] for i in first]), np.uint64)
    del parts
    order = np.argsort(grams, kind="stable")
    owner, grams = owner[order], grams[order]
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    counts = np.diff(np.append(starts, len(grams)))
    return distinct, table["n"].to_numpy()[first], owner, grams, np.repeat(counts, counts)


def _shared_parts(table: pa.Table) -> pa.Table:
    """Of one fragment: per set, its n-grams that other sets have too, with their frequency."""
    distinct, sizes, owner, grams, frequency = _fragment_grams(table)
    shared = frequency > 1
    owner, grams, frequency = owner[shared], grams[shared], frequency[shared]
    order = np.argsort(owner, kind="stable")
    owner, grams, frequency = owner[order], grams[order], frequency[order].astype(np.int32)
    have, at = np.unique(owner, return_index=True)
    offsets = pa.array(np.append(at, len(owner)), pa.int32())
    return pa.table(
        {
            "key": pa.array(distinct[have], pa.int64()),
            "n": pa.array(sizes[have], pa.int64()),
            "grams": pa.ListArray.from_arrays(offsets, pa.array(grams.view(np.int64))),
            "frequency": pa.ListArray.from_arrays(offsets, pa.array(frequency)),
        }
    )


def _shared_parts_giving_back(table: pa.Table) -> pa.Table:
    """As :func:`_shared_parts`, also of rows of one n-gram each; a worker holds no more between fragments than before."""
    try:
        return _shared_parts(_gathered(table) if "gram" in table.column_names else table)
    finally:
        give_back()


def least_overlap(n: Column, similarity: int) -> Column:
    """The fewest n-grams that a set of ``n`` shares with any similar set: ``ceil(similarity * n / 100)``."""
    return F.floor((n * similarity + 99) / 100).cast("bigint")


def _prefixes(survivors: DataFrame, similarity: int) -> DataFrame:
    """``key, n, shared, weight, gram``: the shared n-grams among the first ``n - least_overlap + 1`` of each
    set; ``weight`` is the mean frequency of all its n-grams."""
    names = ["key", "n", "shared", "weight", "gram"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, lengths = [], [], []
            for i, (key, n, shared) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)):
                grams, frequency = (batch.column(c)[i].values.flatten().to_numpy() for c in (3, 4))
                wanted = n - (n * similarity + 99) // 100 + 1 - (n - shared)
                some = np.lexsort((grams, frequency))[:wanted]
                rows.append((key, n, shared, (int(frequency.sum()) + n - shared) / n))
                lengths.append(len(some))
                out.append(grams[some])
            if rows:
                kinds = np.int64, np.int64, np.int64, np.float64
                columns = [pa.array(np.repeat(np.array(c, k), lengths)) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(out))], names)

    picked = survivors.select("key", "n", "shared", "grams", "frequency")
    return picked.mapInArrow(giving_back(work), "key long, n long, shared long, weight double, gram long")


def _parts(survivors: DataFrame) -> DataFrame:
    """``key, part, list``: the shared n-grams of a set, cut at fixed places of the global order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, lists = [], [], []
            for i, key in enumerate(batch.column(0).to_pylist()):
                grams = batch.column(1)[i].values.flatten().to_numpy()
                part = (grams.view(np.uint64) >> np.uint64(61)).astype(np.int64) * PARTS // 8
                for p in np.unique(part):
                    keys.append(key)
                    places.append(int(p))
                    lists.append(grams[part == p])
            kinds = pa.int64(), pa.int64(), pa.list_(pa.int64())
            arrays = [pa.array(c, k) for c, k in zip((keys, places, lists), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "part", "list"])

    return survivors.select("key", "grams").mapInArrow(giving_back(work), "key long, part long, list array<long>")


def _overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """``a, b, common`` of the pairs: partial overlaps per fragment, summed."""
    left = parts.select(F.col("key").alias("a"), "part", F.col("list").alias("in_a"))
    right = parts.select(F.col("key").alias("b"), "part", F.col("list").alias("in_b"))
    partial = pairs.join(left, "a").join(right, ["b", "part"])
    return partial.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("in_a", "in_b"))).alias("common"))


def _differences(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """``a, b, lack, more`` of the pairs: 64 classes per part, a bit for each that holds an n-gram of ``b`` that ``a``
    lacks, or one of ``a`` that ``b`` lacks."""

    def classes(grams: Column) -> Column:
        def add(bits: Column, gram: Column) -> Column:
            return bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), gram.bitwiseAND(F.lit(63)).cast("int")))

        return F.aggregate(grams, F.lit(0).cast("bigint"), add)

    def in_part(column: str) -> Column:
        # A part without any n-gram has no class.
        return F.array(*[F.coalesce(F.max(F.when(F.col("part") == p, F.col(column))), F.lit(0).cast("bigint")) for p in range(PARTS)]).alias(column)

    sides = [pairs.select("a", "b", F.col(c).alias("key")).join(parts, "key").select("a", "b", "part", F.lit(c).alias("side"), "list") for c in "ab"]
    both = sides[0].unionByName(sides[1]).groupBy("a", "b", "part")
    lists = [F.coalesce(F.first(F.when(F.col("side") == c, F.col("list")), True), F.array().cast("array<bigint>")).alias(f"in_{c}") for c in "ab"]
    bits = [classes(F.array_except(*names)).alias(name) for name, names in (("lack", ("in_b", "in_a")), ("more", ("in_a", "in_b")))]
    return both.agg(*lists).select("a", "b", "part", *bits).groupBy("a", "b").agg(in_part("lack"), in_part("more"))


def _only_in(one: str, other: str) -> Column:
    """The number of classes that are set in ``one`` and not in ``other``."""
    return F.aggregate(F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda n, x: n + x)


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``key, component`` of every key in ``links`` (``a, b``): the smallest key it is linked with.

    Alternating large-star and small-star steps: every key is tied to the smallest neighbour, until
    nothing changes. Each step is two aggregations and leaves at most as many links as before.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        tied = both.join(least, "a")
        if large:
            return tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        own = least.select("a", F.col("m").alias("b"))
        return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).filter("a <> b").distinct()

    def state(edges: DataFrame) -> tuple:
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edges)
    for _ in range(rounds):
        edges = stored(star(star(edges, True), False), "links")
        now = state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    settle(links.sparkSession)
    own = edges.groupBy("b").agg(F.min("b").alias("component")).withColumnRenamed("b", "key")
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(own)


def _linked(common: Column, n_a: Column, n_b: Column, similarity: int) -> Column:
    return 100 * common >= similarity * (n_a + n_b - common)


def _candidates(docs: DataFrame, members: DataFrame, text_col: str, n: int, similarity: int) -> tuple[DataFrame, int]:
    """The rows of ``docs`` whose sets may be similar to another, by the first n-grams of the order, and the
    number of their n-grams."""
    # One row per n-gram and document, so rows grow with the text; rows of equal sets are equal.
    first = _first_grams(docs, text_col, n, FIRST).repartition("gram")
    alone = first.groupBy("gram").agg(F.min("key").alias("key"), F.max("key").alias("last")).filter("key = last")
    sizes = members.filter("key is not null").groupBy("key").agg(F.first("n").alias("n"))
    counts = alone.groupBy("key").agg(F.count(F.lit(1)).alias("alone")).join(sizes, "key")
    gone = counts.filter(F.col("n") - F.col("alone") < least_overlap(F.col("n"), similarity)).select("key")
    left = members.filter("key is not null").join(gone, "key", "left_anti")
    left = stored(left.groupBy("text_key").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("rows")), "near-left")
    n_grams = left.agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0
    # Broadcast up to a measured size, joined by shuffle beyond it.
    rows = docs.select(F.xxhash64(text_col).alias("text_key"), text_col)
    return attach(rows, left.select("text_key"), ["text_key"], "left_semi"), n_grams


def _measured(pairs: DataFrame, sizes: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    """``a, b, n_a, n_b, common`` of the pairs ``a, b, n_a``."""
    sized = pairs.join(sizes.select(F.col("k").alias("b"), F.col("size").alias("n_b")), "b")
    return stored(sized.join(_overlaps(pairs.select("a", "b"), parts), ["a", "b"], "left").fillna(0, "common"), name)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs that lie in different components of ``found``."""
    one, other = (found.select(F.col("key").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
    with_both = pairs.join(one, "a", "left").join(other, "b", "left")
    return with_both.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).drop("of_a", "of_b")


def set_components(docs: DataFrame, members: DataFrame, text_col: str, n: int, similarity: int, fragment_bytes: int) -> DataFrame:
    """``key, component`` of every set that is linked with another; ``members`` are the stored sets of ``docs``."""
    few, n_grams = _candidates(docs, members, text_col, n, similarity)
    n_fragments = max(1, -(-8 * n_grams // fragment_bytes))
    schema = "key long, n long, grams array<long>, frequency array<int>"
    shared = _fragments(few, text_col, n, n_fragments).groupBy("fragment").applyInArrow(_shared_parts_giving_back, schema)
    sets = shared.groupBy("key").agg(
        F.first("n").alias("n"),
        F.sum(F.size("grams")).alias("shared"),
        F.collect_list("grams").alias("grams"),
        F.collect_list("frequency").alias("frequency"),
    )
    survivors = stored(sets.filter(F.col("shared") >= least_overlap(F.col("n"), similarity)), "near-sets")
    prefixes = stored(_prefixes(survivors, similarity), "near-prefixes")
    parts = stored(_parts(survivors), "near-parts")

    sizes = survivors.select(F.col("key").alias("k"), F.col("n").alias("size"))
    leaders = prefixes.groupBy("gram").agg(F.max_by("key", F.struct("weight", "key")).alias("leader"), F.count(F.lit(1)).alias("members"))
    led = stored(prefixes.join(leaders.filter("members > 1"), "gram").drop("members"), "near-led")
    pairs = led.filter("key <> leader").groupBy(F.col("key").alias("a"), F.col("leader").alias("b"))
    pairs = stored(pairs.agg(F.first("n").alias("n_a"), F.count(F.lit(1)).alias("times")), "near-pairs")

    def links_of(measured: DataFrame) -> DataFrame:
        return measured.filter(_linked(F.col("common"), F.col("n_a"), F.col("n_b"), similarity)).select("a", "b")

    # Each set is first compared with the leader of most of its n-grams; of its other leaders, only with
    # those that this has not linked it with, so the members of a group of copies are compared once each.
    closest = pairs.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b"), F.first("n_a").alias("n_a"))
    known = _measured(closest, sizes, parts, "near-closest")
    linked = stored(components(links_of(known)), "near-components")
    others = _apart(pairs.drop("times").join(known.select("a", "b"), ["a", "b"], "left_anti"), linked)
    more = _measured(others, sizes, parts, "near-measured")
    tied = linked.select(F.col("key").alias("a"), F.col("component").alias("b"))
    first = stored(components(tied.unionByName(links_of(more))), "near-components")
    known = known.unionByName(more)

    # What is left: sets of different components that share a prefix n-gram and may yet be similar.
    members = led.join(first, "key", "left").select("gram", "leader", "key", "n", "shared", F.coalesce("component", "key").alias("component"))
    members = stored(members, "near-members")
    mixed = members.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("gram")
    open_ = members.join(mixed, "gram")
    # The largest component of an n-gram is compared with the others, never with itself.
    per_part = open_.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = per_part.groupBy("gram").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    open_ = stored(open_.join(largest, "gram"), "near-open")
    # Only here are distances to leaders of the same component needed.
    unknown = open_.filter("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b"), F.col("n").alias("n_a")).distinct()
    known = known.unionByName(_measured(unknown.join(known.select("a", "b"), ["a", "b"], "left_anti"), sizes, parts, "near-inner"))
    # A leader shares all its n-grams with itself.
    far = (1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))).alias("far")
    open_ = open_.join(known.select(F.col("a").alias("key"), F.col("b").alias("leader"), "common", far), ["key", "leader"], "left")
    open_ = open_.withColumns({"far": F.coalesce("far", F.lit(0.0)), "common": F.coalesce("common", "n")})
    settle(docs.sparkSession)
    none = F.array_repeat(F.lit(0).cast("bigint"), PARTS)
    bits = stored(_differences(unknown.select("a", "b"), parts), "near-bits").select(F.col("a").alias("key"), F.col("b").alias("leader"), "lack", "more")
    open_ = open_.join(bits, ["key", "leader"], "left").withColumns({c: F.coalesce(c, none) for c in ("lack", "more")})
    open_ = stored(open_.withColumn("other", F.greatest(F.col("shared") - F.col("common"), F.lit(0))), "near-far")
    names = ("key", "n", "shared", "component", "far", "common", "other", "lack", "more")
    x = open_.filter("component <> main").select("gram", *[F.col(c).alias(f"x_{c}") for c in names])
    y = open_.select("gram", "main", *[F.col(c).alias(f"y_{c}") for c in names])
    # An n-gram of the leader that only y lacks is one of x that y does not have; so is one that only x has beside it.
    inside = F.least(F.col("x_common") - _only_in("y_lack", "x_lack"), F.col("y_common") - _only_in("x_lack", "y_lack"))
    outside = F.least(F.col("x_other") - _only_in("x_more", "y_more"), F.col("y_other") - _only_in("y_more", "x_more"))
    may = (
        (F.col("x_component") != F.col("y_component"))
        & ((F.col("y_component") == F.col("main")) | (F.col("x_key") < F.col("y_key")))
        & (100 * F.least("x_n", "y_n") >= similarity * F.greatest("x_n", "y_n"))
        & _linked(F.least("x_shared", "y_shared"), F.col("x_n"), F.col("y_n"), similarity)
        & (F.abs(F.col("x_far") - F.col("y_far")) <= 1 - similarity / 100 + 1e-9)
        # What two sets share lies in both's common part with the leader, or in both's shared n-grams outside it.
        & _linked(F.least("x_common", "y_common") + F.least("x_other", "y_other"), F.col("x_n"), F.col("y_n"), similarity)
        & _linked(inside + outside, F.col("x_n"), F.col("y_n"), similarity)
    )
    rest = x.join(y, "gram").filter(may)
    rest = rest.select(
        F.least("x_key", "y_key").alias("a"),
        F.greatest("x_key", "y_key").alias("b"),
        F.when(F.col("x_key") < F.col("y_key"), F.col("x_n")).otherwise(F.col("y_n")).alias("n_a"),
        F.when(F.col("x_key") < F.col("y_key"), F.col("y_n")).otherwise(F.col("x_n")).alias("n_b"),
    ).distinct()
    rest = stored(rest, "near-rest")
    more = rest.join(_overlaps(rest.select("a", "b"), parts), ["a", "b"]).filter(_linked(F.col("common"), F.col("n_a"), F.col("n_b"), similarity))
    return components(first.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = SHINGLE,
    similarity: int = SIMILARITY,
    fragment_bytes: int = FRAGMENT_BYTES,
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, keeper``: one row per input row.

    ``keeper`` is true for the row of each component with the smallest id.
    """
    members = stored(set_members(docs, id_col, text_col, n), "near-rows")
    found = set_components(docs, members, text_col, n, similarity, fragment_bytes)
    # A row without words is a group of its own; other rows are grouped by their set's component.
    rows = members.join(found, "key", "left").withColumn("group", F.coalesce("component", "key"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    rows = stored(rows.select("doc_id", "text_key", "n", "group", row.alias("row")), "near-grouped")
    tops = rows.filter("group is not null").groupBy("group").agg(F.min("row").alias("top"))
    out = rows.join(tops, "group", "left")
    return out.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"),
        (F.col("top").isNull() | (F.col("row") == F.col("top"))).alias("keeper"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, all columns unchanged.

    Rows that agree in id and text are one document.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.filter("not keeper").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs[id_col].cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(docs[text_col]) == F.col("_key"))
    return docs.join(gone, same, "left_anti")
