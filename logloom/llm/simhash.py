"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is the majority of that bit over the 64-bit hashes of all word shingles. Equal
fingerprints are one. Fingerprints are cut into two segments of 32 bits: of two that differ in at most
four bits, either the first segments differ in at most two or the second ones in at most one. Every
fingerprint enters the table of a segment under the 33 keys of the Hamming ball of radius one around
its segment; two segments within two bits share such a key, and within one bit one that is the
segment itself of either. Entries that meet are verified by their complete distance.

A key under which more than ``CROWD`` different fingerprints meet is not paired up. Its members are
*crowded*: they are linked with each other through balls of radius two around whole fingerprints (2,081
centres each). Two that differ in at most four bits share a centre, and all members of a centre are
within four bits of each other, so each is tied to the smallest and the work grows with the members and
not with their pairs. A centre has at most 2,081 members. So every link is kept and no
list is unbounded.

Components come from alternating star steps over stored links.

Cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other;
fewer words than ``n`` make one shingle; a bit set in exactly half of the hashes is 0; rows that repeat
an id are members like others; null ids are named only if all ids of a component are null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import LOWER, UPPER, stored
from logloom.llm.near_dup import components
from logloom.plans.joins import attach_materialized

SHINGLE = 4
SEED = 42
#: Fingerprints that differ in at most so many bits are linked; the segments' radii follow from it.
DISTANCE = 4
#: Members of one key that are still compared pair by pair.
CROWD = 64
#: Shingles whose bits are counted at once.
_HASHES = 1 << 18
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[min(n, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(last), _HASHES):
        some = [digest(body[s:e], seed) for s, e in zip(starts[at : at + _HASHES], last[at : at + _HASHES], strict=False)]
        bits = np.unpackbits(np.array(some, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(last)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp``: the fingerprint of each row as a signed 64-bit number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), n, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "doc_id long, fp long")


def distance(a: Column, b: Column) -> Column:
    """The number of bits in which two fingerprints differ."""
    return F.bit_count(a.bitwiseXOR(b))


def segment_balls(prints: DataFrame) -> DataFrame:
    """``segment, key, own, fp``: each fingerprint under the keys of its segments' balls of radius one."""
    flips = F.array(*[F.lit(m).cast("bigint") for m in (0, *[1 << i for i in range(32)])])
    parts = F.array(
        F.struct(F.lit(0).alias("segment"), F.shiftrightunsigned("fp", 32).alias("part")),
        F.struct(F.lit(1).alias("segment"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("part")),
    )
    cut = prints.select("fp", F.explode(parts).alias("s")).select("fp", "s.segment", "s.part", F.explode(flips).alias("flip"))
    return cut.select("segment", F.col("part").bitwiseXOR(F.col("flip")).alias("key"), (F.col("flip") == 0).alias("own"), "fp")


def _verified(pairs: DataFrame) -> DataFrame:
    return pairs.filter(distance(F.col("a"), F.col("b")) <= DISTANCE)


def crowd_links(members: DataFrame) -> DataFrame:
    """``a, b``: links that tie together all of ``members (fp)`` within the distance, through shared centres."""
    # The ball of a member: no bit, one bit or two bits flipped; place 64 flips nothing.
    first = members.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
    both = first.select("fp", "i", F.explode(F.sequence(F.least(F.col("i") + 1, F.lit(64)), F.lit(64))).alias("j"))

    def bit(place: str) -> Column:
        return F.when(F.col(place) < 64, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(place))).otherwise(F.lit(0).cast("bigint"))

    centres = both.select("fp", F.col("fp").bitwiseXOR(bit("i")).bitwiseXOR(bit("j")).alias("centre"))
    met = centres.groupBy("centre").agg(F.collect_list("fp").alias("met")).filter(F.size("met") > 1)
    tied = met.select(F.array_min("met").alias("b"), F.explode("met").alias("a")).filter("a <> b")
    return tied.select("a", "b").distinct()


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``a, b``: enough links between the distinct fingerprints ``prints (fp)`` to join all that are linked."""
    balls = segment_balls(prints)
    # A pair may meet in the second segment only where one of them is at home.
    counts = balls.groupBy("segment", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"), F.max("own").alias("home")
    )
    shared = stored(counts.filter((F.col("n") > 1) & ((F.col("segment") == 0) | F.col("home"))), "simhash-keys")
    pairs = _verified(shared.filter("n = 2").select("a", "b"))

    several = stored(shared.filter("n > 2").select("segment", "key", "n"), "simhash-several")
    entries = stored(attach_materialized(balls, several, ["segment", "key"], "inner"), "simhash-entries")
    few = entries.filter(F.col("n") <= crowd)
    left = few.select("segment", "key", F.col("own").alias("own_a"), F.col("fp").alias("a"))
    right = few.select("segment", "key", F.col("own").alias("own_b"), F.col("fp").alias("b"))
    met = left.join(right, ["segment", "key"]).filter((F.col("a") < F.col("b")) & ((F.col("segment") == 0) | F.col("own_a") | F.col("own_b")))
    crowded = entries.filter(F.col("n") > crowd).select("fp").distinct()
    return pairs.unionByName(_verified(met.select("a", "b")).distinct()).unionByName(crowd_links(crowded))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, crowd: int = CROWD
) -> DataFrame:
    """``doc_id, fp, component_id``: one row per input row, with the smallest id it is linked with."""
    rows = stored(fingerprints(docs, id_col, text_col, n), "simhash-rows")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tied = components(links(stored(prints.select("fp"), "simhash-prints"), crowd))
    grouped = prints.join(tied.withColumnRenamed("key", "fp"), "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    grouped = stored(grouped.select("fp", "least", "group"), "simhash-grouped")
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stored(grouped.join(least, "group").select("fp", "component_id"), "simhash-named")
    return attach_materialized(rows, named, ["fp"], "left").select("doc_id", "fp", "component_id")
