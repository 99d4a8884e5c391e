"""Phrase collocations from a weighted de Bruijn graph.

Nodes are phrases of three words, edges the phrases of four that lead from the first three to the last
three, weighted by how often they occur. Only edges are counted over the corpus: each place of a piece
gives the edge that begins there, and the last three places of a piece give edges that run into its end.
The count of a shorter phrase is then the flow out of it, the sum of the edges that begin with it; edges
into the end of a piece are the correction for occurrences that nothing follows.

1. *Chunks.* Each task collects words until it has four million places or 65,000 different words in a
   language, sums equal edges, and sends each bucket its edges as arrays over a dictionary of the words that
   they use. An edge's bucket is a hash of its first two words, so that a bucket knows the counts of all
   its phrases of two to four words. Two words that begin more than a bucket's fair share of a chunk's edges (as
   "of the" does) are *split*: their edges go to further buckets by the third word as well, and a mark in
   their own bucket says so.
2. *Buckets.* Each bucket sums its edges and gives phrases that occur often enough. Of split pairs and of
   single words, parts of which may lie in other buckets, it gives all partial sums, which are added up.
3. *Graph.* A node is unary when one edge into it and one out of it weigh as much as the node: all its
   occurrences lie on that way. Edges are joined through unary nodes into paths, by doubling over stored
   tables. Inside a path nothing occurs on its own, so its nodes are dropped; the other phrases
   are compared with the longer ones that hold them. A phrase of two words longer holds one of one word
   more that is as frequent or more, so only phrases of one word more need be compared.

Words are compared as such, not by hashes. Counts are exact; products are decimals of 38 digits.

Cases: a null text is empty, a null language is ``und``; empty and repeated rows count like others; very
long texts are cut into stretches that keep three words of context; ids are not used; an empty table
gives no rows; phrases with equal scores and counts are ordered by their bytes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import LOWER, UPPER, stored

#: Words of an edge; nodes have one less.
LONGEST = 4
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
#: A phrase is dropped if a longer one that holds it has at least so many percent of its occurrences.
CONTAINED = 80
#: Bytes of text per bucket.
BUCKET_BYTES = 8 << 20
_PLACES = 4_000_000
_WORDS = 65_000
_ALL_WORDS = 400_000
_STRETCH = 30_000
_SEND = 8 << 20
_END, _SPLIT = 0, 1
_MULT = np.uint64(0x9E3779B97F4A7C15)
# The characters that end a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWERED = bytes.maketrans(UPPER.encode() + _ENDS + b"\t", LOWER.encode() + b"." * len(_ENDS) + b" ")
_PACKED = "bucket long, lang string, words binary, edges binary, counts binary"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; ``b"."`` ends a piece."""
    return (text or "").encode("utf-8", "replace").translate(_LOWERED).replace(b".", b" . ").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Chunk:
    """Edges of one language in a task, over a dictionary of at most 65,536 words."""

    def __init__(self):
        self.words: dict[bytes, int] = {b".": _END, b"": _SPLIT}
        self.parts: list[np.ndarray] = []
        self.context: list[np.ndarray] = []
        self.places = 0

    def add(self, words: list[bytes], n_context: int) -> None:
        """``words`` of a document; the last ``n_context`` only follow others."""
        known = self.words
        for w in set(words).difference(known):
            known[w] = len(known)
        self.parts.append(np.fromiter(map(known.__getitem__, words), np.uint16, len(words)))
        follows = np.zeros(len(words) + 1, bool)
        follows[len(words) - n_context : len(words)] = True
        self.parts.append(np.zeros(1, np.uint16))
        self.context.append(follows)
        self.places += len(words)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct edges as four word numbers each, and their counts."""
        ids = np.concatenate([*self.parts, np.zeros(LONGEST, np.uint16)])
        begins = np.flatnonzero((ids[:-LONGEST] != _END) & ~np.concatenate(self.context))
        key = ids[begins].astype(np.uint64)
        ended = np.zeros(len(begins), bool)
        for k in range(1, LONGEST):
            step = ids[begins + k]
            ended |= step == _END
            key = key << np.uint64(16) | np.where(ended, _END, step).astype(np.uint64)
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        counts = np.diff(np.append(first, len(key))).astype(np.uint32)
        return key[first].astype(">u8").view(">u2").reshape(-1, LONGEST).astype(np.uint16), counts

    def packed(self, lang: str, n_buckets: int) -> Iterator[tuple]:
        """``bucket, lang, words, edges, counts`` for each bucket that has edges of this chunk."""
        edges, counts = self.edges()
        if not len(edges):
            return
        names = list(self.words)
        # Languages have their own words, also where they look the same.
        codes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        codes = codes * _MULT + np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        pair = _mixed(_mixed(codes[edges[:, 0]]) * _MULT + codes[edges[:, 1]])
        bucket = (pair % np.uint64(n_buckets)).astype(np.int64)
        # Edges are sorted, so those of a pair lie together.
        new = np.flatnonzero(np.concatenate(([True], np.any(edges[1:, :2] != edges[:-1, :2], axis=1))))
        sizes = np.diff(np.append(new, len(edges)))
        split = (sizes * n_buckets > len(edges)) & (sizes > LONGEST) & (n_buckets > 1)
        if split.any():
            of_split = np.repeat(split, sizes)
            spread = _mixed(pair * _MULT + codes[edges[:, 2]])
            bucket[of_split] = n_buckets + (spread[of_split] % np.uint64(n_buckets)).astype(np.int64)
            heads = new[split]
            marks = np.zeros((len(heads), LONGEST), np.uint16)
            marks[:, :2], marks[:, 2] = edges[heads, :2], _SPLIT
            bucket = np.concatenate((bucket, (pair[heads] % np.uint64(n_buckets)).astype(np.int64)))
            edges, counts = np.concatenate((edges, marks)), np.concatenate((counts, np.zeros(len(heads), np.uint32)))
        order = np.argsort(bucket, kind="stable")
        bucket, edges, counts = bucket[order], edges[order], counts[order]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket)).tolist()
        place = np.zeros(len(names), np.uint16)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            used = np.unique(edges[lo:hi])
            place[used] = np.arange(len(used), dtype=np.uint16)
            words = b"\n".join([names[i] for i in used.tolist()])
            yield int(bucket[lo]), lang, words, place[edges[lo:hi]].tobytes(), counts[lo:hi].tobytes()


def packed_edges(docs: DataFrame, text_col: str, lang_col: str, n_buckets: int) -> DataFrame:
    """``bucket, lang, words, edges, counts``: the edges of all texts, summed per chunk."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def flushed(chunks: dict[str, Chunk]) -> Iterator[pa.RecordBatch]:
        cells, size = [], 0
        for lang, chunk in chunks.items():
            for row in chunk.packed(lang, n_buckets):
                cells.append(row)
                size += sum(map(len, row[2:]))
                if size > _SEND:
                    yield _batch(cells)
                    cells, size = [], 0
        if cells:
            yield _batch(cells)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, Chunk] = {}
        places = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = tokens(text.as_py())
                for at in range(0, len(words), _STRETCH):
                    some = words[at : at + _STRETCH + LONGEST - 1]
                    chunk = chunks.setdefault(lang, Chunk())
                    # Flushed before a language's dictionary could outgrow 16 bits, or the task its memory.
                    known = sum(len(c.words) for c in chunks.values())
                    full = len(chunk.words) + len(some) > _WORDS and len(chunk.words) + len(set(some)) > _WORDS
                    if full or places > _PLACES or known > _ALL_WORDS:
                        yield from flushed(chunks)
                        chunks, places = {}, 0
                        chunk = chunks.setdefault(lang, Chunk())
                    chunk.add(some, max(0, len(some) - _STRETCH))
                    places += len(some)
        yield from flushed(chunks)

    def _batch(cells: list[tuple]) -> pa.RecordBatch:
        kinds = pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()
        columns = [pa.array(c, k) for c, k in zip(zip(*cells, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "lang", "words", "edges", "counts"])

    return rows.mapInArrow(work, _PACKED)


def _sums(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the sorted ``key`` (columns) changes, and the sums of ``counts`` between them."""
    first = np.flatnonzero(np.concatenate(([True], np.any(key[1:] != key[:-1], axis=1))))
    return first, np.add.reduceat(counts, first)


def bucket_counts(table: pa.Table, n_buckets: int, min_count: int) -> pa.Table:
    """Of one bucket: ``lang, n_words, phrase, n``, whole counts of frequent phrases and partial sums of others."""
    home = table["bucket"][0].as_py() < n_buckets
    out: dict[str, list] = {"lang": [], "n_words": [], "phrase": [], "n": []}
    langs = table["lang"].to_pylist()
    cells = [table[c].to_pylist() for c in ("words", "edges", "counts")]
    for lang in dict.fromkeys(langs):
        known: dict[bytes, int] = {b".": _END, b"": _SPLIT}
        edges, counts = [], []
        for i, at in enumerate(langs):
            if at == lang:
                words = cells[0][i].split(b"\n")
                for w in words:
                    known.setdefault(w, len(known))
                ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                edges.append(ids[np.frombuffer(cells[1][i], np.uint16).reshape(-1, LONGEST)])
                counts.append(np.frombuffer(cells[2][i], np.uint32).astype(np.int64))
        edge, count = np.concatenate(edges), np.concatenate(counts)
        wide = edge.astype(np.uint64)
        order = np.lexsort((wide[:, 2] << np.uint64(32) | wide[:, 3], wide[:, 0] << np.uint64(32) | wide[:, 1]))
        edge, count = edge[order], count[order]
        del edges, counts, wide, order
        names = list(known)
        marked = np.any(edge[:, 2:3] == _SPLIT, axis=1)
        pair_first, _ = _sums(edge[:, :2], count)
        split = np.logical_or.reduceat(marked, pair_first) if home else np.ones(len(pair_first), bool)
        split = np.repeat(split, np.diff(np.append(pair_first, len(edge))))
        for k in range(1, LONGEST + 1):
            first, total = _sums(edge[:, :k], count)
            last = edge[first, k - 1]
            # Of single words and split pairs other buckets may hold a part.
            partial = split[first] if k > 1 else np.ones(len(first), bool)
            wanted = (last != _END) & (last != _SPLIT) & (total > 0) & (partial | (total >= min_count))
            for ids, n in zip(edge[first[wanted], :k].tolist(), total[wanted].tolist(), strict=True):
                out["phrase"].append(b" ".join([names[i] for i in ids]))
                out["n"].append(n)
            out["n_words"] += [k] * int(wanted.sum())
            out["lang"] += [lang] * int(wanted.sum())
    return pa.table(
        {
            "lang": pa.array(out["lang"], pa.string()),
            "n_words": pa.array(out["n_words"], pa.int32()),
            "phrase": pa.array(out["phrase"], pa.binary()).cast(pa.string()),
            "n": pa.array(out["n"], pa.int64()),
        }
    )


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``lang, n_words, phrase, n`` (stored): all words, and the phrases of two to four that occur ``min_count`` times."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    packed = packed_edges(docs, text_col, lang_col, n_buckets)

    def count(table: pa.Table) -> pa.Table:
        return bucket_counts(table, n_buckets, min_count)

    partial = packed.groupBy("bucket").applyInArrow(count, "lang string, n_words int, phrase string, n long")
    whole = partial.groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("n"))
    return stored(whole.filter((F.col("n_words") == 1) | (F.col("n") >= min_count)), "phrases")


def first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def last_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", -k)


def unary_nodes(counts: DataFrame) -> DataFrame:
    """``lang, node, into, out``: nodes with one way through them, and its edges."""
    nodes = counts.filter(F.col("n_words") == LONGEST - 1).select("lang", F.col("phrase").alias("node"), "n")
    edges = counts.filter(F.col("n_words") == LONGEST).select("lang", F.col("phrase").alias("edge"), "n")
    into = edges.select("lang", "n", last_words(F.col("edge"), LONGEST - 1).alias("node"), F.col("edge").alias("into"))
    out = edges.select("lang", "n", first_words(F.col("edge"), LONGEST - 1).alias("node"), F.col("edge").alias("out"))
    on = ["lang", "node", "n"]
    return nodes.join(into, on).join(out, on).select("lang", "node", "into", "out")


def compact_paths(counts: DataFrame, unary: DataFrame) -> DataFrame:
    """``lang, head, place, edge``: every edge with the first edge of its path and its place on it.

    Every edge points back through a unary node at the edge before it; pointers double until all point at
    the first edge. A cycle of unary nodes cannot be: a piece that runs into it would have to go on for ever.
    """
    edges = counts.filter(F.col("n_words") == LONGEST).select("lang", F.col("phrase").alias("edge"))
    back = unary.select("lang", F.col("out").alias("edge"), F.col("into").alias("head"))
    steps = edges.join(back, ["lang", "edge"], "left")
    at_head = F.col("head").isNull()
    state = stored(steps.select("lang", "edge", F.coalesce("head", "edge").alias("head"), F.when(at_head, 0).otherwise(1).cast("bigint").alias("place")), "paths")
    while True:
        further = state.select("lang", F.col("edge").alias("head"), F.col("head").alias("next"), F.col("place").alias("more")).filter("more > 0")
        if state.join(further.select("lang", "head"), ["lang", "head"], "left_semi").isEmpty():
            return state
        jumped = state.join(further, ["lang", "head"], "left")
        jumped = jumped.select(
            "lang", "edge", F.coalesce("next", "head").alias("head"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place")
        )
        state = stored(jumped, "paths")


def path_texts(paths: DataFrame) -> DataFrame:
    """``lang, path, n_edges``: the words of every compacted path; as long as a passage that is repeated."""
    word = F.struct("place", last_words(F.col("edge"), 1).alias("word"))
    whole = paths.groupBy("lang", "head").agg(F.sort_array(F.collect_list(word)).alias("words"))
    rest = F.transform(F.expr("slice(words, 2, size(words) - 1)"), lambda w: w["word"])
    return whole.select("lang", F.concat_ws(" ", "head", rest).alias("path"), F.size("words").cast("bigint").alias("n_edges"))


def _wide(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def dropped_phrases(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """``lang, phrase``: phrases that mostly occur inside a longer one."""
    # An edge that is not the first of its path begins with an inner node.
    inside = paths.filter("place > 0").select("lang", first_words(F.col("edge"), LONGEST - 1).alias("phrase"))
    longer = counts.filter(F.col("n_words") > 2)
    halves = F.array(
        *[F.when(F.col("n_words") == k, f(F.col("phrase"), k - 1)) for k in range(3, LONGEST + 1) for f in (first_words, last_words)]
    )
    held = longer.select("lang", F.explode(F.array_compact(halves)).alias("phrase"), F.col("n").alias("longer"))
    most = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ = counts.filter("n_words > 1").join(inside, ["lang", "phrase"], "left_anti").join(most, ["lang", "phrase"])
    mostly = open_.filter(100 * _wide(F.col("longer")) >= CONTAINED * _wide(F.col("n")))
    return inside.unionByName(mostly.select("lang", "phrase"))


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score``: each phrase of two words or more with its lowest-scoring cut."""
    phrases = counts.filter("n_words > 1").withColumnRenamed("n", "a")
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"), "n_words")
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.call_function("substring_index", "phrase", F.lit(" "), F.col("k")).alias("left"),
        F.call_function("substring_index", "phrase", F.lit(" "), F.col("k") - F.col("n_words")).alias("right"),
    )
    l_side = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    r_side = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    sized = cuts.join(l_side, ["lang", "left"]).join(r_side, ["lang", "right"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    sized = sized.withColumn("score", score.cast("bigint"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return sized.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language."""
    counts = phrase_counts(docs, text_col, lang_col, min_count, bucket_bytes)
    totals = counts.filter("n_words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    often = stored(counts.filter(F.col("n") >= min_count), "phrases-often")
    paths = compact_paths(often, unary_nodes(often))
    kept = scored(often).join(dropped_phrases(often, paths), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
