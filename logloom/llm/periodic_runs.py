"""Runs of periodic words, found in tiles of every scale.

A run is a maximal stretch of words with smallest period ``q`` that is at least ``max(6, 4 * q)`` words
long. The places ``i`` with ``w[i] == w[i + q]`` of such a run form an interval of at least ``3 * q``
places, and runs are found as these intervals, one period octave ``[2**k, 2**(k + 1))`` at a time.

1. *Cut.* Boundaries lie at the multiples of ``2**(k + 1)``. A run of the octave has a boundary whose next
   ``2**k`` words come again one period later, and so has every boundary inside it up to its last such
   words. Hashes of ``2**k`` words (by doubling) tell which boundaries may be so; equal words always have
   equal hashes. Around each of them the document gives a tile, as word numbers: one boundary step before and
   three behind, so neighbouring tiles overlap. Tiles are rows and are dealt evenly to the tasks, also
   those of one long document. Text without repeats gives no tiles.
2. *Solve.* In each tile on its own, Z-functions of the words behind the boundary and of the reversed words
   before it say for every period of the octave how far the equality reaches on both sides.
3. *Stitch.* Fragments go to their (document, period), where overlapping or touching ones are joined;
   intervals of one period are always apart by a place that differs. Of equal stretches the smallest period stays:
   by the theorem of Fine and Wilf it divides the others.

Words are compared by numbers that a document's own dictionary gives, so decisions are exact. Documents
are keyed by id and a 64-bit hash of the text.

Cases: a null or empty text, or one without words, has no runs and an empty collapsed text; rows that repeat id
and text are one document and get the same result each; null ids are ids of their own; an empty table gives no
rows; very long texts are cut into tiles like others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import giving_back, stored, text_of
from logloom.plans.joins import attach_materialized

#: A run has at least so many words, and at least so many periods.
MIN_WORDS = 6
MIN_PERIODS = 4
#: Words that are cut at once; a longer document is cut alone.
_WORDS = 1 << 18
_TILE_BYTES = 4 << 20
#: Rows of a batch that are worked on at once.
_ROWS = 1024
_MULT = np.uint64(0x9E3779B97F4A7C15)
_KEYS = "doc_id long, text_key long"
_TILES = f"{_KEYS}, octave int, start long, boundary int, first boolean, last boolean, words binary"
_FRAGMENTS = f"{_KEYS}, period long, lo long, hi long"


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def z_function(s: list[int]) -> list[int]:
    """Of each place, the length of the longest common prefix of ``s`` and ``s[place:]``."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def candidate_boundaries(codes: np.ndarray, octaves: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave, the boundaries whose next ``2**k`` words may come again one period of the octave later."""
    grams = _mixed(codes.astype(np.uint64) * _MULT + np.uint64(1))
    for k in range(octaves):
        half = 1 << k
        place = np.arange(half, len(grams))
        place = place[(place & half) != 0]
        origin = place & ~(2 * half - 1)
        yield k, np.unique(origin[grams[place] == grams[origin]])
        grams = _mixed(grams[:-half] * _MULT + grams[half:]) if len(grams) > half else grams[:0]


def solve_tile(words: np.ndarray, boundary: int, octave: int, first: bool, last: bool) -> list[tuple[int, int, int]]:
    """``(period, lo, hi)`` in one tile: places ``lo <= i < hi`` around the boundary with ``w[i] == w[i + period]``.

    Intervals that end inside the tile on both sides and are too short for a run are left out.
    """
    half = 1 << octave
    longest = min(2 * half - 1, len(words) - boundary - 1)
    if longest < half:
        return []
    behind = z_function(words[boundary:].tolist())
    reach = min(boundary + longest, len(words))
    before = z_function([*words[:boundary][::-1].tolist(), -1, *words[:reach][::-1].tolist()])
    found = []
    for q in range(half, longest + 1):
        right = behind[q]
        if right < half:  # some boundary of every run has as many behind it
            continue
        left = min(before[1 + reach - q], boundary)
        whole = (left < boundary or first) and (right < len(words) - boundary - q or last)
        if whole and left + right + q < max(MIN_WORDS, MIN_PERIODS * q):
            continue
        found.append((q, boundary - left, boundary + right))
    return found


def _numbered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in one array, a number of its own behind each text, and where each text begins."""
    parts, starts, at, marks = [], [], 0, 0
    for text in texts:
        words = (text or "").encode("utf-8", "replace").split()
        numbers: dict[bytes, int] = {}
        for w in words:
            numbers.setdefault(w, len(numbers))
        marks += 1
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([-marks]))
        starts.append(at)
        at += len(words) + 1
    return np.concatenate(parts), np.array([*starts, at])


def tiles(docs: DataFrame) -> DataFrame:
    """The tiles of ``docs (doc_id, text_key, text)`` around boundaries that may lie in a run."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
        ids, keys, texts, size = [], [], [], 0
        for batch in batches:
            for i, key, text in zip(*batch.columns, strict=True):
                value = text.as_py()
                ids.append(i.as_py())
                keys.append(key.as_py())
                texts.append(value)
                size += len(value or "") // 4
                if size > _WORDS:
                    yield ids, keys, texts
                    ids, keys, texts, size = [], [], [], 0
        if ids:
            yield ids, keys, texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in groups(batches):
            codes, starts = _numbered(texts)
            longest = int(np.diff(starts).max()) - 1
            octaves = max((longest // MIN_PERIODS).bit_length(), 1 if longest >= MIN_WORDS else 0)
            rows, size = [], 0
            for k, boundaries in candidate_boundaries(codes, octaves):
                step = 2 << k
                owner = np.searchsorted(starts, boundaries, "right") - 1
                for b, d in zip(boundaries.tolist(), owner.tolist(), strict=True):
                    begin, end = int(starts[d]), int(starts[d + 1]) - 1
                    lo, hi = max(begin, b - step), min(end, b + 3 * step)
                    if b >= end or end - begin < max(MIN_WORDS, MIN_PERIODS << k):
                        continue
                    # Words of a tile fit 32 bits: a document has fewer different words.
                    words = codes[lo:hi].astype(np.int32).tobytes()
                    rows.append((ids[d], keys[d], k, lo - begin, b - lo, lo == begin, hi == end, words))
                    size += len(words) + 64
                    if size > _TILE_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "text_key", "octave", "start", "boundary", "first", "last", "words"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text_key", "text").mapInArrow(giving_back(work), _TILES)


def fragments(cut: DataFrame) -> DataFrame:
    """``doc_id, text_key, period, lo, hi``: what each tile says of the equalities around its boundary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            ids, keys, periods, los, his = [], [], [], [], []
            for i, key, octave, start, boundary, first, last, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for q, lo, hi in solve_tile(np.frombuffer(words, np.int32), boundary, octave, first, last):
                    ids.append(i)
                    keys.append(key)
                    periods.append(q)
                    los.append(start + lo)
                    his.append(start + hi)
            arrays = [pa.array(c, pa.int64()) for c in (ids, keys, periods, los, his)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "period", "lo", "hi"])

    return cut.mapInArrow(giving_back(work), _FRAGMENTS)


def stitched(parts: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, length, period``: the runs that the fragments make up."""
    line = Window.partitionBy("doc_id", "text_key", "period").orderBy("lo", "hi")
    so_far = F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = (so_far.isNull() | (F.col("lo") > so_far)).cast("int")
    piece = F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    numbered = parts.withColumn("opens", opens).withColumn("piece", piece)
    whole = numbered.groupBy("doc_id", "text_key", "period", "piece").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
    sized = whole.withColumn("length", F.col("hi") - F.col("start") + F.col("period"))
    long = sized.filter(F.col("length") >= F.greatest(F.lit(MIN_WORDS), MIN_PERIODS * F.col("period")))
    return long.groupBy("doc_id", "text_key", "start", "length").agg(F.min("period").alias("period"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, start, length, period`` of every run of ``docs``."""
    # Dealt by place: the tiles of one long document go to many tasks.
    dealt = tiles(keyed(docs, id_col, text_col)).repartition("doc_id", "text_key", "octave", "start")
    return stitched(fragments(dealt))


def by_exponent(runs: Column) -> Column:
    """Runs by ``length / period``, exactly and descending, then by start and period."""

    def order(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        case = F.when(a > b, -1).when(a < b, 1)
        for name in ("start", "period"):
            case = case.when(x[name] < y[name], -1).when(x[name] > y[name], 1)
        return case.otherwise(0)

    return F.array_sort(runs, order)


def collapsed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` as its kept words, joined by one space; ``runs`` says which words go.

    A word goes if any run contains it behind that run's first period.
    """
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    names = rows.columns
    text_at, runs_at = names.index("text"), names.index("runs")

    def kept(text: str | None, runs: list[dict] | None) -> bytes:
        words = (text or "").encode("utf-8", "replace").split()
        if runs:
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, [r["start"] + r["period"] for r in runs], 1)
            np.add.at(steps, [r["start"] + r["length"] for r in runs], -1)
            covered = np.cumsum(steps[:-1]) > 0
            words = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
        return b" ".join(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            texts = [kept(t.as_py(), r.as_py()) for t, r in zip(batch.column(text_at), batch.column(runs_at), strict=True)]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(giving_back(work), ", ".join(fields))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, runs``: one row per input row, its collapsed text and its runs by start and period."""
    found = periodic_runs(docs, id_col, text_col)
    run = F.struct("start", "period", "length")
    # Runs of a document are fewer than its words.
    per_doc = stored(found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(run)).alias("runs")), "runs")
    with_id = per_doc.select(F.struct("doc_id", "text_key").alias("key"), "runs")
    rows = keyed(docs, id_col, text_col).select(F.struct("doc_id", "text_key").alias("key"), "doc_id", "text")
    return collapsed(attach_materialized(rows, with_id, ["key"], "left").select("doc_id", "text", "runs"))
