"""Removal of repeated byte strings with suffix arrays and longest-previous-factor arrays.

A byte is repeated if it is covered by a string of ``length`` bytes that also starts elsewhere, in
the same text or another; matches never cross texts.

1. Anchors: of the ``length - GRAM + 1`` positions at which a gram of ``GRAM`` bytes starts in a string of
   ``length`` bytes, the leftmost with the smallest hash is its anchor. Equal strings have equal anchors,
   so only strings of the same anchor gram need be compared. The strings that share an anchor form one
   context: the bytes from the first string's start to the last one's end.
2. Of equal contexts in a batch of texts the first stands for all; the others are known to repeat and are
   dealt out evenly. So periodic texts, copies and boilerplate are pre-aggregated. One shuffle then brings
   the anchors of a gram together, as two hashes and places. Equal contexts repeat in full. Grams with one
   context are gone; of the rest, one context of each kind goes on.
3. Their bytes are fetched from the texts and, per gram, all strings are put in suffix order. Previous and
   next smaller positions in that order give the longest previous factor of each string, next and previous
   larger ones the longest later factor; both are cut at ``length``.
4. Covered spans go back to their texts, are joined, and what is left is kept.

``keep_first`` removes only what has an earlier copy, in the order of (id, text hash, position).

Texts are shuffled once, in buckets of about ``BUCKET_BYTES``; copies cost their size, not its square.
A gram's different contexts meet in one task: contexts that are equal over all their bytes, as in copies
and boilerplate, count once.

Cases: null and short texts repeat nothing; rows that repeat an id are told apart by their text, rows
that agree in both are each other's copies; null ids come last; an empty table gives no rows; other
columns are ignored. Grams and contexts are compared by 64-bit hashes each, strings byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LENGTH = 200
GRAM = 32
BUCKET_BYTES = 8 << 20
_SEGMENT = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NO_ID = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Anchors:
    """Anchors of texts; keeps powers of the hash base for one segment."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.window = length, gram, length - gram + 1
        self.bytes = _mixed(np.arange(1, 257, dtype=np.uint64))
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE))), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _INVERSE))), dtype=np.uint64)

    def of(self, data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays per segment: gram hash, context hash, anchor, first and last string start."""
        n_strings = len(data) - self.length + 1
        for at in range(0, n_strings, _SEGMENT):
            count = min(_SEGMENT, n_strings - at)
            part = np.frombuffer(data, np.uint8, count + self.length - 1, at)
            if len(part) >= len(self.up):
                self._grow(max(len(part), 2 * len(self.up)))
            sums = np.concatenate(([np.uint64(0)], np.cumsum(self.bytes[part] * self.down[: len(part)], dtype=np.uint64)))
            n_grams = len(part) - self.gram + 1
            grams = _mixed((sums[self.gram :] - sums[:n_grams]) * self.up[:n_grams])
            # Hash above, position below: the smallest is the leftmost of the smallest hash.
            low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(n_grams, dtype=np.uint64)
            width = 1
            while 2 * width <= self.window:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            low = np.minimum(low[:count], low[self.window - width :][:count])
            place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            last = np.append(first[1:], count) - 1
            anchor = place[first]
            end = last + self.length
            context = (sums[end] - sums[first]) * self.up[first]
            context = _mixed(context + _mixed(((anchor - first) << 16 | (last - first)).astype(np.uint64)))
            yield grams[anchor], context, anchor + at, first + at, last + at


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, c, id, key, x, lo, hi, copies``: gram and context hash, text, anchor, bytes before and string starts
    after it; ``copies`` counts equal contexts of the batch at the first of them and is 0 at the others, whose
    gram hash only deals them out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            cells, size = [], 0
            for id_, key, text in zip(*[batch.column(i) for i in range(3)], strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for h, c, x, first, last in finder.of(data):
                    n = len(h)
                    cells.append((h.view(np.int64), c.view(np.int64), np.full(n, id_.as_py()), np.full(n, key.as_py()), x, x - first, last - x))
                    size += n
                if size > 200_000:
                    yield out(cells)
                    cells, size = [], 0
            if cells:
                yield out(cells)

    def out(cells: list[tuple]) -> pa.RecordBatch:
        h, c, id_, key, x, lo, hi = (np.concatenate(a) for a in zip(*cells, strict=True))
        order = np.lexsort((x, key, id_, c, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
        first = np.flatnonzero(new)
        copies = np.zeros(len(order), np.int32)
        copies[order[first]] = np.diff(np.append(first, len(order)))
        spread = _mixed((h ^ key ^ (x << 20)).view(np.uint64)).view(np.int64)
        h = np.where(copies == 0, spread, h)
        arrays = h, c, id_.astype(np.int64), key, x, lo.astype(np.int16), hi.astype(np.int16), copies
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["h", "c", "id", "key", "x", "lo", "hi", "copies"])

    return texts.select("id", "key", "text").mapInArrow(work, "h long, c long, id long, key long, x long, lo short, hi short, copies int")


def previous_and_next_factors(positions: list, common: list[int], cut: int) -> tuple[list[int], list[int]]:
    """Longest previous and longest later factor of each suffix, both cut at ``cut``.

    ``positions`` are the suffixes' places in suffix order, ``common[i]`` the common prefix of entries ``i - 1``
    and ``i``. The longest earlier match of a suffix is with the nearest smaller position before or after it
    in suffix order, the longest later match with the nearest larger one.
    """
    n = len(positions)
    before, after = [0] * n, [0] * n
    for best, smaller in ((before, True), (after, False)):
        for order in (range(n), range(n - 1, -1, -1)):
            stack: list[tuple[int, int]] = []  # (entry, common prefix with the entry below it)
            for i in order:
                shared = common[i] if order.step == 1 else (common[i + 1] if i + 1 < n else 0)
                while stack and ((positions[stack[-1][0]] >= positions[i]) if smaller else (positions[stack[-1][0]] <= positions[i])):
                    shared = min(shared, stack.pop()[1])
                if stack:
                    best[i] = max(best[i], min(shared, cut))
                stack.append((i, shared if stack else cut))
    return before, after


def _repeats_of_gram(rows: list[tuple], length: int, keep_first: bool) -> Iterator[tuple[int, int, int, int]]:
    """Spans ``id, key, start, end`` of strings of one gram that have a copy; rows are its different contexts."""
    strings = []
    for r, (_, _, x, lo, hi, data) in enumerate(rows):
        strings += [(data[o : o + length], r, x - lo + o) for o in range(lo + hi + 1)]
    strings.sort(key=lambda s: s[0])
    order = {r: i for i, r in enumerate(sorted(range(len(rows)), key=lambda r: rows[r][:3]))}
    same = [False] + [a[0] == b[0] for a, b in zip(strings, strings[1:], strict=False)]
    spans: dict[int, list[int]] = {}
    i = 0
    while i < len(strings):
        j = i + 1
        while j < len(strings) and same[j]:
            j += 1
        if j - i > 1:
            places = [(order[r], at) for _, r, at in strings[i:j]]
            before, after = previous_and_next_factors(places, [0] + [length] * (j - i - 1), length)
            for k in range(i, j):
                if before[k - i] >= length or (not keep_first and after[k - i] >= length):
                    spans.setdefault(strings[k][1], []).append(strings[k][2])
        i = j
    for r, starts in spans.items():
        starts.sort()
        lo = prev = starts[0]
        for s in [*starts[1:], None]:
            if s is None or s > prev + length:
                yield rows[r][0], rows[r][1], lo, prev + length
                lo = s
            prev = s


def _context_repeats(table: pa.Table, length: int, keep_first: bool) -> pa.Table:
    """Spans from the contexts of a bucket of grams."""
    columns = [table[c].to_pylist() for c in ("h", "id", "key", "x", "lo", "hi", "data")]
    by_gram: dict[int, list[tuple]] = {}
    for h, *row in zip(*columns, strict=True):
        by_gram.setdefault(h, []).append(tuple(row))
    return _span_table([s for rows in by_gram.values() for s in _repeats_of_gram(rows, length, keep_first)])


def _span_table(spans: list[tuple]) -> pa.Table:
    columns = zip(*spans, strict=True) if spans else ((), (), (), ())
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("id", "key", "start", "end"), columns, strict=True)})


def _fetch(texts: pa.Table, wanted: pa.Table) -> pa.Table:
    """The contexts asked for, cut from the texts of a bucket."""
    data = {}
    asked = set(zip(wanted["id"].to_pylist(), wanted["key"].to_pylist(), strict=True))
    for id_, key, text in zip(texts["id"].to_pylist(), texts["key"].to_pylist(), texts["text"], strict=True):
        if (id_, key) in asked and (id_, key) not in data:
            data[id_, key] = text.as_py().encode("utf-8", "surrogatepass")
    columns = [wanted[c].to_pylist() for c in ("id", "key", "x", "lo", "hi", "size")]
    cut = [data[i, k][x - lo : x + hi + size] for i, k, x, lo, hi, size in zip(*columns, strict=True)]
    return wanted.select(["h", "id", "key", "x", "lo", "hi"]).append_column("data", pa.array(cut, pa.binary()))


def _join_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the union of half-open spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _removed(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """The texts of a bucket without the spans."""
    keys = list(zip(spans["id"].to_pylist(), spans["key"].to_pylist(), strict=True))
    starts, ends = spans["start"].to_numpy(), spans["end"].to_numpy()
    of: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(keys):
        of.setdefault(key, []).append(i)
    kept, n_bytes, lists = [], [], []
    for id_, key, text in zip(texts["id"].to_pylist(), texts["key"].to_pylist(), texts["text"], strict=True):
        data = text.as_py().encode("utf-8", "surrogatepass")
        n_bytes.append(len(data))
        at = of.get((id_, key))
        if at is None:
            kept.append(data)
            lists.append([])
            continue
        a, b = _join_spans(starts[at], ends[at])
        gaps = zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)
        kept.append(b"".join(data[i:j] for i, j in gaps))
        lists.append([{"start": i, "end": j} for i, j in zip(a.tolist(), b.tolist(), strict=True)])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"doc_id": texts["doc_id"], "n_bytes": pa.array(n_bytes, pa.int64()), "spans": pa.array(lists, kind), "kept": pa.array(kept, pa.binary())})


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    keep_first: bool = False,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every document: the removed spans and the bytes that stay."""
    if not 0 < gram < length or length - gram >= 1 << 15:
        raise ValueError("gram must be shorter than length, by less than 32768")
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.col(id_col).cast("bigint")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    rows = docs.select(
        id_.alias("doc_id"), F.coalesce(id_, F.lit(_NO_ID)).alias("id"), F.xxhash64(id_, text).alias("key"), text.alias("text")
    )
    bucket = F.pmod(F.col("key"), F.lit(n_buckets))
    texts = rows.withColumn("bucket", bucket)

    context, gram_of = Window.partitionBy("h", "c"), Window.partitionBy("h")
    anchors = _anchor_rows(rows, length, gram).repartition(F.col("h"))
    found = (
        anchors.withColumn("all", F.sum("copies").over(context))
        .withColumn("rank", F.row_number().over(context.orderBy("id", "key", "x")))
        .withColumn("low", F.min("c").over(gram_of))
        .withColumn("high", F.max("c").over(gram_of))
        .filter((F.col("copies") == 0) | (F.col("all") > 1) | (F.col("low") < F.col("high")))
    )
    known = F.col("copies") == 0
    wanted = (F.col("rank") == 1) & ~known
    # Each kind of use is one row, so that the anchors are shuffled and sorted once.
    uses = F.array_compact(
        F.array(
            F.when(known | ((F.col("all") > 1) & ((F.col("rank") > 1) | F.lit(not keep_first))), F.lit("covered")),
            F.when(wanted & (F.col("low") < F.col("high")), F.lit("compare")),
        )
    )
    found = found.select("h", "id", "key", "x", "lo", "hi", F.explode(uses).alias("use"))
    covered = found.filter("use = 'covered'").select(
        "id", "key", (F.col("x") - F.col("lo")).alias("start"), (F.col("x") + F.col("hi") + length).alias("end")
    )
    compared = found.filter("use = 'compare'").withColumn("size", F.lit(length)).withColumn("bucket", bucket)
    schema = "h long, id long, key long, x long, lo short, hi short, data binary"
    contexts = texts.groupBy("bucket").cogroup(compared.groupBy("bucket")).applyInArrow(_fetch, schema)
    # As many buckets of grams as of texts: contexts are at most a few times the repeated text.
    by_gram = contexts.withColumn("bucket", F.pmod(F.col("h"), F.lit(4 * n_buckets))).groupBy("bucket")
    equal = by_gram.applyInArrow(lambda t: _context_repeats(t, length, keep_first), "id long, key long, start long, end long")
    spans = covered.unionByName(equal).withColumn("bucket", bucket)
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return texts.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(_removed, schema)
