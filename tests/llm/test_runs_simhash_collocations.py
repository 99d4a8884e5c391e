"""Periodic runs, SimHash components and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from logloom.llm import collocations, periodic_runs, simhash
from logloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = re.compile("[A-Z]")


def lower(text):
    return UPPER.sub(lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    """Stores rows as the ``documents`` of a folder of their own."""

    def save(docs):
        folder = str(tmp_path_factory.mktemp("docs"))
        docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        return folder

    return save


# --- periodic runs -----------------------------------------------------------------


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((s, q, n) for (s, n), q in found.items())


def brute_collapse(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def repeated_rows():
    rng = random.Random(8)
    texts = ["a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "x " + "a b c " * 5 + "a y", "a " * 3000, "ab " * 20 + "ab c " * 40]
    for _ in range(80):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 40))]
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 200)]
        texts.append(" ".join(words))
    unit = [f"w{rng.randint(0, 500)}" for _ in range(900)]
    texts.append(" ".join((unit * 6)[:4711]))
    return list(enumerate(texts, 1000))


def test_runs_against_brute_force(spark, edge_docs, edge_rows):
    rows = repeated_rows() + [(r[0], r[1]) for r in edge_rows if len(r[1] or "") < 20_000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = periodic_runs.collapse_runs(docs).collect()
    got = Counter((r.doc_id, tuple(map(tuple, r.runs or [])), r.text) for r in found)
    want = Counter()
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        runs = brute_runs(words)
        want[doc_id, tuple(runs), brute_collapse(words, runs)] += 1
    assert got == want
    assert sum(len(k[1]) for k in got) > 60


def test_run_query(spark, saved):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90)))) for i in range(400)] + [(None, "a b"), (7, None), (0, "")]
    folder = saved(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.collapsed_sha256): r for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    n_planted = 0
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = brute_runs(words)
        n_planted += words != WORD.findall(text or "")
        digest = hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
        row = got[doc_id, digest]
        assert row.n_runs == len(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        if not runs:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
            continue
        best = runs[0]
        for s, q, n in runs[1:]:
            if n * best[1] > best[2] * q:
                best = (s, q, n)
        s, q, n = best
        assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
    assert n_planted > 15


def test_long_documents_and_odd_tables(spark, edge_docs, no_docs):
    assert periodic_runs.collapse_runs(no_docs).count() == 0
    assert periodic_runs.collapse_runs(edge_docs).count() == edge_docs.count()
    long = " ".join(str(i % 30_011) for i in range(150_000)) + " z" * 50_000
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    cut = periodic_runs.tiles(periodic_runs.keyed(docs, "doc_id", "text"))
    assert cut.agg(F.max(F.octet_length("words"))).first()[0] < 4 * 4 * 65_536
    runs = {(r.start, r.length, r.period) for r in periodic_runs.periodic_runs(docs).collect()}
    assert runs == {(0, 150_000, 30_011), (150_000, 50_000, 1)}


def test_batches_are_worked_on_in_slices(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500))], ["id"])
    parts = list(periodic_runs._sliced(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert [p.num_rows for p in parts] == [1024, 1024, 452, 3]
    assert [i for p in parts for i in p.column(0).to_pylist()] == [*range(2500), 0, 1, 2]
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.concat(F.lit("x " * 8), F.col("id").cast("string")).alias("text")).coalesce(1)
    found = {r.doc_id: (r.text, [tuple(x) for x in r.runs]) for r in periodic_runs.collapse_runs(docs).collect()}
    assert found == {i: (f"x {i}", [(0, 1, 8)]) for i in range(2500)}


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
        z = periodic_runs.z_function(s)
        for i in range(len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


# --- SimHash -----------------------------------------------------------------------


def brute_print(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Component of each fingerprint: the smallest place that is reachable."""
    values = np.array(prints, np.uint64)
    label = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 4) for v in values]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def near_copies(rng, n):
    base = [rng.choice("ka lo mi tu re son da be".split()) + str(rng.randint(0, 30)) for _ in range(80)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(80)] = f"n{rng.randint(0, 9)}"
        yield " ".join(words)


def test_fingerprints_are_as_defined(spark, edge_docs, edge_rows):
    got = Counter((r.doc_id, r.fp % 2**64) for r in simhash.fingerprints(edge_docs).collect())
    assert got == Counter((r[0], brute_print(r[1])) for r in edge_rows)
    same = spark.createDataFrame([("ab cd ef gh",)], "s string").select(F.xxhash64("s")).first()[0]
    assert simhash.fingerprint("ab cd ef gh") == same % 2**64


@pytest.mark.parametrize("crowd", [2, 5, 64])
def test_components(spark, edge_rows, crowd):
    rng = random.Random(crowd)
    rows = [(r[0], r[1]) for r in edge_rows] + [(500 + i, t) for i, t in enumerate(near_copies(rng, 150))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.simhash_components(docs, crowd=crowd).collect())
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints)
    least = defaultdict(list)
    for (doc_id, _), c in zip(rows, label, strict=True):
        least[c].append(doc_id)
    want = Counter((i, p, min((x for x in least[c] if x is not None), default=None)) for (i, _), p, c in zip(rows, prints, label, strict=True))
    assert got == want
    assert len(set(label)) < len(set(prints))


def test_crowds_and_pairs_give_the_same_components(spark):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    prints = set()
    for c in centres:
        for _ in range(300):
            prints.add(int(c) ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))}))
    values = sorted(prints)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    label = brute_components(values)
    want = {frozenset(np.array(signed)[label == c].tolist()) for c in set(label)}
    for crowd in (3, 10_000):
        parts = defaultdict(set)
        linked = {r.key: r.component for r in simhash.components(simhash.links(frame, crowd)).collect()}
        for v in signed:
            parts[linked.get(v, v)].add(v)
        assert set(map(frozenset, parts.values())) == want


def test_simhash_query_on_odd_tables(spark, saved, edge_docs, no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    rows = QUERIES["op12_simhash_near_dup"](spark, saved(edge_docs)).collect()
    assert len(rows) == edge_docs.count()
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}


# --- collocations ------------------------------------------------------------------


def brute_counts(rows):
    counts = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    return counts


def brute_collocations(rows, min_count, top):
    counts = brute_counts(rows)
    often = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= min_count}
    held = Counter()
    for (lang, words), n in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i : i + k]
                held[part] = max(held[part], n)
    totals = Counter()
    for (lang, words), n in counts.items():
        totals[lang] += n * (len(words) == 1)
    found = defaultdict(list)
    for (lang, words), a in often.items():
        if 100 * held[lang, words] >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, best in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed):
    rng = random.Random(seed)
    passage = "the quick brown fox jumps over the lazy dog of the old town"
    syllables = ["ka", "lo", "of", "the", "mi", "É", "da", "x.y", "no,", "\tto", "end\n", "of the", ""]
    rows = []
    for i in range(300):
        words = [rng.choice(syllables) for _ in range(rng.randint(0, 40))]
        if i % 3 == 0:
            words.insert(rng.randint(0, len(words)), passage)
        rows.append((" ".join(words), rng.choice(["aa", "bb", None, "und"])))
    return rows + [(None, "aa"), ("", None), (None, None), ("of the " * 500, "aa"), ("a a a a a a a a " * 10, "cc")]


def written(rows):
    return [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows]


@pytest.mark.parametrize(("bucket_bytes", "min_count"), [(1 << 20, 30), (300, 3), (2000, 8)])
def test_collocations_against_brute_force(spark, monkeypatch, bucket_bytes, min_count):
    rows = phrase_rows(min_count)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = collocations.collocations(docs, min_count=min_count, top=50, bucket_bytes=bucket_bytes).collect()
    want = brute_collocations(rows, min_count, 50)
    assert sorted(written(found)) == want and len(want) > 20


def test_counts_do_not_depend_on_chunks_and_stretches(spark, monkeypatch):
    rows = phrase_rows(5)
    want = {(lang, " ".join(p)): n for (lang, p), n in brute_counts(rows).items() if n >= 4}
    for name, value in (("_STRETCH", 7), ("_WORDS", 24), ("_PLACES", 500), ("_SEND", 100)):
        monkeypatch.setattr(collocations, name, value)
    packed = []
    work = {}
    # The tasks' own functions, in this process.
    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, fn, _):
            work["fn"] = fn

    collocations.packed_edges(Frame(), "text", "lang", 9)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[1] or "und" for r in rows]), pa.array([r[0] for r in rows], pa.string())], ["lang", "text"]
    )
    for out in work["fn"](iter([batch])):
        packed.append(out)
    table = pa.Table.from_batches(packed)
    assert max(table["bucket"].to_pylist()) >= 9  # some pairs are split
    total = Counter()
    for b in set(table["bucket"].to_pylist()):
        part = table.filter(pa.compute.equal(table["bucket"], b))
        for r in collocations.bucket_counts(part, 9, 4).to_pylist():
            total[r["lang"], r["phrase"]] += r["n"]
    assert {k: n for k, n in total.items() if n >= 4} == want


def test_paths_are_compacted(spark):
    passage = "one two three four five six seven"
    rows = [(passage + " eight", "aa")] * 5 + [("zero " + passage, "aa")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string")
    counts = collocations.phrase_counts(docs, min_count=2)
    paths = collocations.compact_paths(counts, collocations.unary_nodes(counts))
    got = {(r.path, r.n_edges) for r in collocations.path_texts(paths).collect()}
    assert got == {("zero one two three", 1), (passage, 4), ("five six seven eight", 1)}
    dropped = {r.phrase for r in collocations.dropped_phrases(counts, paths).collect()}
    assert {"two three four", "three four five", "four five six", "one two"} <= dropped


def test_collocations_of_odd_tables(spark, edge_docs, no_docs, saved):
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(edge_docs, min_count=2).count() > 0
    assert QUERIES["op13_collocations"](spark, saved(edge_docs)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_products_beyond_64_bits(spark):
    big = 5_000_000_000_000_000_000
    counts = spark.createDataFrame(
        [("aa", 1, "x", big), ("aa", 1, "y", big), ("aa", 2, "x y", big - 1), ("aa", 3, "x y z", 4 * 10**18), ("aa", 1, "z", big), ("aa", 2, "y z", big)],
        "lang string, n_words int, phrase string, n long",
    )
    row = {r.phrase: r for r in collocations.scored(counts).collect()}["x y"]
    assert row.score == 2_000_000 * (big - 1) // (2 * big)
    none = collocations.compact_paths(counts, collocations.unary_nodes(counts))
    assert {r.phrase for r in collocations.dropped_phrases(counts, none).collect()} == {"x y", "y z"}
