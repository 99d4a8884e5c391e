"""Operators against brute force on a small table of edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from logloom.llm import bpe, exact_dedup, language_id, license_scan, mixing, near_dup, suffix_dedup, suffix_tree_lm, topk_search, toxicity
from logloom.llm.frequent import frequent_candidates
from logloom.llm.queries import MIX_WEIGHTS, ORACLE_SQL, QUERIES, multi_vocabulary
from tests.oracle_check import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- exact dedup -------------------------------------------------------------------


def expected_dedup(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for text, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, first, len(ids), not kept, hashlib.sha256(text.encode()).hexdigest()))
            kept = True
    return sorted(out, key=repr)


@pytest.mark.parametrize("counters", [1, 4, 1024])
def test_exact_dedup(edge_docs, edge_rows, counters):
    found = exact_dedup.exact_dedup(edge_docs, counters=counters).withColumn("digest", F.lower(F.hex("digest")))
    assert sorted(map(tuple, found.collect()), key=repr) == expected_dedup(edge_rows)


@pytest.mark.parametrize("counters", [1, 1024])
def test_keep_first_keeps_whole_rows(edge_docs, edge_rows, counters):
    kept = exact_dedup.keep_first(edge_docs, counters=counters)
    assert kept.columns == edge_docs.columns
    wanted = Counter((r[0], r[4]) for r in expected_dedup(edge_rows) if r[3])
    got = Counter(
        (r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in kept.collect()
    )
    assert got == wanted


def test_frequent_keys_are_never_missed(spark):
    rng = random.Random(1)
    keys = [f"k{int(rng.paretovariate(0.7))}" for _ in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    found = {bytes(r.k).decode() for r in frequent_candidates(df, "k", 20).collect()}
    often = {k for k, n in Counter(keys).items() if n > 2 * len(keys) / 21}
    assert often <= found and len(found) <= 21


# --- mixing ------------------------------------------------------------------------


def expected_targets(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: MIX_WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not above:
            return sizes, capped | {s: level * weight[s] for s in free}
        for s in above:
            capped[s] = 2 * sizes[s]
            left -= 2 * sizes[s]


@pytest.mark.parametrize(("block_words", "shard_slots"), [(256, 65536), (7, 50)])
def test_mix(edge_docs, edge_rows, block_words, shard_slots):
    sizes = mixing.document_sizes(edge_docs, keep={"doc_key": "doc_id"})
    runs = []
    for _ in range(2):
        mix = mixing.mix_sources(sizes, MIX_WEIGHTS, block_words=block_words, shard_slots=shard_slots)
        taken = sizes.join(mixing.taken_words(mix), "place", "left").fillna(0, "taken")
        runs.append(taken.toPandas().sort_values("place"))
    assert runs[0].equals(runs[1])
    found = runs[0]
    want_sizes, want = expected_targets(edge_rows)
    assert sorted(found["size"]) == sorted(len(WORD.findall(r[1] or "")) for r in edge_rows)
    assert (found["taken"] <= 2 * found["size"]).all()
    for source, target in want.items():
        mine = found[found["source"].isna() if source is None else found["source"] == source]
        assert abs(mine["taken"].sum() - target) <= 1
        assert mine["size"].sum() == want_sizes[source]
    # Shards hold full counts, and each pass takes a block once.
    slots = mix.slots.toPandas()
    assert not slots.duplicated(["rank", "pass", "block"]).any()
    assert (slots.groupby("shard").size().iloc[:-1] == shard_slots).all()


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation_is_one_to_one(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), [F.lit(3)]).alias("p"))
    values = [r.p for r in got.collect()]
    assert sorted(values) == list(range(n))
    assert n < 1000 or values != sorted(values)


def test_mixed_documents_hold_the_words_taken(edge_docs, edge_rows):
    mixed = mixing.mixed_documents(edge_docs, MIX_WEIGHTS)
    assert mixed.columns == edge_docs.columns
    words = Counter()
    texts = {}
    for r in edge_rows:
        texts.setdefault(r[0], []).append(WORD.findall(r[1] or ""))
    for r in mixed.collect():
        part = WORD.findall(r.text)
        assert part and any(not Counter(part) - Counter(t) for t in texts[r.doc_id])
        words[r.source] += len(part)
    for source, target in expected_targets(edge_rows)[1].items():
        assert abs(words[source] - target) <= 1


# --- BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoding():
    vocabulary = multi_vocabulary()
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.tokens, special_tokens={})


def test_bpe_round_trip(edge_docs, edge_rows, reference_encoding):
    rows = bpe.round_trip(edge_docs, multi_vocabulary(), keep=["doc_id", "text"]).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference_encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_bpe_of_long_pieces_and_odd_strings(reference_encoding):
    rng = random.Random(3)
    texts = ["x" * 5000, "aaab" * 700, "<|endoftext|>", "á‍👩‍🚀" * 30, "", None]
    texts += ["".join(rng.choice("abeE \n'é0") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x3040, 0x9FFF)])) for _ in range(200)) for _ in range(20)]
    encoder, decoder = bpe.Encoder(multi_vocabulary()), bpe.Decoder(multi_vocabulary())
    ids = encoder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [reference_encoding.encode_ordinary(t or "") for t in texts]
    assert decoder.decode(ids) == [(t or "").encode() for t in texts]


def test_decode_of_unknown_ids_is_null(spark):
    data = [(1, np.array([440, 4_000_000], "<u4").tobytes()), (2, b"abc"), (3, None), (4, b"")]
    rows = bpe.decode(spark.createDataFrame(data, "i int, ids binary"), multi_vocabulary(), keep=["i"]).collect()
    assert {r.i: r.decoded and bytes(r.decoded) for r in rows} == {1: None, 2: None, 3: None, 4: b""}


# --- top-k search ------------------------------------------------------------------


def brute_topk(rows, k):
    usable = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-int(v @ u), i) for i, u in usable.items() if i != q and len(u) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16384, 512), (40, 3)])
def test_topk_search(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 16)]) for i in range(600)]
    same = rows[7][1]
    rows += [(i, same) for i in range(600, 660)]
    rows += [(700, None), (701, [None] * 16), (702, [math.nan] * 16), (750, [math.inf] * 16), (800, [0.5, 0.25]), (801, [1.0, 1.0]), (None, same), (850, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, b string")
    found = topk_search.topk_search(df, df.filter("vec_id % 50 = 0"), 5, block_rows=blocks[0], query_rows=blocks[1])
    assert sorted(map(tuple, found.collect())) == brute_topk(rows, 5)
    assert found.filter("query_id is null").count() == 0
    assert topk_search.topk_search(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [(16384, 512), (30, 2)])
def test_topk_search_of_wide_components(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 6) * 10.0 ** rng.integers(-3, 14)).tolist()) for i in range(260)]
    rows += [(300, [1e30, 0.0, 1.0, 0.0, 0.0, 0.0]), (301, [1e30, 0.0, 2.0, 0.0, 0.0, 0.0]), (350, [3.0, 1.5, 0.0, 0.0, -2.0, 1e-9]), (400, [1e308, -1e308, 5.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.topk_search(df, df.filter("vec_id % 50 = 0"), 5, block_rows=blocks[0], query_rows=blocks[1])
    whole = {i: [math.floor(256 * x) if abs(x) < 1e300 else int(np.floor(np.nan_to_num(256 * np.float64(x)))) for x in v] for i, v in rows}
    want = []
    for q, v in whole.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in whole.items() if i != q)[:5]
            want += [(q, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert any(x[3] not in (2**63 - 1, -(2**63)) and abs(x[3]) > 2**52 for x in want)


def test_topk_query_of_odd_rows_equals_its_sql(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(0, 0.5, int(rng.choice([2, 3, 5, 8]))).tolist()) for i in range(260)]
    rows += [(50, rows[50][1]), (100, [4.0, -4.0, 2.0]), (7, rows[7][1]), (-50, [1.0, 2.0]), (None, [9.0, 9.0]), (300, None), (301, [None, 9.0]), (302, [math.inf, 9.0])]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    assert compare(QUERIES["op5_topk_search"](spark, str(tmp_path)), con, ORACLE_SQL["op5_topk_search"]) is None


def test_topk_query_of_empty_vectors(spark):
    df = spark.createDataFrame([(0, []), (1, [1.0]), (2, []), (50, [-1.0])], "vec_id long, embedding array<double>")
    found = topk_search.topk_search(df, df.filter("vec_id % 50 = 0"), same_length=False)
    want = [(0, 1, 1, 0), (0, 2, 2, 0), (0, 3, 50, 0), (50, 1, 0, 0), (50, 2, 2, 0), (50, 3, 1, -(2**16))]
    assert sorted(map(tuple, found.collect())) == want


def test_impact_index_stops_early_and_stays_exact():
    rng = np.random.default_rng(4)
    values = rng.integers(-160, 160, (3000, 24))
    index = topk_search.ImpactIndex(values)
    fewer = 0
    for q in values[:40]:
        found, score = index.search(q, 5, np.array([], int))
        assert sorted(score)[-5:] == sorted(values @ q)[-5:]
        fewer += len(found) < len(values)
    assert fewer == 40


# --- suffix dedup ------------------------------------------------------------------


def expected_removal(rows, length, keep_first):
    texts = sorted(((r[0] is None, r[0] or 0), (r[1] or "").encode()) for r in rows)
    starts = defaultdict(list)
    for t, (_, data) in enumerate(texts):
        for i in range(len(data) - length + 1):
            starts[data[i : i + length]].append((t, i))
    out = []
    for t, (key, data) in enumerate(texts):
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            places = starts[data[i : i + length]]
            if len(places) > 1 and not (keep_first and places[0] == (t, i)):
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((None if key[0] else key[1], len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def test_suffix_dedup(edge_docs, edge_rows):
    found = suffix_dedup.remove_repeats(edge_docs).collect()
    got = sorted(((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == expected_removal(edge_rows, 200, False)


def test_suffix_dedup_of_short_strings_in_many_buckets(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 300)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(df, length=9, gram=4, bucket_bytes=500).collect()
    got = sorted(((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == expected_removal(rows, 9, False)


def test_suffix_dedup_keeps_the_first_copy(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdefgh ") for _ in range(240)) for _ in range(6)]
    rows = [(i, "".join(rng.sample(parts, 2)) + str(i) * 30) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(df, keep_first=True).collect()
    got = sorted(((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == expected_removal(rows, 200, True)


def test_longest_factors():
    text = "abracadabraabrac"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def lcp(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    common = [0] + [lcp(a, b) for a, b in zip(order, order[1:], strict=False)]
    before, after = suffix_dedup.previous_and_next_factors(order, common, 99)
    for i, p in enumerate(order):
        assert before[i] == max((lcp(p, q) for q in range(p)), default=0)
        assert after[i] == max((lcp(p, q) for q in range(p + 1, len(text))), default=0)


# --- near duplicates ---------------------------------------------------------------


def expected_near(rows):
    sets = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("fragment_bytes", [1 << 24, 20_000])
def test_near_duplicates(edge_docs, edge_rows, fragment_bytes):
    found = near_dup.near_duplicates(edge_docs, fragment_bytes=fragment_bytes)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == expected_near(edge_rows)
    kept = near_dup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    groups = {c for i, n, c in got if n}
    assert len({(r.doc_id, r.text) for r in kept.collect() if WORD.search(r.text or "")}) == len(groups)


def test_chains_of_near_copies(spark):
    """Copies that drift: neighbours are similar, ends are not, and no leader is similar to all."""
    rng = random.Random(11)
    rows, at = [], 0
    for _ in range(6):
        words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
        for _ in range(25):
            words = list(words)
            for _ in range(rng.choice([1, 1, 2, 3])):
                words[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
            rows.append((at, " ".join(words)))
            at += 1
    rng.shuffle(rows)
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), fragment_bytes=30_000)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == expected_near(rows)


def test_copies_that_are_not_similar_are_told_apart_by_their_leader(spark, monkeypatch):
    """Edits of one text, some linked with it and some not: the ones are not compared with the others."""
    rng = random.Random(13)
    base = [f"w{i}" for i in range(150)]

    def edited(places, mark):
        return [f"{mark}{i}" if i in places else w for i, w in enumerate(base)]

    rows = [base, *[edited({rng.randrange(150)}, f"y{i}x") for i in range(30)]]
    for j in range(20):
        far = edited({3 + j % 30, 40 + j, 80 + j, 120 + j}, f"x{j}x")
        rows += [far, [*far[:-1], f"end{j}"]]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    counts, stored = {}, near_dup.stored

    def counting(df, name):
        out = stored(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_dup, "stored", counting)
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr) == expected_near(rows)
    assert len({c for _, _, c in expected_near(rows)}) > 10
    assert counts["near-rest"] <= 40 * 39 // 2, counts


def test_extracts_of_other_places_are_not_compared(spark, monkeypatch):
    """Pairs of texts that have enough n-grams of the one they were taken from, but lack different parts of it."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(150)]
    rows = [base]
    for j in range(40):
        gone = {i + k for i in rng.sample(range(5, 135, 9), 4) for k in range(8)}
        rows.append([w for i, w in enumerate(base) if i not in gone])
    # Two of them with nearly the same gaps are still found.
    rows.append([*rows[5][:-1], "end"])
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    counts, stored = {}, near_dup.stored

    def counting(df, name):
        out = stored(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_dup, "stored", counting)
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = expected_near(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr) == want
    assert len({c for _, _, c in want}) > 20
    assert counts["near-rest"] <= 60, counts


def test_a_fragment_takes_little_memory_and_gives_it_back():
    def held(name):
        return next(int(line.split()[1]) >> 10 for line in open("/proc/self/status") if line.startswith(name))

    rng, n_sets = np.random.default_rng(1), near_dup.FRAGMENT_BYTES // 8 // 60
    grams = np.sort(rng.integers(0, n_sets * 30, (n_sets, 60)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), axis=1)
    parts = pa.array([g.tobytes() for g in grams], pa.binary())
    table = pa.table({"fragment": pa.array(np.zeros(n_sets, np.int64)), "key": pa.array(np.arange(n_sets)), "n": pa.array(np.full(n_sets, 300)), "part": parts})
    near_dup.give_back()
    before = held("VmRSS")
    with open("/proc/self/clear_refs", "w") as f:
        f.write("5")  # the highest size so far is the current one
    out = near_dup._shared_parts_giving_back(table)
    assert held("VmHWM") - before < 100
    del out
    near_dup.give_back()
    assert held("VmRSS") - before < 30


def test_first_grams_are_one_row_each(spark):
    rows = [(" ".join(f"w{i * 7 + k}" for k in range(60)),) for i in range(50)] + [(None,), ("",), ("one two",)]
    found = near_dup._first_grams(spark.createDataFrame(rows, "text string"), "text", 5, 1.0)
    assert found.count() == 50 * 56 + 1 and found.distinct().count() == found.count()


def test_fragments_are_one_row_per_gram(spark):
    rows = [(" ".join(f"w{i * 7 + k}" for k in range(60)),) for i in range(50)] + [(None,), ("",), ("one two",)]
    texts = spark.createDataFrame(rows, "text string")
    few, many = (near_dup._fragments(texts, "text", 5, f) for f in (2, 40))
    # Rows grow with the text, not with the text times the fragments.
    assert few.count() == many.count() == 50 * 56 + 1
    assert few.select("key", "n", "gram").exceptAll(many.select("key", "n", "gram")).count() == 0
    schema = "key long, n long, grams array<long>, frequency array<int>"
    shared = [d.groupBy("fragment").applyInArrow(near_dup._shared_parts_giving_back, schema).selectExpr("key", "n", "inline(arrays_zip(grams, frequency))") for d in (few, many)]
    assert shared[0].exceptAll(shared[1]).count() == shared[1].exceptAll(shared[0]).count() == 0
    assert shared[0].count() == 0 or shared[0].agg(F.min("frequency")).first()[0] > 1


def test_components(spark):
    rng = random.Random(12)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300)]
    found = {r.key: r.component for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert found == {k: v for k, v in least.items() if k != 300}


# --- LM scoring --------------------------------------------------------------------


def test_lm_counts_and_base(edge_docs, edge_rows):
    found = suffix_tree_lm.score_texts(edge_docs, chunk_bytes=100_000).collect()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in edge_rows]
    docs = [[*WORD.findall(lower(r[1])), None] for r in edge_rows]
    count = Counter(w for d, h in zip(docs, held, strict=True) if not h for w in d)
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(r[0]), h, len(d), sum(count[w] > 0 for w in d), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in d), 4))
        for r, h, d in zip(edge_rows, held, docs, strict=True)
    )
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_lm_next_symbols_sum_to_one(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    counts = suffix_tree_lm.token_counts(texts).cache()
    model = suffix_tree_lm.fit(texts, counts)
    assert len(model.tree.parents) > 20
    symbols = np.append(np.array(sorted(model.weights)), model.symbols.unknown)
    for node in range(0, len(model.tree.parents), 7):
        total = np.exp(model.tree.log_probability(np.full(len(symbols), node), symbols)).sum()
        assert abs(total - 1) < 1e-6


def test_lm_beats_the_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sums = suffix_tree_lm.score_texts(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_lm_without_training_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = suffix_tree_lm.score_texts(df, training=lambda _: F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens) for r in found] == [(0, 0), (0, 0)]


def expected_lm_scores(texts, trained):
    """Scores by direct counting: every (context, token) of training that occurs twice, at all depths."""
    docs = [[*WORD.findall(lower(x)), "\n"] for x in texts]
    docs = [[w.encode() for w in d] for d in docs]
    before = [[b"\n", *[b" " + w for w in d[:-1]]] for d in docs]
    count = Counter(w for d, t in zip(docs, trained, strict=True) if t for w in d)
    unknown = (sum(c == 1 for c in count.values()) + 1) / (count.total() + len(count) + 1)
    pairs, sizes, nodes = [defaultdict(Counter) for _ in range(5)], [Counter() for _ in range(5)], {}
    for d, b, t in zip(docs, before, trained, strict=True):
        for w, c in zip(d, b, strict=True) if t else ():
            for k in range(1, 5):
                pairs[k][c[-k:].rjust(k, b"\0")][w] += 1
                sizes[k][c[-k:].rjust(k, b"\0")] += 1

    def p(context, w, depth):
        if not depth:
            return (count[w] + 1) * (1 - unknown) / (count.total() + len(count))
        given = p(context, w, depth - 1)
        c = context[-depth:].rjust(depth, b"\0")
        if (depth, c) not in nodes:
            return given
        often, rest = nodes[depth, c]
        return often.get(w, 0) / (sizes[depth][c] + 2) + rest * given

    for k in range(1, 5):
        for c, follow in pairs[k].items():
            often = {w: n for w, n in follow.items() if n > 1}
            other = sizes[k][c] - sum(often.values())
            rest = (other + 2) / (sizes[k][c] + 2)
            given = {w: p(c, w, k - 1) for w in often}
            gain = sum(n * math.log((n / (sizes[k][c] + 2) + rest * given[w]) / given[w]) for w, n in often.items())
            if often and gain + other * math.log(rest) > len(often) / 2 * math.log(sizes[k][c]):
                nodes[k, c] = often, rest
    scores = [sum(math.log10(p(c, w, 4) if count[w] else unknown) for w, c in zip(d, b, strict=True)) for d, b in zip(docs, before, strict=True)]
    return scores, min(sizes[k][c] for k, c in nodes) / count.total()


def test_lm_keeps_every_pair_seen_twice(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    # Rare words after a rare word.
    rows = [(r.doc_id, r.text) for r in rows] + [(10**9 + i, f"qqxv mark{i % 3}z qqxv mark{i % 3}z") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = [zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    want, least = expected_lm_scores([r[1] for r in rows], [not h for h in held])
    assert least < 2.0**-12
    got = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(df, chunk_bytes=50_000).collect()}
    assert len(got) == len(rows)
    for (doc_id, _), score in zip(rows, want, strict=True):
        assert got[doc_id] == pytest.approx(score, rel=1e-9), doc_id


# --- toxicity ----------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("toxic is not null")
    model = toxicity.fit_severity(docs, labels.filter("doc_id % 4 <> 0"))
    scored = toxicity.score_severity(docs, model).join(labels.withColumnRenamed("toxic", "label"), "doc_id").filter("doc_id % 4 = 0")
    rows = scored.toPandas()
    assert (rows["toxic"] == (rows["label"] == 1)).mean() > 0.9
    assert rows[rows["label"] == 0]["toxic"].mean() < 0.02
    assert (rows["severity"] >= rows["p_toxic"] - 1e-9).all()


def test_toxicity_cases(edge_docs, no_docs, spark):
    labels = spark.createDataFrame([(0, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    assert toxicity.fit_severity(edge_docs, labels) is None
    assert toxicity.score_severity(edge_docs, None).filter("severity is not null").count() == 0
    model = toxicity.SeverityModel({"bad": 3.0}, [1.0, 4.0])
    rows = {r.doc_id: r for r in toxicity.score_severity(edge_docs, model).collect()}
    assert len(rows) == len({r.doc_id for r in edge_docs.select("doc_id").collect()})
    assert toxicity.score_severity(no_docs, model).count() == 0


def test_ordinal_grades_share_weights():
    rng = random.Random(2)
    docs, grades = [], []
    for _ in range(600):
        n = rng.choice([0, 0, 0, 1, 2, 3, 4])
        docs.append(sorted({f"f{rng.randrange(400)}" for _ in range(20)} | {f"bad{i}" for i in rng.sample(range(5), n)}))
        grades.append(0 if n == 0 else 1 if n < 3 else 2)
    model = toxicity.fit_ordinal(docs, np.array(grades))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    assert {f"bad{i}" for i in range(5)} <= set(model.weights)


# --- language ID -------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = language_id.fit_text_models(docs.filter("doc_id % 2 = 0"))
    found = language_id.identify(docs.filter("doc_id % 2 = 1"), models, host_col="source", keep=["doc_id", "lang"])
    rows = found.toPandas()
    assert (rows["language"] == rows["lang"]).mean() > 0.97
    assert rows["accepted"].mean() > 0.97


def test_language_fusion_cases(spark):
    texts = [("en", "the thing and the other thing with that"), ("fr", "les choses et une autre chose avec ça")]
    models = language_id.fit_text_models(spark.createDataFrame(texts * 3, "lang string, text string"))
    rows = [(i, "the thing with that and the other", "en", "a.example.uk", "x") for i in range(8)]
    rows += [(i, "une chose avec les autres choses", "fr", "b.example.fr", "x") for i in range(8, 16)]
    rows += [(20, None, "fr", "b.example.fr", "x"), (21, "", None, "a.example.uk", "x"), (22, "12 34", None, None, "x"), (23, None, None, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, text string, declared string, host string, vote string")
    got = {r.page_id: r for r in language_id.identify(df, models, declared_col="declared", host_col="host", keep=["page_id", "vote"]).collect()}
    assert all(got[i].language == "en" and got[i].accepted for i in range(8))
    assert all(got[i].language == "fr" and got[i].accepted for i in range(8, 16))
    assert got[20].language == "fr" and got[21].language == "en" and not got[20].accepted
    assert got[23].language is None and got[23].confidence == 0 and not got[22].accepted
    kept = language_id.keep_accepted(df, models, declared_col="declared", host_col="host")
    assert kept.columns == df.columns and {r.page_id for r in kept.collect()} == set(range(16))
    unlabelled = language_id.fit_text_models(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.language for r in language_id.identify(df, unlabelled, keep=["page_id"]).collect()} == {None}


def test_page_parts(spark):
    html = "<!doctype html><HTML class=x lang='FR-ca'><script>var a = '<p>';</script><!-- <b>no</b> --><p>oui <b>non</b></p>"
    df = spark.createDataFrame([(html, "HTTPS://user@WWW.Example.org:80/a?b"), (None, None), ("<html>", "no address")], "html string, url string")
    rows = df.select(
        language_id.declared_in_markup(F.col("html")).alias("d"), language_id.host_of(F.col("url")).alias("h"), language_id.visible_text(F.col("html")).alias("t")
    ).collect()
    assert (rows[0].d, rows[0].h, rows[0].t.split()) == ("fr", "www.example.org", ["oui", "non"])
    assert (rows[1].d, rows[1].h, rows[1].t) == (None, None, None) and (rows[2].d, rows[2].h) == (None, None)


# --- license scans -----------------------------------------------------------------


def test_license_scan(spark):
    rng = random.Random(6)
    filler = " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet"]) for _ in range(80))
    notices = license_scan.TEMPLATES
    rows = [(i, f"{filler}\n{t}\n{filler}") for i, t in enumerate(notices.values())]
    rows += [(100, f"{filler} Licensed under the Apache License, Version 2.1. {filler}")]
    rows += [(101, f"{filler} a licence to print money {filler}"), (102, None), (103, ""), (104, filler), (105, notices["MIT"] + f" {filler} " + notices["GPL-3.0"])]
    rows += [(106, notices["MIT text"].replace(" ", "\n   "))]
    found = license_scan.scan_licenses(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")).collect()
    got = defaultdict(list)
    for r in found:
        got[r.doc_id].append((r.license, r.n_differences))
        text = dict(rows)[r.doc_id]
        assert 0 <= r.start < r.end <= len(text)
    for i, name in enumerate(notices):
        assert (name, 0) in got[i], name
    assert got[100] == [("Apache-2.0", 1)]
    assert [r.differences for r in found if r.doc_id == 100] == ["-2.0 +2.1"]
    assert not {101, 102, 103, 104} & got.keys()
    assert sorted(got[105]) == [("GPL-3.0", 0), ("MIT", 0)] and ("MIT text", 0) in got[106]


def licenses_in(text):
    return [(h["license"], h["n_differences"]) for h in license_scan.LicenseScanner(license_scan.TEMPLATES).scan(text)]


def test_licenses_are_told_apart():
    assert licenses_in("lorem ipsum. Licensed under CC BY-NC 4.0.") == [("CC-BY-NC-4.0 short", 0)]
    assert licenses_in("Code released under the BSD License, by us.") == [("BSD", 0)]
    assert licenses_in("This library is licensed under the GNU General Public License, version 2.")[0][0] == "GPL-2.0"
    assert licenses_in("This work is licensed under the GNU Lesser General Public License, version 3.") == [("LGPL-3.0", 0)]
    assert licenses_in("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == [("CC-BY-SA-4.0", 0)]
    assert licenses_in("Released under the Zlib License. Released under the Proprietary License.") == []
    bsd3 = license_scan.TEMPLATES["BSD-3-Clause"]
    others = bsd3.replace("the copyright holder nor", "Example Ltd. nor").replace("1.", "*").replace("2.", "*").replace("3.", "*")
    two = others[: others.index("* Neither")] + others[others.index("THIS SOFTWARE") :]
    four = others.replace("* Neither", "* All advertising materials mentioning this software must display an acknowledgement. * Neither")
    assert [n for n, _ in licenses_in(others)] == ["BSD-3-Clause"]
    assert [n for n, _ in licenses_in(two)] == ["BSD-2-Clause"]
    assert "BSD-3-Clause" not in [n for n, _ in licenses_in(four)]
    assert all(re.search(license_scan.CUES, t) for t in license_scan.TEMPLATES.values())


def test_repeated_and_neighbouring_licenses():
    mit, gpl, text = (license_scan.TEMPLATES[n] for n in ("MIT", "GPL-3.0", "ISC text"))
    apart = " and then some words "
    assert licenses_in(apart.join([mit] * 40)) == [("MIT", 0)] * 40
    lines = [mit, gpl, mit, "Released under the Foo License.", text, mit, gpl.replace("work", "module"), text]
    got = sorted(licenses_in(apart.join(lines)))
    assert got == sorted([("MIT", 0)] * 3 + [("GPL-3.0", 0), ("GPL-3.0", 1)] + [("ISC text", 0)] * 2)
    hits = list(license_scan.LicenseScanner(license_scan.TEMPLATES).scan(f"{gpl}\n{mit}\n{mit}"))
    assert sorted((h["start"], h["end"]) for h in hits) == [(0, len(gpl)), (len(gpl) + 1, len(gpl + mit) + 1), (len(gpl + mit) + 2, len(gpl + mit + mit) + 2)]


# --- empty tables ------------------------------------------------------------------


def test_empty_tables(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.keep_first(no_docs).count() == 0
    assert near_dup.near_duplicates(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_tree_lm.score_texts(no_docs).count() == 0
    assert bpe.round_trip(no_docs, multi_vocabulary(), keep=["doc_id"]).count() == 0
    assert license_scan.scan_licenses(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs, MIX_WEIGHTS).count() == 0
    models = language_id.fit_text_models(no_docs)
    assert language_id.identify(no_docs, models, declared_col="lang", host_col="source").count() == 0
