import random

import pytest
from pyspark.sql import types as T

#: Columns besides those of documents, with names that the operators use inside.
CLASHING = ["place", "digest", "key", "row", "bucket", "h", "n", "size", "rank", "kept", "trained", "chunk", "host", "text_key", "b"]

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def prose(rng: random.Random, n_words: int) -> str:
    syllables = "ka lo mi tu re son da be ölk ni pra sté".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n_words))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank and long texts, repeated rows and ids, copies and near copies."""
    rng = random.Random(5)
    passage, base = prose(rng, 60), prose(rng, 150)
    near = base.split()
    near[70] = "changed"
    texts = [
        None,
        None,
        "",
        " \t\n",
        "one",
        "One",
        "two words",
        "x" * 700,
        "ab" * 400,
        prose(rng, 30_000),
        passage,
        prose(rng, 40) + " " + passage + " " + prose(rng, 30),
        base,
        base.replace(" ", "  "),
        base.upper(),
        " ".join(near),
        base + " more",
        "日本語のテキスト " * 40,
        "\x00 nul,   and   are no spaces",
        *[prose(rng, rng.randint(1, 120)) for _ in range(25)],
    ]
    rows = [(i, t, rng.choice(["aa", "bb", None]), rng.choice(["s1", "s2", "s3", None]), 0) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (3, base, "aa", "s1", 0), (None, base, "aa", "s2", 0), (None, None, None, None, None), (40_000, passage, "bb", "s2", 1)]
    return [(*r, *CLASHING) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
