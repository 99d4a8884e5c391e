"""The registered queries of the package on the test tables, and the pipeline as a whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logloom.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_check import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_stages_keep_the_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        sizes[name] = docs.count()
        assert docs.columns == before.columns
    assert sizes["language_id"] >= 0.95 * before.sparkSession.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert sizes["ngram_jaccard"] <= sizes["exact_dedup"] < sizes["language_id"]


def test_pipeline_decodes_what_it_encodes(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.filter(~F.col("decodes") | F.col("decodes").isNull()).count() == 0
    assert out.count() > 0
