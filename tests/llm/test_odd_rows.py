"""Blocks without n-grams, long runs of zeros, ids beside nulls, and a sample of one repeated row."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language, packing, personal_data, quality, queries
from tests.llm.samples import documents, prose


@pytest.mark.parametrize("odd", [None, "", "!!!", " \n"])
def test_language_of_blocks_without_ngrams(spark, odd):
    known = spark.createDataFrame([(k, prose(k), "ab"[k % 2]) for k in range(8)], "doc_id long, text string, lang string")
    alone = known.limit(0).union(spark.createDataFrame([(100, odd, None)], known.schema))
    rows = known.coalesce(1).union(alone).union(known.filter("doc_id < 3").union(alone).coalesce(1))
    found = language.identify(rows, F.col("doc_id") < 100, F.lit(False)).collect()
    assert len(found) == 13 and {r.lang_pred for r in found if r.doc_id == 100} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id != 100} <= {"a", "b"}
    assert [r.lang_pred for r in language.identify(alone, F.lit(True), F.lit(False)).collect()] == ["und"]


def test_addresses_of_many_zeros():
    zeros = "0" * 4301
    assert personal_data.base_spans(f"{zeros}.1.1.1") == [(0, 1, 4307)]
    assert personal_data.base_spans(f"{zeros}256.1.1.1") == []
    assert personal_data.base_spans(f"{'9' * 5000}.1.1.1") == []


def test_large_ids_beside_null_ones(spark):
    big = 1152921504606846977
    docs = documents(spark, [prose(k) for k in range(3)]).withColumn("doc_id", F.when(F.col("doc_id") == 0, F.lit(big)).when(F.col("doc_id") == 1, F.lit(None)).otherwise(7))
    found = packing.pack(docs.coalesce(1), queries.tokenizer_path("byte_bpe_50k.json")).collect()
    assert {r.doc_id for r in found} == {big, None, 7}


def test_a_repeated_row_is_sampled_once(spark):
    docs = documents(spark, [prose(1)] * 200 + [prose(k) for k in range(2, 12)])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") < 200, 0).otherwise(F.col("doc_id")))
    labels = spark.createDataFrame([(0, 1)] + [(200 + k, k % 2) for k in range(10)], "doc_id long, quality int")
    found = quality.classify(docs, labels, F.lit(True), settings=quality.Settings(sample=5)).collect()
    assert len(found) == 210 and len({r.score for r in found if r.doc_id == 0}) == 1
