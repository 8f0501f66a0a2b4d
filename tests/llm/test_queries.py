"""Registered queries of the text operators, and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import queries
from tests.comparison import compare
from tests.llm.samples import ROWS, SCHEMA, changed, messy, prose


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_same_rows(spark, sample_folder, name):
    assert compare(spark, sample_folder, name) is None


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n in queries.registry()]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_pipeline_on_planted_cases(spark, tmp_path):
    good = [prose(k, 60) + "\n" + prose(1000 + k, 60) for k in range(60)]
    bad = [prose(k, 40).upper().replace(" ", "!! ") for k in range(2000, 2030)]
    item, line = prose(3000, 40), prose(3001, 70)
    near = [" ".join(good[k].split("\n")) + " and one more word" for k in range(3)]
    planted = [f"{prose(3100, 40)} {item} {prose(3101, 40)}", f"{line}\n{prose(3102, 60)}", f"{prose(3103, 60)}\n{line}", changed(good[5], 3, 1), good[6]]
    texts = good + bad + near + planted
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], SCHEMA)
    folder = str(tmp_path / "tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(k, 1, 0) for k in range(0, 60, 2)] + [(k, 0, 0) for k in range(60, 90, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    rows = corpus_pipeline.run(spark, folder).collect()
    first = len(good) + len(bad)
    found = {r.doc_id for r in rows}
    # Rejected, near copies of whole documents, the benchmark passage, copies by lines.
    gone = set(range(60, 90)) | set(range(first, first + 3)) | {first + 3, first + 6, first + 7}
    assert found == set(range(len(texts))) - gone
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    kept = {first + 5: prose(3103, 60)} | {k: texts[k] for k in found - {first + 5}}
    ids = {k: np.array(made.encode(t, add_special_tokens=False).ids + [0], "<u4") for k, t in kept.items()}
    total = {k: 0 for k in ids}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        total[r.doc_id] += r.length
    assert total == {k: len(v) for k, v in ids.items()}


def test_stages_keep_the_columns(spark, sample_folder):
    docs = spark.read.parquet(f"{sample_folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sample_folder)
        assert out.schema.simpleString() == docs.schema.simpleString() and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sample_folder).filter(F.lit(True)).count() == 0


@pytest.mark.parametrize("number", range(4))
def test_stages_on_messy_tables(spark, sample_folder, number):
    """Nulls, repeated rows, long texts, and columns with the names that stages set: all columns come out as they went in."""
    docs = messy(spark).withColumns({"n_lines": F.lit("clash"), "n_dropped": F.lit("clash")})
    rows = corpus_pipeline.STAGES[number][1](spark, docs, sample_folder)
    assert rows.schema.simpleString() == docs.schema.simpleString()
    found = rows.collect()
    assert 0 < len(found) <= ROWS
    assert {r[c] for r in found for c in ("score", "predicted", "n_lines", "n_dropped", "node")} == {"clash"}
    texts = {r.text for r in docs.collect()}
    # The lines stage cuts the text that repeats another one's line; the others leave texts alone.
    assert {r.text for r in found} <= texts | {prose(3)}
