"""More languages than a word has bits."""

from pyspark.sql import functions as F

from ledgerloom.llm import language


def test_any_number_of_languages(spark):
    rows = [(2 * k + i, " ".join(f"{chr(0x4E00 + 40 * k + (i + 3 * j) % 7)}{chr(0x4E00 + 40 * k + j % 9)}" for j in range(40)), f"l{k:03d}") for k in range(130) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, F.lit(True), F.lit(False)).collect()}
    assert found == {k: lang for k, _, lang in rows}
