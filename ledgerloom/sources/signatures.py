"""Trigram signatures of files, so that a search for a part of a text skips files.

For a column of a stored table, every file has a bitmap of the trigrams of its lower-cased cells, as
rows (file, word, bits) beside the version they describe. A text can stand only in files that hold
all its trigrams; the rows of those are searched as ever.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_text, check_table_name, quoted
from ledgerloom.operators.preview import contains
from ledgerloom.sources.files import path_exists
from ledgerloom.sources.tables import TableStore

#: Bits of a file's bitmap, a power of two.
BITS = 1 << 16


def _trigrams(text: Column) -> Column:
    places = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, F.lit(3))))


def _words(rows: DataFrame, trigram: str, *by: str) -> DataFrame:
    """(by, word, bits) of the bitmaps of trigrams."""
    bit = F.pmod(F.xxhash64(trigram), F.lit(BITS))
    placed = rows.select(*by, F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{trigram}`), 64) as int))").alias("bit"))
    return placed.groupBy(*by, "word").agg(F.bit_or("bit").alias("bits"))


def _folder(version: str, column: str) -> str:
    return f"{version}/_trigrams_{check_table_name(column).lower()}"


def sign(store: TableStore, name: str, column: str) -> None:
    """Write the signatures of the current version of a table; a version of the table that comes later has none."""
    version, rows = store.versions(name)[-1], store.read(name)
    field = next(f for f in rows.schema.fields if f.name.lower() == column.lower())
    # Paths come encoded as in a URL, in which a plus sign stands for itself.
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    cells = rows.select(file.alias("file"), F.lower(as_text(F.col(quoted(field.name)), field.dataType)).alias("text"))
    grams = cells.select("file", F.explode(_trigrams(F.col("text"))).alias("gram"))
    _words(grams, "gram", "file").sortWithinPartitions("word").write.parquet(_folder(version, column))


def candidate_files(store: TableStore, name: str, column: str, text: str) -> list[str] | None:
    """Files of the current version that may hold the text; None where signatures cannot tell.

    As many names as the table has files at most, which Spark's own listing holds as well.
    """
    spark, version = store.spark, store.versions(name)[-1]
    if not path_exists(spark, f"{_folder(version, column)}/_SUCCESS"):
        return None
    lowered = spark.range(1).select(F.lower(F.lit(text))).first()[0]
    pieces = [p for p in re.split("[%_]", lowered) if len(p) >= 3]
    if not pieces:
        return None
    asked = spark.createDataFrame([(p,) for p in pieces], "text string").select(F.explode(_trigrams(F.col("text"))).alias("gram"))
    # A few words of 64 bits: no more than the text has letters.
    wanted = {r.word: r.bits for r in _words(asked, "gram").collect()}
    signatures = spark.read.parquet(_folder(version, column)).filter(F.col("word").isin(*wanted))
    fits = F.lit(False)
    for word, bits in wanted.items():
        fits |= (F.col("word") == word) & (F.col("bits").bitwiseAND(F.lit(bits)) == bits)
    held = signatures.filter(fits).groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted))
    return sorted(r.file for r in held.select("file").collect())


def search(store: TableStore, name: str, column: str, text: str) -> DataFrame:
    """The rows of a stored table whose cell contains the text (see ``contains``), from the files that may hold it."""
    rows = store.read(name)
    files = candidate_files(store, name, column, text)
    if files is not None:
        rows = rows.limit(0) if not files else store.spark.read.schema(rows.schema).parquet(*files)
    return contains(rows, column, text)
