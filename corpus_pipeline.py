"""From raw documents to packed sequences: the operators of ledgerloom.llm as stages over one table.

Each stage is written as Parquet in the shared folder and read again as the next one's
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import contamination, fuzzy_lines, near_duplicates, packing, quality, queries
from ledgerloom.llm.tables import written
from ledgerloom.session import keep_batches_small


def _without(docs: DataFrame, names: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's documents, where columns of the names that it sets itself keep what docs has in them."""
    aside = {c: f"own {c}" for c in docs.columns if c in names}
    done = stage(docs.withColumnsRenamed(aside)).drop(*names)
    return done.withColumnsRenamed({own: c for c, own in aside.items()}).select(docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    keep_batches_small(spark)
    labels = queries.table(spark, sf_dir, "labels")

    def accepted(rows: DataFrame) -> DataFrame:
        return quality.classify(rows, labels, learn=queries.not_held_out(3, 1)).filter("predicted = 1")

    return _without(docs, ("score", "predicted"), accepted)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that came before; those of which nothing is left go."""

    def left(rows: DataFrame) -> DataFrame:
        rows = fuzzy_lines.without_repeated_lines(rows, settings=fuzzy_lines.EVERY_LINE)
        rows = rows.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
        return rows.withColumn("n_chars", F.length("text").cast("long"))

    return _without(docs, ("n_lines", "n_dropped"), left)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.without_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return contamination.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 1024 ids."""
    return packing.pack(docs, queries.tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("lines", repeated_lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark_passages),
    ("pack", pack),
]

#: SQL can express neither the trained classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
