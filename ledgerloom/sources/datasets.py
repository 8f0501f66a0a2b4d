"""Generic file loading: CSV with inferred types, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Accepted file endings.
_CSV = (".csv",)
_PARQUET = (".parquet", ".pq")


def read_dataset(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    """CSV (header, inferred types) or Parquet, told apart by the ending of the path.

    A folder of files has no telling ending: name the format then.
    """
    lowered = path.lower().rstrip("/")
    if file_format == "csv" or lowered.endswith(_CSV):
        return spark.read.csv(path, header=True, inferSchema=True)
    if file_format == "parquet" or lowered.endswith(_PARQUET):
        return spark.read.parquet(path)
    raise ValueError(f"Cannot tell the format of {path}: end it in {', '.join(_CSV + _PARQUET)}")
