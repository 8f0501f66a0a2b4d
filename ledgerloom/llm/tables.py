"""Intermediate tables in the shared folder, and column helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to a new folder of shared_folder() and reads it back.

    This cuts lineage and survives lost executors. The folder stays until discarded(); what is left of
    it goes by the retention rules of the shared folder.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[id(table)] = (table, path)
    return table


#: Folders of the tables that written() gave out and that were not discarded, by the table.
_folders: dict[int, tuple[DataFrame, str]] = {}


def discarded(*tables: DataFrame) -> None:
    """Removes the folders of tables of written() that nothing will read again: their successors are written."""
    for table in tables:
        known, path = _folders.pop(id(table), (None, None))
        if path is not None:
            context = known.sparkSession
            location = context._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(context._jsc.hadoopConfiguration()).delete(location, True)


def text_key(column: str = "text") -> Column:
    """128 bits that name a text; a null text counts as an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))
