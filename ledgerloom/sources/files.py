"""Small Hadoop file-system checks, valid for every scheme Spark can read."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _file_system(spark, path)
    return bool(file_system.exists(location))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; none if it is absent."""
    file_system, location = _file_system(spark, path)
    if not file_system.exists(location):
        return []
    return sorted(s.getPath().getName() for s in file_system.listStatus(location) if s.isDirectory())


def folders_with_times(spark: SparkSession, path: str) -> list[tuple[str, datetime]]:
    """Names of the folders directly under ``path`` with the UTC time of their last change; none if it is absent."""
    file_system, location = _file_system(spark, path)
    if not file_system.exists(location):
        return []
    found = [s for s in file_system.listStatus(location) if s.isDirectory()]
    moment = lambda s: datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc).replace(tzinfo=None)
    return sorted((s.getPath().getName(), moment(s)) for s in found)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly under ``path``, sorted; none if it is absent."""
    file_system, location = _file_system(spark, path)
    if not file_system.exists(location):
        return []
    names = (s.getPath().getName() for s in file_system.listStatus(location) if not s.isDirectory())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def rename_folder(spark: SparkSession, path: str, new_path: str) -> None:
    file_system, location = _file_system(spark, path)
    if not file_system.rename(location, _file_system(spark, new_path)[1]):
        raise OSError(f"{path} could not become {new_path}")


def remove_folder(spark: SparkSession, path: str) -> None:
    file_system, location = _file_system(spark, path)
    if file_system.exists(location):
        file_system.delete(location, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; one without belongs to the default file system."""
    file_system, location = _file_system(spark, path)
    return file_system.makeQualified(location).toString()
