"""Session settings the jobs are meant to run with.

Nothing in the package depends on them for its results.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of byte code; the wide
    # projections of line cleaning exceed that in one generated method. Past this
    # limit Spark generates smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every column call is most of the time it takes
    # to build a wide plan.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


#: Past how many bytes of byte code Spark goes over to smaller methods, and its default.
_LIMIT, _DEFAULT_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535"


def keep_compiled(spark: SparkSession) -> None:
    """Give a session that left it alone the limit past which Spark generates smaller methods.

    With the default, line cleaning runs in methods that the JVM interprets, at more than twice the time.
    """
    if spark.conf.get(_LIMIT, _DEFAULT_LIMIT) == _DEFAULT_LIMIT:
        spark.conf.set(_LIMIT, SETTINGS[_LIMIT])


#: Most bytes of an Arrow batch to Python, and its default.
_BATCH, _DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def keep_batches_small(spark: SparkSession) -> None:
    """Give a session that left it alone a limit to the Arrow batches that go to Python.

    By default 10,000 texts go at once: tens of MB that the executor, outside its heap, and each Python worker hold several times.
    """
    if spark.conf.get(_BATCH, _DEFAULT_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, "4m")


def local_session(cores: str = "8", memory: str = "8g", name: str = "ledgerloom") -> SparkSession:
    """A local session for tests and timing; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cores,
        # So that a scan of one small file occupies all cores.
        "spark.sql.files.maxPartitionBytes": "2m",
        "spark.sql.files.openCostInBytes": "16k",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
