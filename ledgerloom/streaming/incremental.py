"""Documents that keep arriving in a folder, loaded batch by batch.

The same reading as a pipeline run, fed by a file stream. Spark's checkpoint
remembers which files were taken; each micro-batch is one run of the run log, whose
partition is replaced as a whole, so a batch repeated after a failure leaves no second copy.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.workspace import Workspace
from ledgerloom.schemas import DOCUMENT_TYPES
from ledgerloom.sources.xml_documents import file_documents, flatten_documents

# Layout of Spark's binary file source.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def start_incremental_load(
    workspace: Workspace, folder: str, checkpoint: str, stream_name: str = "stream"
) -> StreamingQuery:
    """Load what is in ``folder`` and was not loaded before, then stop."""
    files = (
        workspace.spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", "*.[xX][mM][lL]")
        .load(folder)
    )
    lines = flatten_documents(file_documents(files))
    # A stream is named by its checkpoint, so two of them never share a run.
    stream = f"{stream_name}-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"

    def load(batch: DataFrame, batch_id: int) -> None:
        run_id = workspace.runs.create("stream", stream_name, "incremental_load", run_id=f"{stream}-{batch_id:08d}")
        batch.persist()  # parsed once for both histories
        loaded = {}
        for staging, kind in zip(workspace.histories, DOCUMENT_TYPES.values(), strict=True):
            rows = batch.filter(F.col("TipoDocumento") == kind)
            loaded[staging] = workspace.load_run(staging, rows, run_id, replace_run=True)
        batch.unpersist()
        workspace.runs.succeed(run_id, workspace.row_counts(*loaded.values()), {})

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
