"""Assignment of streaming place rows against a static metro cell index.

The source project has no streaming code; this is the same town assignment (D2 +
W1) applied to a Structured Streaming source of dump files, as a stream-static
join. Each micro-batch runs through ``foreachBatch`` so the full batch plan (the
broadcast cell index, and the chunk-merging path for hot cells) applies unchanged.
Output is written per batch id with overwrite, so a batch replayed after a failure
replaces its own folder instead of duplicating rows; progress is tracked in the
query's checkpoint location (shared storage on a cluster).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townpull.operators.radius_join import CellIndex, attach_candidates
from townpull.schema import PLACE_SCHEMA
from townpull.sources.files import DUMP_OPTIONS


def read_dump_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Dump files arriving in ``folder`` as a stream of place rows (fixed schema); all files at
    hand per micro-batch unless ``max_files_per_trigger`` says fewer."""
    reader = spark.readStream.schema(PLACE_SCHEMA).options(**DUMP_OPTIONS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def assign_batch(batch: DataFrame, index: CellIndex, version: str | None = None) -> DataFrame:
    """Town rows of one batch with ``assigned_metro_id`` (null when no metro reaches them), and the
    ``index_version`` they were assigned by, where one is given."""
    out = attach_candidates(batch, index, mode="best")
    out = out.withColumn("assigned_metro_id", F.col("best.metro_id")).drop("best")
    return out if version is None else out.withColumn("index_version", F.lit(version))


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")


def start_assignment_stream(stream: DataFrame, index: CellIndex, sink: str, checkpoint: str,
                            available_now: bool = True, version: str | None = None) -> StreamingQuery:
    """Start the stream; results land in ``{sink}/batch_id=<n>`` as Parquet. A batch that is run again
    after a failure, by whatever index then, replaces its folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        assign_batch(batch, index, version).write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(w, available_now).start()


def start_assignment_file_stream(stream: DataFrame, index: CellIndex, sink: str, checkpoint: str,
                                 available_now: bool = True, version: str | None = None) -> StreamingQuery:
    """The same by Spark's own streaming file sink, as one stateless streaming plan: the sink's log names the
    files of each batch that was committed, and readers of ``sink`` see these only, so rows are
    neither lost nor doubled when a stopped stream starts again.

    The index must have no split cells; their towns are merged by an aggregation that a stream without
    a watermark cannot end (``start_assignment_stream`` takes any index)."""
    if index.hot_cells is not None:
        raise ValueError("the index has split cells; use start_assignment_stream")
    w = assign_batch(stream, index, version).writeStream.format("parquet").outputMode("append") \
        .option("path", sink).option("checkpointLocation", checkpoint)
    return _triggered(w, available_now).start()
