"""Structured Streaming form of the schedule upload (SR-4 + SK-1).

A folder of receivables schedules is watched as a file stream. Each micro-batch
parses its own new files and no others; the state, which file each month came
from, is kept in the table itself, of which only the touched months are read
(:func:`ledgerly.sources.io.merge_schedule`). A file that comes late does not
undo a newer one, the result does not depend on how files are spread over
micro-batches, and a repeated batch writes the same. The work of a batch does
not grow with the folder. The checkpoint lives in the shared checkpoint folder
of the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerly.session import checkpoint_dir
from ledgerly.sources import io


def start_schedule_stream(spark: SparkSession, in_dir: str, out_path: str, acquirer: str,
                          name: str = "schedule_ingest"):
    """Start the stream; returns the ``StreamingQuery``."""
    files = (spark.readStream.format("text").option("wholetext", "true").load(in_dir)
                  .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("changed")))

    def write_batch(batch, batch_id):
        lines = batch.select("file", "changed", F.posexplode(F.split(F.col("value"), r"\r?\n")).alias("pos", "line"))
        io.merge_schedule(batch.sparkSession, io.schedule_days(lines, acquirer), out_path)

    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    return (files.writeStream.foreachBatch(write_batch)
                 .option("checkpointLocation", ckpt).queryName(name).start())
