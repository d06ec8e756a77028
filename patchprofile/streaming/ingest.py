"""Streaming bulk load: delimited objects -> typed raw rows + rejects, per micro-batch.

The copy mode as a stream: the file source picks up new objects (at most
``max_files_per_trigger`` per micro-batch), each micro-batch is parsed with the
loader semantics of ``sources.delimited``, stamped with its commit number
(the micro-batch id, column ``epoch``) and ingest time (``epoch_ts``), and
written to ``raw/load=<id>`` and ``rejects/load=<id>``. Writing a micro-batch
overwrites its own folder, so a replay after a crash leaves one copy; the raw
table is partitioned by commit number, so slices by commit are folder-pruned.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from patchprofile.sources.delimited import FILE, check_lines, good_rows, rejected_rows, stamp


def start_ingest_stream(spark: SparkSession, objects_dir: str, schema: T.StructType, raw_dir: str,
                        rejects_dir: str, checkpoint: str, *, max_files_per_trigger: int | None = None,
                        available_now: bool = True, interval: str = "1 second") -> StreamingQuery:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = (reader.text(objects_dir)
             .select("value", F.col("_metadata.file_path").alias(FILE)))

    def each_batch(batch_df: DataFrame, batch_id: int) -> None:
        checked = check_lines(batch_df, schema).persist(StorageLevel.DISK_ONLY)  # parsed once for both writes
        try:
            stamp(good_rows(checked), int(batch_id)).write.mode("overwrite").parquet(f"{raw_dir}/load={int(batch_id)}")
            rejected_rows(checked).write.mode("overwrite").parquet(f"{rejects_dir}/load={int(batch_id)}")
        finally:
            checked.unpersist()

    writer = lines.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
