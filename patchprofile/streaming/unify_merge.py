"""Structured Streaming versions of the two incremental modes.

* ``start_unify_merge_stream``: a file source over arriving feed objects;
  every micro-batch is one slice, unified and merged into the profile store
  inside ``foreachBatch``. The stream checkpoint tracks which files were
  consumed, so a restart resumes where it stopped (the reference restarts at
  zero); the store's batch log skips a micro-batch that was already published
  before a crash, so replays do not apply a batch twice.
* ``start_append_stream``: the same source appended unchanged to a staging
  table through the file sink (exactly-once by its own commit log).

``availableNow`` processes what has arrived and stops, which is how a
scheduled job runs; a processing-time trigger gives the reference's polling
loop (one-second idle sleep).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from patchprofile.plans.pipeline import UnifyMergeJob
from patchprofile.sources.fs import create_text, delete_folder, path_exists, read_text


def feed_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                max_files_per_trigger: int | None = None, *, max_bytes_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """A file source over arriving feed objects. With ``archive`` the objects of a finished micro-batch are moved there, so the
    folder that every trigger lists holds only what is new."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a trigger is bounded by files or by bytes")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(source_dir)


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def write_marker(spark: SparkSession, markers: str, load: int, rows: int) -> None:
    """Say that load ``load`` is complete and holds ``rows`` rows (written by whoever writes the load, after its files)."""
    create_text(spark, f"{markers}/{int(load)}.json", json.dumps({"rows": int(rows)}))


def start_unify_merge_stream(job: UnifyMergeJob, stream: DataFrame, checkpoint: str, *,
                             load_col: str | None = None, markers: str | None = None, first_load: int = 0, available_now: bool = True,
                             interval: str = "1 second") -> StreamingQuery:
    """Unify and merge every micro-batch into the job's profile store.

    Without ``load_col`` a micro-batch is one batch (its id is the batch id).
    With ``load_col`` (the load number, e.g. a ``load=<n>`` folder of the raw table; numbers run on from ``first_load`` without
    a gap) the load is the batch, however triggers cut it: a trigger's rows are held in ``<checkpoint>-held``, by load,
    and the next load is applied, under its number as batch id, once as many of its rows are held as its record in
    ``markers`` says. Later loads wait for it, whether it is incomplete or has not begun to arrive. A trigger reads the
    folder of the load it applies and no other, and drops it afterwards. Rows beyond a load's record raise, also those
    that come after it was applied.
    """
    if (load_col is None) != (markers is None):
        raise ValueError("loads need both load_col and markers")
    spark, held = job.spark, f"{checkpoint}-held"

    def each_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()  # read once, though it is looked at several times
        try:
            take(batch_df, batch_id)
        finally:
            batch_df.unpersist()

    def take(batch_df: DataFrame, batch_id: int) -> None:
        if load_col is None:
            job.run_slice(batch_df, int(batch_id))
            return
        head = job.store.head()
        load = first_load if head is None else int(head["batch_id"]) + 1
        # rows of applied loads: a replay of the trigger that applied them, or rows nobody announced
        applied_in = None if head is None else head.get("trigger")
        if applied_in is None or int(batch_id) > applied_in:
            late = batch_df.filter(F.col(load_col) < F.lit(load)).select(F.min(load_col)).first()[0]
            if late is not None:
                raise RuntimeError(f"load {late} was applied as complete; more of its rows came in trigger {batch_id}")
        delete_folder(spark, f"{held}/_load={load - 1}")  # left where the process died after applying it
        # a replayed micro-batch replaces its own folders
        (batch_df.filter(F.col(load_col) >= F.lit(load)).withColumn("_trigger", F.lit(int(batch_id))).withColumn("_load", F.col(load_col))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_load", "_trigger").parquet(held))
        while path_exists(spark, f"{markers}/{load}.json"):
            want = json.loads(read_text(spark, f"{markers}/{load}.json"))["rows"]
            here = f"{held}/_load={load}"
            rows = spark.read.parquet(here).drop("_trigger") if path_exists(spark, here) else batch_df.limit(0)
            have = rows.count()
            if have > want:
                raise RuntimeError(f"load {load} has {have} rows, its record says {want}")
            if have < want:
                return
            job.run_slice(rows, load, trigger=int(batch_id))
            delete_folder(spark, here)
            load += 1

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def start_append_stream(stream: DataFrame, staging: str, checkpoint: str, columns: list[str], *,
                        row_key: list[str] | None = None, ts_col: str | None = None, overlap: str | None = None,
                        available_now: bool = True, interval: str = "1 second") -> StreamingQuery:
    """Append the stream unchanged. With ``row_key``, a row that is delivered again within ``overlap`` of its
    ``ts_col`` is taken once (a look-back writer sends the rows behind its mark with every load); rows older than the
    watermark that leaves are dropped as duplicates would be, so ``overlap`` must cover the greatest delay.
    """
    if row_key:
        # the watermark needs a zoned timestamp; the row itself keeps its own
        stream = (stream.withColumn("_event", F.col(ts_col).cast("timestamp")).withWatermark("_event", overlap)
                  .dropDuplicatesWithinWatermark(row_key))
    writer = (stream.select(*columns).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", staging))
    return _trigger(writer, available_now, interval).start()
