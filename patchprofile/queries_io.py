"""Registered queries that write: staging, snapshots, delimited objects, streams.

Arrivals are simulated by writing the feed to a raw folder in consecutive
epoch ranges whose bounds come from the feed's own high-water mark; the jobs
then poll the growing folder exactly as the reference polls its raw table.
Every query writes under a fresh folder of the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.operators.align import align_to
from patchprofile.operators.slices import footer_mark, high_water, late_rows, slice_number, slice_range, split_bounds
from patchprofile.operators.unify import unify
from patchprofile.plans.metrics import StepLog, read_log, summarize
from patchprofile.plans.pipeline import AppendJob, UnifyMergeJob
from patchprofile.plans.store import ProfileStore
from patchprofile.queries import register
from patchprofile.session import work_dir
from patchprofile.sources import delimited as D
from patchprofile.sources.fixtures import FEED_COLUMNS, FEED_POLICY, orders_feed, profile_feed, wide_load_feed
from patchprofile.sources.fs import create_text, put_bytes
from patchprofile.sources.raw import read_clustered, write_clustered
from patchprofile.streaming.metrics import ProgressLog, observed
from patchprofile.streaming.unify_merge import feed_stream, start_append_stream, start_unify_merge_stream, write_marker

ARRIVALS = 4           # loads the feed arrives in
ROWS_PER_FILE = 1_000_000  # a load's files hold at most this many rows
FILES_PER_TRIGGER = 64     # files a stream takes per trigger; loads may be cut anywhere
BYTES_PER_TRIGGER = 256 << 20  # or this much
SLICE_FILES = 4            # files a quarter of the clustered raw table's time is cut into
ROWS_PER_OBJECT = 1000 # delimited objects hold this many epochs each


# ------------------------------------------------------------ arrivals ----

def arrival_bounds(feed: DataFrame) -> list[int]:
    hi = high_water(feed, "epoch")
    return split_bounds(-1, -1 if hi is None else hi, ARRIVALS)


def write_arrival(feed: DataFrame, raw: str, lo, hi, load: int, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One load: the epochs ``(lo, hi]`` written to the raw table's folder ``load=<n>``, and its completion record."""
    obs = Observation()
    part = slice_range(feed, "epoch", lo, hi).observe(obs, F.count(F.lit(1)).alias("rows"))
    part.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(f"{raw}/load={load}")
    write_marker(feed.sparkSession, f"{raw}-complete", load, obs.get["rows"])


def _raw_schema(feed: DataFrame) -> T.StructType:
    """The raw table's schema: the feed plus its load-number folder column."""
    return T.StructType(feed.schema.fields + [T.StructField("load", T.IntegerType())])


def _unify_merge_job(spark: SparkSession, base: str, **options) -> UnifyMergeJob:
    # Profile versions split into key-hash buckets; each merge reads and rewrites
    # only the buckets its batch touches.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = ProfileStore(spark, f"{base}/profile", buckets=buckets, keys=FEED_POLICY.keys, touched_only=True)
    return UnifyMergeJob(spark, store, FEED_POLICY, staging=f"{base}/staging", col="epoch", **options)


def _run_incremental(spark: SparkSession, sf_dir: str) -> UnifyMergeJob:
    base = work_dir(spark, "incremental")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    job = _unify_merge_job(spark, base, log=StepLog(path=f"{base}/log", spark=spark))
    for i in range(ARRIVALS):
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        job.poll(raw)
    return job


@register("incremental_unify_merge")
def incremental_unify_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-38: the unify-merge loop over four loads; the final profile."""
    return _run_incremental(spark, sf_dir).store.read()


@register("restart_batch_loop")
def restart_batch_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-39: the loop stopped after two loads; a new job on the same folders goes on after two more."""
    base = work_dir(spark, "restart")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    job = _unify_merge_job(spark, base)
    for i in range(ARRIVALS):
        if i == ARRIVALS // 2:
            job = _unify_merge_job(spark, base)  # a new process: only the folders carry over
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        job.poll(spark.read.parquet(raw))
    return job.store.read()


@register("crash_before_commit")
def crash_before_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-39: one load's version is written but the process dies before the commit; a new job does it again."""
    base = work_dir(spark, "crash")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    job = _unify_merge_job(spark, base)
    for i in range(ARRIVALS):
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        if i == 1:
            h = job.store.head()
            left = f"{job.store.root}/v{0 if h is None else h['version'] + 1:08d}-b{job.next_batch}"
            # what the dead process left: rows under the next version's path, no record
            feed.limit(10).withColumn("pbucket", F.lit(0)).write.partitionBy("pbucket").parquet(left)
            job = _unify_merge_job(spark, base)
        job.poll(spark.read.parquet(raw))
    return job.store.read()


def _metrics(spark: SparkSession, sf_dir: str) -> tuple[UnifyMergeJob, DataFrame]:
    """The step log of the loop, as its steps wrote it."""
    job = _run_incremental(spark, sf_dir)
    return job, read_log(spark, job.log.path)


@register("run_metrics")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-42: one record per unify / merge / cycle step of the loop (without the clock's columns)."""
    _, log = _metrics(spark, sf_dir)
    return log.select("step", F.col("batch_id").cast("long").alias("batch_id"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), "rows")


@register("run_metrics_summary")
def run_metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-17/O-32: min / max / total / truncating average per step kind, over durations taken from the events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ns = (F.col("event_id") * 7919 + F.col("user_id")) % 100_003
    log = e.select(F.col("event_type").alias("step"), F.col("event_id").alias("batch_id"), F.lit(None).cast("string").alias("lo"), F.lit(None).cast("string").alias("hi"),
                   F.col("user_id").cast("long").alias("rows"), F.lit(0.0).alias("started_at"), F.lit(0.0).alias("ended_at"), ns.cast("long").alias("elapsed_ns"))
    return summarize(log)


@register("staging_reset")
def staging_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-08: rows that each batch staged, and rows left in staging after the last reset."""
    job, log = _metrics(spark, sf_dir)
    after = spark.read.parquet(job.staging).agg(F.count(F.lit(1)).alias("rows_after"))
    return log.where("step = 'unify'").select(F.col("batch_id").cast("long").alias("batch_id"), F.col("rows").alias("rows_staged")).join(F.broadcast(after))


@register("incremental_append")
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-37/O-40: the ingest-time append loop over four loads, restarted after two; rows behind a passed mark are lost."""
    base = work_dir(spark, "append")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    new = lambda: AppendJob(spark, staging=f"{base}/staging", columns=FEED_COLUMNS, col="epoch_ts")
    job = new()
    for i in range(ARRIVALS):
        if i == ARRIVALS // 2:
            job = new()
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        job.poll(spark.read.parquet(raw))
    return job.read()


OVERLAP = dt.timedelta(minutes=30)  # how far the look-back loop looks behind its mark


@register("overlap_append")
def overlap_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-40: the append loop with a look-back of 30 minutes, restarted after two loads and polled twice a load: late rows are taken, none twice."""
    base = work_dir(spark, "overlap")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    new = lambda: AppendJob(spark, staging=f"{base}/staging", columns=FEED_COLUMNS, col="epoch_ts", overlap=OVERLAP, row_key=["epoch"])
    job = new()
    for i in range(ARRIVALS):
        if i == ARRIVALS // 2:
            job = new()
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        job.poll(spark.read.parquet(raw))
        job.poll(spark.read.parquet(raw))
    return job.read()


@register("poll_older_load")
def poll_older_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-37/O-38: rows above the mark that are added to the first load's folder after three later loads are merged all the same."""
    base = work_dir(spark, "older-load")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    job = _unify_merge_job(spark, base)
    for i in range(ARRIVALS):
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i if i < ARRIVALS - 1 else 0)
        job.poll(raw)
    return job.store.read()


@register("merge_event_time")
def merge_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-41: event-time precedence over four loads whose dates are out of order, the newest load first: equal to one unify of all, markers cleared."""
    base = work_dir(spark, "event-time")
    feed = orders_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    job = _unify_merge_job(spark, base, precedence="event_time")
    for n, i in enumerate(reversed(range(ARRIVALS))):
        job.run_slice(slice_range(feed, "epoch", bounds[i], bounds[i + 1]), n)
    return job.profile()


@register("late_rows_report")
def late_rows_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-40: rows whose ingest time is not above the mark left by earlier loads."""
    feed = profile_feed(spark, sf_dir)
    arrival = slice_number("epoch", arrival_bounds(feed))
    return late_rows(feed, arrival, "epoch_ts").select("epoch", "epoch_ts", "arrival_no", "mark_at_arrival")


@register("high_water_footer")
def high_water_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-16: the mark of the stored raw table from its Parquet footers; no data page is read."""
    feed = profile_feed(spark, sf_dir)
    raw = f"{work_dir(spark, 'footer')}/raw"
    _write_arrivals(spark, feed, raw, range(ARRIVALS), arrival_bounds(feed))
    return spark.createDataFrame([(footer_mark(spark, raw, "epoch"),)], "high_water bigint")


@register("slice_append")
def slice_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-06/O-09/O-10: first run of the append mode: everything up to the mark, 10 named columns."""
    staging = f"{work_dir(spark, 'slice-append')}/staging"
    job = AppendJob(spark, staging=staging, columns=FEED_COLUMNS, col="epoch_ts")
    job.poll(profile_feed(spark, sf_dir))
    return job.read()


@register("slice_clustered")
def slice_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-12: the raw table sorted by ingest time; its second quarter of time, for which only that quarter's files and row groups are read."""
    raw = f"{work_dir(spark, 'clustered')}/raw"
    write_clustered(profile_feed(spark, sf_dir), raw, "epoch_ts", partitions=4 * SLICE_FILES)
    table = spark.read.parquet(raw)
    ends = table.agg(F.min("epoch_ts").alias("lo"), F.max("epoch_ts").alias("hi")).first()
    bounds = split_bounds(ends["lo"], ends["hi"], 4)
    return read_clustered(table, "epoch_ts", bounds[1], bounds[2]).select(*FEED_COLUMNS)


@register("align_insert")
def align_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-07: unified rows inserted by name into the raw-shaped staging; missing columns are NULL."""
    feed = profile_feed(spark, sf_dir)
    staging = f"{work_dir(spark, 'align')}/staging"
    align_to(unify(feed, FEED_POLICY), feed.schema).write.mode("append").parquet(staging)
    return spark.read.parquet(staging)


# ------------------------------------------------------------- streams ----

def _write_arrivals(spark: SparkSession, feed: DataFrame, raw: str, which: range, bounds, rows_per_file: int = ROWS_PER_FILE) -> None:
    for i in which:
        write_arrival(feed, raw, bounds[i], bounds[i + 1], i, rows_per_file)


@register("stream_unify_merge")
def stream_unify_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-38 as a stream: file source, loads applied whole in load order, foreachBatch unify + merge."""
    base = work_dir(spark, "stream")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    _write_arrivals(spark, feed, raw, range(ARRIVALS), bounds)
    job = _unify_merge_job(spark, base)
    q = start_unify_merge_stream(job, feed_stream(spark, raw, _raw_schema(feed), FILES_PER_TRIGGER),
                                 f"{base}/ckpt", load_col="load", markers=f"{raw}-complete")
    q.awaitTermination()
    return job.store.read()


@register("stream_split_load")
def stream_split_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-38: every load in at least three files, two files a trigger: triggers cut loads, the result is the same."""
    base = work_dir(spark, "split")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    _write_arrivals(spark, feed, raw, range(ARRIVALS), bounds, max(1, (bounds[1] - bounds[0]) // 3))
    job = _unify_merge_job(spark, base)
    q = start_unify_merge_stream(job, feed_stream(spark, raw, _raw_schema(feed), 2), f"{base}/ckpt", load_col="load", markers=f"{raw}-complete")
    q.awaitTermination()
    return job.store.read()


@register("resume_from_checkpoint")
def resume_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-39: stop after two loads, restart on the same checkpoint after two more."""
    base = work_dir(spark, "resume")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw, ckpt = f"{base}/raw", f"{base}/ckpt"
    half = ARRIVALS // 2
    _write_arrivals(spark, feed, raw, range(half), bounds)
    job = _unify_merge_job(spark, base)
    start_unify_merge_stream(job, feed_stream(spark, raw, _raw_schema(feed), FILES_PER_TRIGGER), ckpt,
                             load_col="load", markers=f"{raw}-complete").awaitTermination()
    _write_arrivals(spark, feed, raw, range(half, ARRIVALS), bounds)
    job2 = _unify_merge_job(spark, base)  # a new process: only the folders carry over
    start_unify_merge_stream(job2, feed_stream(spark, raw, _raw_schema(feed), FILES_PER_TRIGGER), ckpt,
                             load_col="load", markers=f"{raw}-complete").awaitTermination()
    return job2.store.read()


@register("stream_load_gap")
def stream_load_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-38: load 2 arrives before load 1: it is held until load 1 is applied, so the profile is that of the loads in order."""
    base = work_dir(spark, "gap")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    for some in ([0, 2], [1], [3]):
        for i in some:
            write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        job = _unify_merge_job(spark, base)
        start_unify_merge_stream(job, feed_stream(spark, raw, _raw_schema(feed), FILES_PER_TRIGGER), f"{base}/ckpt",
                                 load_col="load", markers=f"{raw}-complete").awaitTermination()
    return job.store.read()


@register("stream_metrics")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-42 as a stream: per micro-batch the rows read (the stream's progress reports) and the keys inserted and updated (the step log)."""
    base = work_dir(spark, "stream-metrics")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    for i in range(ARRIVALS):  # one object a load, one object a trigger
        slice_range(feed, "epoch", bounds[i], bounds[i + 1]).coalesce(1).write.mode("append").parquet(f"{base}/raw")
    job = _unify_merge_job(spark, base, log=StepLog(path=f"{base}/log", spark=spark))
    progress = ProgressLog(spark, f"{base}/progress")
    spark.streams.addListener(progress)
    try:
        progress.finish(start_unify_merge_stream(job, observed(feed_stream(spark, f"{base}/raw", feed.schema, 1)), f"{base}/ckpt"))
    finally:
        spark.streams.removeListener(progress)
    merged = read_log(spark, job.log.path).where("step = 'merge'").select("batch_id", F.col("counts")["inserted"].alias("inserted"), F.col("counts")["updated"].alias("updated"))
    return progress.read().select("batch_id", "input_rows").join(merged, "batch_id")


@register("stream_archive")
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-37: objects leave the source folder once the micro-batch after theirs begins, over a restart; every row is appended once."""
    base = work_dir(spark, "archive")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    for some in (range(ARRIVALS // 2), range(ARRIVALS // 2, ARRIVALS)):
        for i in some:
            slice_range(feed, "epoch", bounds[i], bounds[i + 1]).write.mode("append").parquet(raw)
        stream = feed_stream(spark, raw, feed.schema, max_bytes_per_trigger=BYTES_PER_TRIGGER, archive=f"{base}/archive")
        start_append_stream(stream, f"{base}/staging", f"{base}/ckpt", FEED_COLUMNS).awaitTermination()
    return spark.read.parquet(f"{base}/staging")


@register("stream_overlap_append")
def stream_overlap_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-40 as a stream: every load also sends the last tenth of the load before it again; each row is appended once."""
    base = work_dir(spark, "stream-overlap")
    feed = profile_feed(spark, sf_dir)
    bounds = arrival_bounds(feed)
    raw = f"{base}/raw"
    back = (bounds[1] - bounds[0]) // 10
    for i in range(ARRIVALS):
        slice_range(feed, "epoch", bounds[i] - (back if i else 0), bounds[i + 1]).write.mode("append").parquet(raw)
        start_append_stream(feed_stream(spark, raw, feed.schema, FILES_PER_TRIGGER), f"{base}/staging", f"{base}/ckpt", FEED_COLUMNS,
                            row_key=["epoch"], ts_col="epoch_ts", overlap="2 hours").awaitTermination()
    return spark.read.parquet(f"{base}/staging")


@register("stream_append")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-37 as a stream: file source to a parquet staging sink; nothing is skipped."""
    base = work_dir(spark, "stream-append")
    feed = profile_feed(spark, sf_dir)
    raw = f"{base}/raw"
    _write_arrivals(spark, feed, raw, range(ARRIVALS), arrival_bounds(feed))
    q = start_append_stream(feed_stream(spark, raw, _raw_schema(feed), FILES_PER_TRIGGER), f"{base}/staging",
                            f"{base}/ckpt", FEED_COLUMNS)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/staging")


# -------------------------------------------------------------- ingest ----

LOAD_COLUMNS = ["uid", "utype", "createddate", "cid", "att1", "att2", "att3", "ad"]
LOAD_SCHEMA = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("utype", T.StringType()),
    T.StructField("createddate", T.TimestampNTZType()),
    T.StructField("cid", T.StringType()),
    T.StructField("att1", T.StringType()),
    T.StructField("att2", T.DoubleType()),
    T.StructField("att3", T.LongType()),
    T.StructField("ad", T.TimestampNTZType()),
])


def dirty_objects(feed: DataFrame) -> DataFrame:
    """Delimited lines of the feed with the cases a loader must handle.

    Text with a quote or with a comma and a backslash (escaped on write), and
    rows that must be rejected: short, long, and an unparsable number.
    """
    e = F.col("epoch")
    att1 = (F.when(e % 79 == 3, F.concat(F.lit('"'), F.col("att1")))
            .when(e % 73 == 4, F.concat(F.col("att1"), F.lit(",x\\y")))
            .otherwise(F.col("att1")))
    att2 = F.when(e % 83 == 11, F.concat(F.lit("x"), F.coalesce(F.col("att2").cast("string"), F.lit(""))))
    att2 = att2.otherwise(F.col("att2").cast("string"))
    body = feed.select(*[att1.alias(c) if c == "att1" else att2.alias(c) if c == "att2" else F.col(c)
                         for c in LOAD_COLUMNS], e)
    line = D.to_delimited_line(body.select(*LOAD_COLUMNS))
    line = (F.when(e % 97 == 5, F.regexp_replace(line, ",[^,]*$", ""))
            .when(e % 89 == 7, F.concat(line, F.lit(",extra")))
            .otherwise(line))
    return body.select(line.alias("value"), (e / ROWS_PER_OBJECT).cast("long").alias("object"))


def _ingest_run(spark: SparkSession, sf_dir: str) -> D.LoadResult:
    """The feed as delimited objects, a manifest that also names a missing one, and the load."""
    base = work_dir(spark, "ingest")
    objects = f"{base}/objects"
    D.write_lines(dirty_objects(profile_feed(spark, sf_dir)), objects, "object", len(LOAD_COLUMNS))
    gone = spark.range(1).select(F.lit(f"{objects}/object=missing/part-none.txt").alias("name"))
    D.write_manifest(D.scan_objects(spark, objects).select("name").union(gone), f"{base}/manifest")
    return D.ingest(spark, f"{base}/manifest", objects, LOAD_SCHEMA)


def _object_no(path_col: str) -> F.Column:
    n = F.regexp_extract(F.col(path_col), r"object=(\d+)", 1)
    return F.when(n == "", F.lit(None)).otherwise(n).cast("long")


@register("ingest_delimited")
def ingest_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02: positional comma-delimited load with escapes; bad rows are not loaded."""
    return _ingest_run(spark, sf_dir).good.select(*LOAD_COLUMNS)


@register("ingest_multi_file")
def ingest_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-03: every object of the manifest in one job; a missing object does not stop the rest."""
    return _ingest_run(spark, sf_dir).good.select(_object_no(D.FILE).alias("object_no"), *LOAD_COLUMNS)


@register("ingest_rejects")
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02/O-03: rejected rows per object and reason, from lines parsed once and stored with the good ones."""
    res = _ingest_run(spark, sf_dir).stored(f"{work_dir(spark, 'ingest-lines')}/lines")
    return (res.rejects.groupBy(_object_no(D.FILE).alias("object_no"), F.col("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("ingest_file_stats")
def ingest_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-05: rows loaded and rejected per object."""
    st = D.file_stats(_ingest_run(spark, sf_dir))
    return st.select(_object_no("file").alias("object_no"), "rows_loaded", "rows_rejected")


@register("ingest_manifest")
def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-01: the manifest's objects as read back, and whether each exists (a missing one is reported)."""
    return _ingest_run(spark, sf_dir).manifest.select(_object_no("name").alias("object_no"), "present")


@register("ingest_bad_object")
def ingest_bad_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-03/O-05: a damaged archive and an empty object among the feed's: both are reported, the rest loads."""
    base = work_dir(spark, "ingest-bad")
    objects = f"{base}/objects"
    D.write_lines(dirty_objects(profile_feed(spark, sf_dir)), objects, "object", len(LOAD_COLUMNS))
    create_text(spark, f"{objects}/object=900000001/part-0.txt.gz", "this is no archive")
    create_text(spark, f"{objects}/object=900000002/part-0.txt", "")
    res = D.load_delimited(spark, D.scan_objects(spark, objects), objects, LOAD_SCHEMA, skip_unreadable=True)
    return D.file_stats(res).select(_object_no("file").alias("object_no"), "rows_loaded", "rows_rejected", "state")


TRUNCATED, WHOLE_GZ = 900_000_003, 900_000_004


@register("ingest_truncated_object")
def ingest_truncated_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-03/O-05: an archive cut in half among whole ones leaves no row behind, is reported, and stops no other object."""
    base = work_dir(spark, "ingest-cut")
    objects = f"{base}/objects"
    lines = dirty_objects(profile_feed(spark, sf_dir))
    D.write_lines(lines, objects, "object", len(LOAD_COLUMNS))
    lines.where("object = 0").select("value").coalesce(1).write.option("compression", "gzip").text(f"{base}/gz")
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{base}/gz").first()["content"]  # one object of 1,000 lines
    put_bytes(spark, f"{objects}/object={WHOLE_GZ}/part-0.txt.gz", whole)
    put_bytes(spark, f"{objects}/object={TRUNCATED}/part-0.txt.gz", whole[: len(whole) // 2])
    res = D.load_delimited(spark, D.scan_objects(spark, objects), objects, LOAD_SCHEMA, skip_unreadable=True).stored(f"{base}/lines")
    good = res.good.groupBy(_object_no(D.FILE).alias("object_no")).agg(F.count(F.lit(1)).alias("rows_read"))
    stats = D.file_stats(res).select(_object_no("file").alias("object_no"), "rows_loaded", "rows_rejected", "state")
    return stats.join(good, "object_no", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))


@register("copy_metrics")
def copy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-05/O-17/O-42: durable copy records of every object, summarised with the time in which any object was being read.

    The clock is taken from the rows (object n from second 7n on, a line's second by its user), so that objects overlap and leave gaps.
    """
    base = work_dir(spark, "copy-metrics")
    objects = f"{base}/objects"
    D.write_lines(dirty_objects(profile_feed(spark, sf_dir)), objects, "object", len(LOAD_COLUMNS))
    user = F.regexp_extract("value", r"^(\d+),", 1).cast("long")
    clock = (_object_no(D.FILE) * 7 + user % (_object_no(D.FILE) % 12 + 1)).cast("double")
    load = D.load_delimited(spark, D.scan_objects(spark, objects), objects, LOAD_SCHEMA, clock=clock).stored(f"{base}/lines")
    D.copy_records(D.file_stats(load), 0).write.parquet(f"{base}/log")
    return summarize(spark.read.parquet(f"{base}/log"), wall_clock_steps=("copy",))


@register("ingest_control_chars")
def ingest_control_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02: control characters, backslashes and delimiters inside every third text survive a round trip."""
    objects = f"{work_dir(spark, 'ingest-control')}/objects"
    odd = F.concat(F.lit("\u0001"), F.col("att1"), F.lit("\\,\u0002\\"))
    feed = profile_feed(spark, sf_dir).withColumn("att1", F.when(F.col("epoch") % 3 == 1, odd).otherwise(F.col("att1")))
    D.write_objects(feed.select(*LOAD_COLUMNS, (F.col("epoch") / ROWS_PER_OBJECT).cast("long").alias("object")), objects, "object")
    return D.load_delimited(spark, D.scan_objects(spark, objects), objects, LOAD_SCHEMA).good.select(*LOAD_COLUMNS)


@register("wide_ingest")
def wide_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02 at full width: 209 positional columns written as delimited objects and loaded."""
    objects = f"{work_dir(spark, 'wide-ingest')}/objects"
    feed = wide_load_feed(spark, sf_dir)
    body = feed.drop("epoch")
    D.write_objects(feed.select(*body.columns, (F.col("epoch") / ROWS_PER_OBJECT).cast("long").alias("object")), objects, "object")
    return D.load_delimited(spark, D.scan_objects(spark, objects), objects, body.schema).good.select(*body.columns)


@register("ingest_stamped")
def ingest_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-04: load-time columns: commit number = object, ingest time = the load's clock (here one second an object)."""
    res = _ingest_run(spark, sf_dir)
    clock = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, object_no)")
    return D.stamp(res.good.select(_object_no(D.FILE).alias("object_no"), *LOAD_COLUMNS), F.col("object_no"), clock)


@register("stream_ingest")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02/O-03/O-04 as a stream: objects picked up as they land, parsed, stamped with the
    micro-batch id, written to a raw table partitioned by commit number."""
    from patchprofile.streaming.ingest import start_ingest_stream

    base = work_dir(spark, "stream-ingest")
    objects = f"{base}/objects"
    D.write_lines(dirty_objects(profile_feed(spark, sf_dir)), objects, "object", len(LOAD_COLUMNS))
    q = start_ingest_stream(spark, objects, LOAD_SCHEMA, f"{base}/raw", f"{base}/rejects", f"{base}/ckpt",
                            max_files_per_trigger=FILES_PER_TRIGGER)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/raw").select(*LOAD_COLUMNS)
