import duckdb

import oracle_sql as O
from check_oracle import compare, duck
from patchprofile.plans.metrics import StepLog, summarize
from patchprofile.plans.pipeline import UnifyMergeJob
from patchprofile.plans.store import ProfileStore
from patchprofile import queries_io as QI
from patchprofile.session import work_dir
from patchprofile.sources.fixtures import FEED_POLICY, profile_feed


def _oracle(sf_dir, sql):
    return duck(sf_dir).execute(sql).df()


def test_incremental_equals_replay(spark, sf_small):
    got = QI.incremental_unify_merge(spark, sf_small).toPandas()
    ok, msg = compare(got, _oracle(sf_small, O.replay_arrivals_sql(O.profile_feed_sql())))
    assert ok, msg


def test_stream_equals_batch(spark, sf_small):
    s = QI.stream_unify_merge(spark, sf_small).toPandas()
    ok, msg = compare(s, _oracle(sf_small, O.replay_arrivals_sql(O.profile_feed_sql())))
    assert ok, msg


def test_published_batch_is_skipped(spark, sf_small):
    base = work_dir(spark, "test-skip")
    feed = profile_feed(spark, sf_small)
    store = ProfileStore(spark, f"{base}/profile")
    job = UnifyMergeJob(spark, store, FEED_POLICY, staging=f"{base}/staging")
    first = job.run_slice(feed, 7)
    again = job.run_slice(feed, 7)
    assert first["skipped"] is False and again == {"skipped": True}
    assert store.head()["version"] == 0


def test_mark_never_moves_back(spark, sf_small):
    base = work_dir(spark, "test-mark")
    feed = profile_feed(spark, sf_small)
    job = UnifyMergeJob(spark, ProfileStore(spark, f"{base}/p"), FEED_POLICY, staging=f"{base}/s")
    assert job.poll(feed) is True
    assert job.poll(feed) is False                      # no new rows
    assert job.poll(feed.filter("epoch < 0")) is False  # empty table: no work, mark kept
    assert job.prev == feed.agg({"epoch": "max"}).first()[0]


def test_summary_truncates_average(spark):
    log = StepLog()
    log.records = [("merge", 0, None, None, 1, 0.0, 1.0, 10), ("merge", 1, None, None, 2, 1.0, 2.0, 11),
                   ("merge", 2, None, None, 3, 2.0, 3.0, 12), ("merge", 3, None, None, 4, 3.0, 4.0, 12)]
    r = summarize(log.to_df(spark)).first()
    assert (r["runs"], r["min_ns"], r["max_ns"], r["total_ns"], r["avg_ns"]) == (4, 10, 12, 45, 11)
    wall = summarize(log.to_df(spark), wall_clock_steps=("merge",)).first()
    assert wall["total_ns"] == 4_000_000_000


def test_bucketed_store_reads_without_profile_shuffle(spark, sf_small):
    from patchprofile.operators.merge import merge
    from patchprofile.operators.unify import unify
    from patchprofile.plans.steps import as_profile
    base = work_dir(spark, "test-bucketed")
    feed = profile_feed(spark, sf_small)
    store = ProfileStore(spark, f"{base}/p", buckets=4, keys=FEED_POLICY.keys)
    store.publish(as_profile(unify(feed, FEED_POLICY), FEED_POLICY), 0)
    n = store.read().count()
    # a new process: the catalog entry is gone, only the folders remain
    spark.sql(f"DROP TABLE {store._table(0)}")
    again = ProfileStore(spark, f"{base}/p", buckets=4, keys=FEED_POLICY.keys).read()
    assert again.count() == n
    staged_path = f"{base}/staged"
    unify(feed.filter("epoch > 300"), FEED_POLICY).write.parquet(staged_path)
    out = merge(again, spark.read.parquet(staged_path), FEED_POLICY, strategy="shuffle", unique_batch=True)  # as the loop merges what unify staged
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch side only


def test_touched_bucket_rewrite(spark, sf_small):
    """A batch rewrites only the buckets of its keys; the profile equals a full rewrite."""
    from patchprofile.operators.merge import merge
    from patchprofile.operators.slices import slice_range
    from patchprofile.operators.unify import unify
    from patchprofile.plans.steps import as_profile
    from patchprofile.sources.fs import list_names
    base = work_dir(spark, "test-touched")
    feed = profile_feed(spark, sf_small)
    first = as_profile(unify(slice_range(feed, "epoch", -1, 500), FEED_POLICY), FEED_POLICY)
    store = ProfileStore(spark, f"{base}/p", buckets=16, keys=FEED_POLICY.keys, touched_only=True)
    store.publish(first, 0)
    batch_path = f"{base}/batch"
    unify(slice_range(feed, "epoch", 500, 520), FEED_POLICY).write.parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    store.publish(merge(store.read_for(batch), batch, FEED_POLICY), 1)
    written = [n for n in list_names(spark, store.head()["path"]) if n.startswith("pbucket=")]
    n_touched = batch.select(store.bucket_of()).distinct().count()
    assert len(written) == n_touched < 16
    full = merge(first, batch, FEED_POLICY, strategy="shuffle")
    got = store.read()
    assert sorted(got.columns) == sorted(full.columns)
    assert sorted(map(tuple, got.select(*full.columns).collect()), key=str) == \
        sorted(map(tuple, full.collect()), key=str)
    # a new process sees the same profile from the commit files alone
    again = ProfileStore(spark, f"{base}/p", buckets=16, keys=FEED_POLICY.keys, touched_only=True).read()
    assert again.count() == got.count()


def test_run_loop_stops_when_idle(spark, sf_small):
    from patchprofile.plans.pipeline import run_loop
    base = work_dir(spark, "test-loop")
    feed = profile_feed(spark, sf_small)
    job = UnifyMergeJob(spark, ProfileStore(spark, f"{base}/p"), FEED_POLICY, staging=f"{base}/s")
    assert run_loop(job, lambda: feed, interval=0.01, max_idle_polls=2) == 1
    assert job.store.read().count() == feed.select("uid", "utype").distinct().count()


def test_stream_restart_on_finished_checkpoint_changes_nothing(spark, sf_small):
    from patchprofile import queries_io as QI
    from patchprofile.streaming.unify_merge import feed_stream, start_unify_merge_stream
    base = work_dir(spark, "test-restart")
    feed = profile_feed(spark, sf_small)
    raw = f"{base}/raw"
    QI._write_arrivals(spark, feed, raw, range(QI.ARRIVALS), QI.arrival_bounds(feed))
    for _ in range(2):
        job = QI._unify_merge_job(spark, base)
        start_unify_merge_stream(job, feed_stream(spark, raw, QI._raw_schema(feed), 1),
                                 f"{base}/ckpt", load_col="load", markers=f"{raw}-complete").awaitTermination()
    assert job.store.head()["version"] == QI.ARRIVALS - 1  # the second run found nothing new


def test_empty_first_batch_then_data(spark, sf_small):
    base = work_dir(spark, "test-empty-first")
    feed = profile_feed(spark, sf_small)
    store = ProfileStore(spark, f"{base}/p", buckets=4, keys=FEED_POLICY.keys, touched_only=True)
    job = UnifyMergeJob(spark, store, FEED_POLICY, staging=f"{base}/s")
    job.run_slice(feed.filter("epoch < 0"), 0)           # nothing arrived in this batch
    fresh = ProfileStore(spark, f"{base}/p", buckets=4, keys=FEED_POLICY.keys, touched_only=True)
    assert fresh.read().count() == 0                      # schema comes from the commit record
    job.run_slice(feed, 1)
    assert store.read().count() == feed.select("uid", "utype").distinct().count()


def test_restarted_loop_goes_on_from_the_published_mark(spark, sf_small):
    base = work_dir(spark, "test-loop-restart")
    feed = profile_feed(spark, sf_small)
    half = feed.agg({"epoch": "max"}).first()[0] // 2
    job = QI._unify_merge_job(spark, base)
    assert job.poll(feed.filter(f"epoch <= {half}")) is True
    again = QI._unify_merge_job(spark, base)
    assert (again.prev, again.next_batch) == (half, 1)
    assert again.poll(feed) is True and again.poll(feed) is False
    assert again.store.head()["version"] == 1


def test_crash_before_commit_is_written_again(spark, sf_small, monkeypatch):
    import pytest

    from patchprofile.plans import store as S
    base = work_dir(spark, "test-crash")
    feed = profile_feed(spark, sf_small)
    job = QI._unify_merge_job(spark, base)
    with monkeypatch.context() as m:
        m.setattr(S, "create_text", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            job.poll(feed)
    assert QI._unify_merge_job(spark, base).store.head() is None
    again = QI._unify_merge_job(spark, base)
    assert again.poll(feed) is True
    assert again.store.read().count() == feed.select("uid", "utype").distinct().count()


def test_split_and_incomplete_loads_wait(spark, sf_small):
    from patchprofile.streaming.unify_merge import feed_stream, start_unify_merge_stream, write_marker
    base = work_dir(spark, "test-split")
    feed = profile_feed(spark, sf_small)
    raw = f"{base}/raw"
    n = feed.count()
    feed.repartition(3).write.parquet(f"{raw}/load=0")
    run = lambda: start_unify_merge_stream(job, feed_stream(spark, raw, QI._raw_schema(feed), 1), f"{base}/ckpt",
                                           load_col="load", markers=f"{base}/done").awaitTermination()
    job = QI._unify_merge_job(spark, base)
    run()
    assert job.store.head() is None                       # nothing says that the load is complete
    write_marker(spark, f"{base}/done", 0, n)
    feed.limit(1).write.parquet(f"{raw}/load=1")
    run()
    assert job.store.head()["batch_id"] == 0              # load 0 whole, load 1 waits for its record
    assert job.store.read().count() == feed.select("uid", "utype").distinct().count()


def test_append_restart_and_unfinished_slice(spark, sf_small):
    from patchprofile.plans.pipeline import AppendJob
    base = work_dir(spark, "test-append")
    feed = profile_feed(spark, sf_small)
    new = lambda: AppendJob(spark, staging=f"{base}/s", columns=["epoch"], col="epoch")
    assert new().poll(feed.filter("epoch < 500")) is True
    feed.limit(5).select("epoch").write.parquet(f"{base}/s/slice=1")  # a slice that was cut off
    job = new()
    assert job.read().count() == 500
    assert job.poll(feed) is True and new().poll(feed) is False
    assert job.read().count() == feed.count()


def test_bucket_writes_are_clustered(spark, sf_small):
    base = work_dir(spark, "test-files")
    feed = profile_feed(spark, sf_small).repartition(12)
    store = ProfileStore(spark, f"{base}/p", buckets=16, keys=("uid",), touched_only=True)
    store.publish(feed, 0)
    assert len(spark.read.parquet(*store.head()["buckets"].values()).inputFiles()) <= 16


def test_poll_finds_rows_in_older_loads_and_skips_merged_row_groups(spark, sf_small):
    """Rows above the mark count wherever they lie; the slice's bounds reach the scan; a new process does alike."""
    from patchprofile.operators.slices import slice_range
    from patchprofile.plans.pipeline import AppendJob
    base = work_dir(spark, "test-older-load")
    feed = profile_feed(spark, sf_small)
    raw = f"{base}/raw"
    new = lambda: AppendJob(spark, staging=f"{base}/s", columns=["epoch"], col="epoch")
    job = QI._unify_merge_job(spark, base)
    for load, cond in ((0, "epoch < 300"), (1, "epoch BETWEEN 300 AND 599"), (1, "epoch BETWEEN 600 AND 699"), (0, "epoch >= 700")):
        feed.filter(cond).write.mode("append").parquet(f"{raw}/load={load}")
        assert job.poll(raw) is True and new().poll(spark.read.parquet(raw)) is True
    assert job.poll(raw) is False and new().poll(spark.read.parquet(raw)) is False
    plan = slice_range(spark.read.parquet(raw), "epoch", 699, 999)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(epoch,699)" in plan
    assert sorted(r[0] for r in new().read().collect()) == sorted(r[0] for r in feed.select("epoch").collect())
    assert job.store.read().count() == feed.select("uid", "utype").distinct().count()


def test_mark_from_footers(spark, sf_small):
    from pyspark.sql import functions as F

    from patchprofile.operators.slices import footer_mark, high_water
    base = work_dir(spark, "test-footer")
    feed = profile_feed(spark, sf_small)
    feed.write.parquet(f"{base}/raw/load=0")
    feed.where("epoch < 10").write.parquet(f"{base}/raw/load=1")
    feed.limit(0).write.parquet(f"{base}/none")
    for col in ("epoch", "epoch_ts", "att2", "utype"):
        assert footer_mark(spark, f"{base}/raw", col) == high_water(spark.read.parquet(f"{base}/raw"), col)
    assert footer_mark(spark, f"{base}/none", "epoch") is None
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = own.read.parquet(f"{base}/raw").agg(F.max("epoch"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(epoch)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left alone


def test_overlap_takes_late_rows_once(spark, sf_small):
    """Rows behind the mark, with and without the mark moving; nothing twice; rows behind the look-back stay lost; restarts."""
    from patchprofile.plans.pipeline import AppendJob
    base = work_dir(spark, "test-overlap")
    raw = f"{base}/raw"

    def put(*rows):
        spark.createDataFrame(list(rows), "id long, at long").write.mode("append").parquet(raw)

    new = lambda: AppendJob(spark, staging=f"{base}/s", columns=["id", "at"], col="at", overlap=10, row_key=["id"])
    poll = lambda: new().poll(spark.read.parquet(raw))
    put((1, 100), (2, 95), (None, 99))
    assert poll() is True and poll() is False
    put((3, 92), (4, 80))
    assert poll() is True                       # the mark has not moved; 4 is behind the look-back
    put((5, 120), (6, 101), (7, 100), (8, 90))
    assert poll() is True and poll() is False   # 8 is on the open end of (90, 120]
    put((9, 110), (10, 111))
    assert poll() is True and poll() is False
    job = new()
    assert job.prev == 120
    assert sorted(map(tuple, job.read().collect()), key=str) == sorted([(1, 100), (2, 95), (None, 99), (3, 92), (5, 120), (6, 101), (7, 100), (10, 111)], key=str)


def test_overlap_needs_a_row_key(spark):
    import pytest

    from patchprofile.plans.pipeline import AppendJob
    with pytest.raises(ValueError):
        AppendJob(spark, staging="x", columns=["at"], col="at", overlap=10)


def test_a_trigger_reads_no_applied_load(spark, sf_small, monkeypatch):
    from patchprofile.sources.fs import path_exists
    from patchprofile.streaming.unify_merge import feed_stream, start_unify_merge_stream
    base = work_dir(spark, "test-held")
    feed = profile_feed(spark, sf_small)
    raw, bounds, read = f"{base}/raw", QI.arrival_bounds(feed), []
    job = QI._unify_merge_job(spark, base)
    run_slice = job.run_slice
    monkeypatch.setattr(job, "run_slice", lambda df, load, **k: (read.append((load, sorted(df.inputFiles()))), run_slice(df, load, **k))[1])
    for i in range(3):
        QI.write_arrival(feed, raw, bounds[i], bounds[i + 1], i)
        start_unify_merge_stream(job, feed_stream(spark, raw, QI._raw_schema(feed), 1), f"{base}/ckpt", load_col="load", markers=f"{raw}-complete").awaitTermination()
    assert [load for load, _ in read] == [0, 1, 2]
    assert all(f"_load={load}/" in f for load, files in read for f in files)
    assert not any(path_exists(spark, f"{base}/ckpt-held/_load={i}") for i in range(3))  # dropped once applied


def test_rows_of_an_applied_load_raise(spark, sf_small):
    import pytest

    from patchprofile.streaming.unify_merge import feed_stream, start_unify_merge_stream
    base = work_dir(spark, "test-late-load")
    feed = profile_feed(spark, sf_small)
    raw, bounds = f"{base}/raw", QI.arrival_bounds(feed)
    run = lambda: start_unify_merge_stream(QI._unify_merge_job(spark, base), feed_stream(spark, raw, QI._raw_schema(feed)), f"{base}/ckpt",
                                           load_col="load", markers=f"{raw}-complete").awaitTermination()
    QI.write_arrival(feed, raw, bounds[0], bounds[1], 0)
    run()
    feed.limit(1).write.mode("append").parquet(f"{raw}/load=0")
    with pytest.raises(Exception, match="more of its rows came"):
        run()


def test_replayed_trigger_of_an_applied_load_changes_nothing(spark, sf_small, monkeypatch):
    """The process dies after publishing, before the stream's checkpoint moves on: the same trigger comes again."""
    import pytest

    from patchprofile.streaming import unify_merge as U
    base = work_dir(spark, "test-replay")
    feed = profile_feed(spark, sf_small)
    raw, bounds = f"{base}/raw", QI.arrival_bounds(feed)
    QI._write_arrivals(spark, feed, raw, range(2), bounds)
    run = lambda: U.start_unify_merge_stream(QI._unify_merge_job(spark, base), U.feed_stream(spark, raw, QI._raw_schema(feed)), f"{base}/ckpt",
                                             load_col="load", markers=f"{raw}-complete").awaitTermination()
    real = U.delete_folder
    with monkeypatch.context() as m:
        m.setattr(U, "delete_folder", lambda s, p: (_ for _ in ()).throw(OSError("died")) if p.endswith("_load=0") else real(s, p))
        with pytest.raises(Exception, match="died"):
            run()
    assert QI._unify_merge_job(spark, base).store.head()["batch_id"] == 0
    run()
    store = QI._unify_merge_job(spark, base).store
    assert store.head()["batch_id"] == 1 and store.head()["version"] == 1
    assert store.read().count() == feed.where(f"epoch <= {bounds[2]}").select("uid", "utype").distinct().count()


def test_steps_are_logged_as_they_end(spark, sf_small):
    import pytest

    from patchprofile.plans.metrics import read_log
    base = work_dir(spark, "test-log")
    log = StepLog(path=f"{base}/log", spark=spark)
    with log.step("unify", 0):
        pass
    assert [r.step for r in read_log(spark, f"{base}/log").collect()] == ["unify"]  # before the batch is over
    with pytest.raises(OSError), log.step("merge", 0):
        raise OSError("died")
    again = StepLog(path=f"{base}/log", spark=spark)  # a new process
    with again.step("merge", 0) as rec:
        rec["rows"], rec["counts"] = 3, {"inserted": 2}
    got = {r.step: r for r in read_log(spark, f"{base}/log").collect()}
    assert set(got) == {"unify", "merge"} and got["merge"].rows == 3 and got["merge"].counts == {"inserted": 2}


def test_busy_time_counts_overlaps_once_and_gaps_not(spark):
    from patchprofile.plans.metrics import METRICS_SCHEMA, busy_ns
    spans = [("copy", 0, 10), ("copy", 2, 3), ("copy", 10, 12), ("copy", 20, 21), ("copy", 20, 25), ("merge", 1, 2), ("merge", None, 5)]
    rows = [(s, 0, None, None, 1, a and float(a) if a is None else float(a), float(b), 0, None) for s, a, b in spans]
    got = {r.step: r.busy_ns for r in busy_ns(spark.createDataFrame(rows, METRICS_SCHEMA)).collect()}
    assert got == {"copy": 17_000_000_000, "merge": 1_000_000_000}


def test_archive_leaves_only_the_newest_objects(spark, sf_small, tmp_path):
    """Over restarts: an object moves once the micro-batch after its own is planned, so the listing stays short; no row is lost or taken twice."""
    import glob
    import time

    from patchprofile.streaming.unify_merge import feed_stream, start_append_stream
    feed = profile_feed(spark, sf_small)
    raw, last = str(tmp_path / "raw"), set()
    for n in range(4):
        feed.where(f"epoch % 4 = {n}").coalesce(1).write.mode("append").parquet(raw)
        here = set(glob.glob(f"{raw}/*.parquet"))
        newest = here - last
        stream = feed_stream(spark, raw, feed.schema, archive=str(tmp_path / "archive"))
        start_append_stream(stream, str(tmp_path / "s"), str(tmp_path / "ckpt"), ["epoch"]).awaitTermination()
        until = time.time() + 20
        while set(glob.glob(f"{raw}/*.parquet")) != newest and time.time() < until:
            time.sleep(0.2)
        last = set(glob.glob(f"{raw}/*.parquet"))
        assert last == newest and len(newest) == 1
    assert len(glob.glob(f"{tmp_path}/archive/**/*.parquet", recursive=True)) == 3
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == sorted(r[0] for r in feed.select("epoch").collect())
