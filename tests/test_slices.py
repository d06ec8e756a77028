import datetime as dt

from pyspark.sql import functions as F

from patchprofile.operators.slices import (high_water, labelled_slices, late_rows, slice_number,
                                           slice_range, split_bounds)
from patchprofile.sources.fixtures import profile_feed


def test_split_bounds_cover_and_are_disjoint():
    b = split_bounds(-1, 99, 4)
    assert b[0] == -1 and b[-1] == 99 and b == sorted(b)
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 0, 0, 7)
    tb = split_bounds(t0, t1, 3)
    assert tb[0] == t0 and tb[-1] == t1 and tb == sorted(tb)


def test_slices_union_is_whole_feed(spark, sf_small):
    feed = profile_feed(spark, sf_small)
    hi = high_water(feed, "epoch")
    sl = labelled_slices(feed, "epoch", split_bounds(-1, hi, 4))
    assert sl.count() == feed.count()
    assert sl.select("epoch").distinct().count() == feed.count()  # disjoint
    # (a, b] + (b, c] == (a, c]
    mid = hi // 3
    a = slice_range(feed, "epoch", -1, mid).count() + slice_range(feed, "epoch", mid, hi).count()
    assert a == slice_range(feed, "epoch", -1, hi).count()


def test_empty_table_has_no_mark(spark, sf_small):
    feed = profile_feed(spark, sf_small).filter(F.lit(False))
    assert high_water(feed, "epoch") is None


def test_slice_filter_reaches_scan(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    plan = slice_range(ev, "event_id", 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(event_id,10)" in plan


def test_late_rows(spark):
    T = dt.datetime
    df = spark.createDataFrame([
        (1, T(2024, 1, 1, 10)), (2, T(2024, 1, 1, 12)),   # load 1: mark 12:00
        (3, T(2024, 1, 1, 11)), (4, T(2024, 1, 1, 13)),   # load 2: 11:00 is behind the mark
    ], "epoch long, ts timestamp_ntz")
    out = late_rows(df, slice_number("epoch", [0, 2, 4]), "ts").select("epoch").collect()
    assert [r[0] for r in out] == [3]


def test_a_slice_of_a_clustered_table_reads_its_own_row_groups(spark, sf_small, tmp_path):
    from patchprofile.sources.fixtures import profile_feed
    from patchprofile.sources.raw import read_clustered, write_clustered

    feed = profile_feed(spark, sf_small)
    write_clustered(feed, str(tmp_path / "t"), "epoch_ts", partitions=10)

    def read(path, lo, hi):
        """(rows of the slice, rows the scan gave out before the filter)"""
        df = read_clustered(spark.read.parquet(path), "epoch_ts", lo, hi)
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan()
        scans = plan.collectLeaves()
        return n, sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.size()))

    times = sorted(r[0] for r in feed.select("epoch_ts").collect())
    lo, hi = times[400], times[500]
    n, rows = read(str(tmp_path / "t"), lo, hi)
    assert n == sum(lo < t <= hi for t in times) and rows <= 3 * len(times) // 10
    assert read(str(tmp_path / "t"), None, times[-1]) == (len(times), len(times))
