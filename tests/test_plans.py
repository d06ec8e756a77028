"""Plan shape: pushed filters, one window, no Python in the data path, no profile shuffle."""

from patchprofile.operators.merge import merge
from patchprofile.operators.slices import slice_range
from patchprofile.operators.unify import unify
from patchprofile.plans.steps import as_profile
from patchprofile.sources.fixtures import FEED_POLICY, profile_feed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_form_is_one_window_and_pushes_slice(spark, sf_small):
    feed = profile_feed(spark, sf_small)
    p = _plan(unify(slice_range(feed, "epoch", 10, 500), FEED_POLICY, method="window"))
    assert p.count("Window [") + p.count("Window(") >= 1
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,10), LessThanOrEqual(event_id,500)]" in p
    assert "Python" not in p


def test_aggregate_form_has_partial_aggregate(spark, sf_small):
    df = unify(profile_feed(spark, sf_small), FEED_POLICY, method="aggregate")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "partial_" in plan


def test_broadcast_merge_never_shuffles_profile(spark, sf_small, tmp_path):
    feed = profile_feed(spark, sf_small)
    prof_path = str(tmp_path / "profile")
    as_profile(unify(feed, FEED_POLICY), FEED_POLICY).write.parquet(prof_path)
    target = spark.read.parquet(prof_path)
    batch = unify(slice_range(feed, "epoch", 100, 200), FEED_POLICY, method="window")
    out = merge(target, batch, FEED_POLICY, strategy="broadcast", unique_batch=True)
    out.explain()  # printed for the log
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # every exchange in the plan is a broadcast or sits on the batch side (the window's shuffle)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
