import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from patchprofile.operators.unify import top1_per_key, unify
from patchprofile.policy import NEWEST, OLDEST, ROW, ColumnPolicy
from patchprofile.sources.fixtures import FEED_POLICY, profile_feed

POLICY = ColumnPolicy(keys=("k",), order_by="d", tie_break=("e",),
                      unify_rules={"c": ROW, "a": NEWEST, "b": OLDEST, "d": ROW})
SCHEMA = "k string, d timestamp_ntz, e long, c string, a string, b string"
T = dt.datetime


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("method", ["window", "aggregate", "auto"])
def test_rules(spark, method):
    data = [
        ("k1", T(2024, 1, 1), 1, "c1", "old", "first"),
        ("k1", T(2024, 1, 3), 3, None, None, None),       # newest row: row rule keeps its NULL
        ("k1", T(2024, 1, 2), 2, "c2", "mid", "second"),
        ("k2", T(2024, 1, 1), 4, "x", None, None),        # all-null column stays NULL
        ("k3", None, 5, "n", "nulltime", "z"),            # NULL event time ranks newest
        ("k3", T(2030, 1, 1), 6, "m", "future", "y"),
    ]
    out = unify(_df(spark, data), POLICY, method=method).select("k", "c", "a", "b", "d")
    assert rows(out) == rows(spark.createDataFrame([
        ("k1", None, "mid", "first", T(2024, 1, 3)),
        ("k2", "x", None, None, T(2024, 1, 1)),
        ("k3", "n", "nulltime", "y", None),
    ], "k string, c string, a string, b string, d timestamp_ntz"))


@pytest.mark.parametrize("method", ["window", "aggregate"])
def test_ties_broken_by_tie_break(spark, method):
    data = [("k", T(2024, 1, 1), 1, "c1", "a1", "b1"), ("k", T(2024, 1, 1), 2, "c2", "a2", "b2")]
    out = unify(_df(spark, data), POLICY, method=method).select("c", "a", "b").collect()
    assert tuple(out[0]) == ("c2", "a2", "b1")


def test_null_keys_group_together(spark):
    data = [(None, T(2024, 1, 1), 1, "c1", "a1", None), (None, T(2024, 1, 2), 2, "c2", None, "b2")]
    out = unify(_df(spark, data), POLICY, method="auto", hot_key_rows=1).collect()
    assert len(out) == 1 and out[0]["a"] == "a1" and out[0]["c"] == "c2"


def test_forms_agree_on_feed(spark, sf_small):
    feed = profile_feed(spark, sf_small)
    w = rows(unify(feed, FEED_POLICY, method="window"))
    a = rows(unify(feed, FEED_POLICY, method="aggregate"))
    split = rows(unify(feed, FEED_POLICY, method="auto", hot_key_rows=5))  # most keys are "hot"
    assert w == a == split
    assert len(w) > 0


def test_unify_is_idempotent(spark, sf_small):
    feed = profile_feed(spark, sf_small)
    once = unify(feed, FEED_POLICY)
    twice = unify(once.withColumn("epoch", F.lit(0).cast("long")), FEED_POLICY)
    assert rows(once) == rows(twice.select(*once.columns))


def test_top1_is_newest_row(spark):
    data = [("k", T(2024, 1, 1), 1, "c1", "a1", "b1"), ("k", T(2024, 1, 2), 2, "c2", None, None)]
    out = top1_per_key(_df(spark, data), POLICY).collect()
    assert len(out) == 1 and out[0]["e"] == 2 and out[0]["a"] is None


def test_unknown_rule_rejected():
    with pytest.raises(ValueError):
        ColumnPolicy(keys=("k",), order_by="d", unify_rules={"a": "median"})


def test_hot_key_split_on_skewed_feed(spark, sf_small):
    """One key holds a third of the rows: only it goes through the aggregate form."""
    from patchprofile.operators.unify import hot_hashes, key_hash, key_sketch
    feed = profile_feed(spark, sf_small, skewed=True)
    keys = ["uid", "utype"]
    hot = hot_hashes(key_sketch(feed, keys), 100, 10)
    assert hot and {r["uid"] for r in feed.where(key_hash(keys).isin(hot)).select("uid").distinct().collect()} == {0}
    assert hot_hashes(key_sketch(feed, keys), 10**6, 10, hot_share=0.1) == hot
    assert hot_hashes(key_sketch(feed, keys), 1, 10) is None                     # more hot keys than the bound
    assert hot_hashes(key_sketch(feed.limit(0), keys), 1, 10) == []
    # sketches of two loads, united, are the sketch of both
    both = key_sketch(feed.where("epoch % 2 = 0"), keys).unionByName(key_sketch(feed.where("epoch % 2 = 1"), keys))
    assert sorted(hot_hashes(both, 100, 10)) == sorted(hot)
    # no key is shuffled to find them: sketches by group of tasks, then one
    plan = key_sketch(feed, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_approx_top_k_accumulate" in plan
    split = unify(feed, FEED_POLICY, method="auto", hot_key_rows=100)
    assert rows(split) == rows(unify(feed, FEED_POLICY, method="window"))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "max_by" in plan and "Window" in plan


def test_row_order_and_partitioning_do_not_matter(spark, sf_small):
    feed = profile_feed(spark, sf_small)
    base = rows(unify(feed, FEED_POLICY))
    assert rows(unify(feed.repartition(7), FEED_POLICY)) == base
    assert rows(unify(feed.orderBy(F.rand(3)).coalesce(3), FEED_POLICY)) == base
