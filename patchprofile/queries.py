"""The registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver's tables through a feed view
and returns a DataFrame. Queries that must write (staging, snapshots, files,
streams) do so under the shared ``spark.checkpoint.dir`` folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchprofile.functions.markers import is_marker
from patchprofile.operators.merge import INSERTED, STATE, UPDATED, merge_counts
from patchprofile.operators.slices import (high_water, high_water_df, labelled_slices, slice_range,
                                           split_bounds)
from patchprofile.operators.unify import top1_per_key, unify
from patchprofile.plans.steps import two_slice_run
from patchprofile.policy import NEWEST, OLDEST, ColumnPolicy
from patchprofile.session import work_dir
from patchprofile.sources.fixtures import (FEED_COLUMNS, FEED_POLICY, orders_feed, profile_feed,
                                           wide_feed, wide_load_feed, wide_load_policy, wide_policy)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SLICES = 4  # consecutive slices used by the slice queries


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _keys() -> list[str]:
    return list(FEED_POLICY.keys)


# ------------------------------------------------------------- unify ------

@register("unify")
def unify_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-22b: the first run's slice (everything up to the mark) to one row per key."""
    feed = profile_feed(spark, sf_dir)
    hi = high_water(feed, "epoch")
    return unify(slice_range(feed, "epoch", None, hi), FEED_POLICY)


@register("unify_newest")
def unify_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-19: newest non-null value per key."""
    cols = FEED_POLICY.columns_with(NEWEST)
    return unify(profile_feed(spark, sf_dir), FEED_POLICY).select(*_keys(), *cols)


@register("unify_oldest")
def unify_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-20: oldest non-null value per key."""
    cols = FEED_POLICY.columns_with(OLDEST)
    return unify(profile_feed(spark, sf_dir), FEED_POLICY).select(*_keys(), *cols)


@register("unify_named_window")
def unify_named_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-21: newest, oldest and top-row rules over one shared event order, full frame."""
    return unify(profile_feed(spark, sf_dir), FEED_POLICY).select(*_keys(), "cid", "att1", "ad", "createddate")


@register("top1_per_key")
def top1_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-22a: the newest row per key, nulls included."""
    return top1_per_key(profile_feed(spark, sf_dir), FEED_POLICY).select(*FEED_COLUMNS)


@register("unify_skewed")
def unify_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-22b on a feed where one user's two keys hold a third of the rows: keys with over a tenth of all rows are split off."""
    return unify(profile_feed(spark, sf_dir, skewed=True), FEED_POLICY, hot_share=0.1)


@register("unify_wide")
def unify_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-11: 190 computed, aliased columns over one event order."""
    return unify(wide_feed(spark, sf_dir), wide_policy())


# ------------------------------------------------------------- merge ------

def _run(spark, sf_dir, **opts):
    return two_slice_run(profile_feed(spark, sf_dir), FEED_POLICY, **opts)


@register("unify_merge")
def unify_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-30 (flagship): profile of the first half, merged with the unified second half."""
    return _run(spark, sf_dir).merged


@register("merge_upsert")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-24: the same upsert against a stored profile with the shuffle-free strategy (staged batch, checked size)."""
    return _run(spark, sf_dir, strategy="auto", staging=work_dir(spark, "upsert")).merged


@register("wide_unify_merge")
def wide_unify_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-11/O-24 at full width: 209 loaded columns, 16 dropped, 191 merged beside the keys."""
    return two_slice_run(wide_load_feed(spark, sf_dir), wide_load_policy()).merged


@register("merge_narrow_types")
def merge_narrow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-26: columns whose type cannot hold the marker are patched, never cleared."""
    feed = profile_feed(spark, sf_dir).selectExpr("uid", "utype", "epoch", "createddate", "CAST(epoch % 100 AS TINYINT) AS tiny",
                                                  "CAST(IF(epoch % 3 = 0, NULL, (epoch % 50) / 4) AS DECIMAL(4, 2)) AS dec")
    policy = ColumnPolicy(keys=FEED_POLICY.keys, order_by="createddate", tie_break=("epoch",), unify_rules={"tiny": NEWEST, "dec": NEWEST})
    return two_slice_run(feed, policy).merged.selectExpr(*_keys(), "CAST(tiny AS BIGINT) AS tiny", "CAST(dec AS DOUBLE) AS dec")


@register("merge_match")
def merge_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-23: batch keys found in the profile (equi-join on both keys)."""
    r = _run(spark, sf_dir)
    return r.batch.select(*_keys()).join(r.target.select(*_keys()), _keys(), "left_semi")


@register("merge_new_keys")
def merge_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-23: batch keys the profile lacks (they are inserted); orders feed, where
    many (customer, status) keys first appear in the second half."""
    r = two_slice_run(orders_feed(spark, sf_dir), FEED_POLICY)
    return r.batch.select(*_keys()).join(r.target.select(*_keys()), _keys(), "left_anti")


@register("merge_patch")
def merge_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-25/O-33/O-35/O-36: patched values of the matched keys."""
    r = _run(spark, sf_dir)
    return r.tagged.filter(F.col(STATE) == UPDATED).select(*_keys(), "cid", "att1", "att2", "att3")


def _batch_marker(df: DataFrame) -> F.Column:
    t = {f.name: f.dataType for f in df.schema.fields}
    m = FEED_POLICY.marker
    return (is_marker(F.col("att1"), t["att1"], m) | is_marker(F.col("att2"), t["att2"], m)
            | is_marker(F.col("att3"), t["att3"], m))


@register("merge_clear_marker")
def merge_clear_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-26/O-34: matched keys whose batch row carried the marker, after the merge."""
    # staged as the loop does, so that the batch is unified once for the merge and for the markers
    r = _run(spark, sf_dir, staging=work_dir(spark, "clear"))
    marked = r.batch.filter(_batch_marker(r.batch)).select(*_keys())
    upd = r.tagged.filter(F.col(STATE) == UPDATED)
    return upd.join(marked, _keys(), "left_semi").select(*_keys(), "att1", "att2", "att3")


@register("merge_insert_only")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-27: insert-only column after the merge (kept from the first insert)."""
    return _run(spark, sf_dir).merged.select(*_keys(), "ad")


@register("merge_marker_on_insert")
def merge_marker_on_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-28: inserted rows keep the marker as a stored value (orders feed)."""
    r = two_slice_run(orders_feed(spark, sf_dir), FEED_POLICY)
    ins = r.tagged.filter(F.col(STATE) == INSERTED)
    return ins.filter(_batch_marker(ins)).select(*_keys(), "att1", "att2", "att3")


@register("merge_marker_key")
def merge_marker_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-29: keys are patched too; a matched key equal to the marker becomes NULL."""
    feed = profile_feed(spark, sf_dir, marker_key=True)
    return two_slice_run(feed, FEED_POLICY, null_marker_keys=True).merged


@register("merge_row_counts")
def merge_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-18: rows updated, inserted, affected (= updated + inserted), untouched, total."""
    return merge_counts(_run(spark, sf_dir).tagged)


@register("out_of_order_batches")
def out_of_order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-41: the later batch wins even where its event time is older (orders feed)."""
    return two_slice_run(orders_feed(spark, sf_dir), FEED_POLICY).merged


# ------------------------------------------------------------ slices ------

@register("high_water_epoch")
def high_water_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-16: MAX(epoch), 0 when the table is empty."""
    return high_water_df(profile_feed(spark, sf_dir), "epoch", default=0)


@register("high_water_ts")
def high_water_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-15: MAX(epoch_ts); NULL (no work) when the table is empty."""
    return high_water_df(profile_feed(spark, sf_dir), "epoch_ts")


@register("slice_epoch")
def slice_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-13/O-14: consecutive half-open epoch slices (-1, b1], (b1, b2], ... covering the feed."""
    feed = profile_feed(spark, sf_dir)
    hi = high_water(feed, "epoch")
    return labelled_slices(feed, "epoch", split_bounds(-1, hi, SLICES))


@register("slice_timestamp")
def slice_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-12: consecutive ingest-time slices; the first has no lower bound (year-1 start)."""
    feed = profile_feed(spark, sf_dir)
    row = feed.agg(F.min("epoch_ts").alias("lo"), F.max("epoch_ts").alias("hi")).first()
    bounds = split_bounds(row["lo"], row["hi"], SLICES)
    bounds[0] = None
    return labelled_slices(feed, "epoch_ts", bounds)


# queries that write (staging, snapshots, objects, streams) register themselves on import
from patchprofile import queries_io  # noqa: E402,F401
