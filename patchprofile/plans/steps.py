"""Slice -> unify -> merge compositions (pure DataFrame -> DataFrame steps)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation

from patchprofile.operators.merge import STATE, merge_tagged, size_exprs, to_batch_size
from patchprofile.operators.slices import high_water, slice_range
from patchprofile.operators.unify import unify
from patchprofile.policy import ColumnPolicy


def as_profile(batch: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """A first batch merged into an empty profile: every row inserted as is."""
    return batch.select(*policy.profile_columns())


def unify_slice(feed: DataFrame, policy: ColumnPolicy, col: str, lo: Any, hi: Any,
                method: str = "auto") -> DataFrame:
    return unify(slice_range(feed, col, lo, hi), policy, method=method)


@dataclass
class TwoSliceRun:
    """The profile built from the first half of a feed, then merged with the second.

    Bounds come from the feed's own high-water mark: ``(-1, hi // 2]`` and
    ``(hi // 2, hi]``, so both slices together are the whole feed.
    """
    lo: int
    mid: int
    hi: int
    target: DataFrame
    batch: DataFrame
    tagged: DataFrame

    @property
    def merged(self) -> DataFrame:
        return self.tagged.drop(STATE)


def two_slice_run(feed: DataFrame, policy: ColumnPolicy, col: str = "epoch", *,
                  strategy: str = "shuffle", staging: str | None = None, **merge_opts) -> TwoSliceRun:
    """With ``staging`` the profile and the batch are written there first, as the loop does: each is
    computed once, and the batch's size is observed on its write."""
    hi = high_water(feed, col)
    hi = -1 if hi is None else hi
    lo, mid = -1, hi // 2
    target = as_profile(unify_slice(feed, policy, col, lo, mid), policy)
    batch = unify_slice(feed, policy, col, mid, hi)
    if staging is not None:
        spark, obs = feed.sparkSession, Observation()
        target.write.parquet(f"{staging}/profile")
        batch = batch.select(*policy.profile_columns())
        batch.observe(obs, *size_exprs(batch.schema)).write.parquet(f"{staging}/batch")
        merge_opts["known_size"] = to_batch_size(batch.schema, obs.get["n"], obs.get["v"])
        target, batch = spark.read.parquet(f"{staging}/profile"), spark.read.parquet(f"{staging}/batch")
    # Both sides leave their aggregate hash-partitioned by the keys, so the
    # full outer join needs no further exchange.
    tagged = merge_tagged(target, batch, policy, strategy=strategy, unique_batch=True, **merge_opts)
    return TwoSliceRun(lo, mid, hi, target, batch, tagged)
