"""patchprofile: wide-profile unification and patch-style upserts on Spark.

The public API, by mode of the reference driver:

* copy          -> ``ingest``, ``load_delimited``, ``start_ingest_stream``
* select_insert -> ``AppendJob`` + ``run_loop``, ``start_append_stream``, ``slice_range``
* unify-merge   -> ``UnifyMergeJob`` + ``run_loop``, ``start_unify_merge_stream``
* building blocks: ``ColumnPolicy``, ``unify``, ``top1_per_key``, ``merge``,
  ``merge_counts``, ``high_water``, ``ProfileStore``
"""

from patchprofile.operators.merge import merge, merge_counts, merge_tagged
from patchprofile.operators.slices import high_water, slice_range
from patchprofile.operators.unify import top1_per_key, unify
from patchprofile.plans.pipeline import AppendJob, UnifyMergeJob, run_loop
from patchprofile.plans.store import ProfileStore
from patchprofile.policy import ColumnPolicy
from patchprofile.sources.delimited import ingest, load_delimited
from patchprofile.streaming.ingest import start_ingest_stream
from patchprofile.streaming.unify_merge import start_append_stream, start_unify_merge_stream

__all__ = [
    "AppendJob", "ColumnPolicy", "ProfileStore", "UnifyMergeJob", "high_water", "ingest",
    "load_delimited", "merge", "merge_counts", "merge_tagged", "run_loop", "slice_range",
    "start_append_stream", "start_ingest_stream", "start_unify_merge_stream", "top1_per_key", "unify",
]
