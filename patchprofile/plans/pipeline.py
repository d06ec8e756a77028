"""Incremental jobs: append slices to staging, and unify -> merge -> publish.

Both jobs keep a high-water mark: a step runs when the feed's ``MAX(col)`` has
moved past the last mark and works on the slice ``(prev, mark]``. Unlike the
reference loop, a missing mark (empty table) means "no work" and the mark
never moves backwards, so a failed read cannot re-append the whole table.

Every step writes its result (staging, then a new profile version), so batch
lineage never grows across steps and a lost executor only costs the current
write's tasks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from patchprofile.operators.merge import (INSERTED, STATE, UNTOUCHED, UPDATED, merge_tagged, size_exprs,
                                          to_batch_size)
from patchprofile.operators.slices import footer_mark, high_water, look_back, slice_range
from patchprofile.operators.registers import merge_registers_tagged, register_values, unify_registers
from patchprofile.operators.unify import HOT_KEY_ROWS, unify
from patchprofile.plans.metrics import StepLog
from patchprofile.plans.store import ProfileStore, decode_mark, encode_mark
from patchprofile.policy import ColumnPolicy
from patchprofile.sources.fs import create_text, list_names, read_text


def reset_staging(spark: SparkSession, path: str, schema) -> None:
    """Truncate staging: replace its contents with no rows of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


@dataclass
class UnifyMergeJob:
    """Slice -> unify -> staging -> merge with the stored profile -> publish.

    ``precedence``: ``batch`` as in the reference (the later batch wins), or ``event_time``, where the store holds a
    register per column and the later event wins, however the feed is cut into batches. ``profile`` gives the values of either.
    """
    spark: SparkSession
    store: ProfileStore
    policy: ColumnPolicy
    staging: str
    col: str = "epoch"
    prev: Any = None
    strategy: str = "auto"
    unify_method: str = "auto"
    hot_key_rows: int = HOT_KEY_ROWS
    log: StepLog = field(default_factory=StepLog)
    next_batch: int | None = None
    precedence: str = "batch"

    def __post_init__(self) -> None:
        """A new process goes on from the newest published version: its mark and the batch after it."""
        if self.precedence not in ("batch", "event_time"):
            raise ValueError("precedence is 'batch' or 'event_time'")
        h = self.store.head()
        if self.prev is None:
            self.prev = self.store.mark()
        if self.next_batch is None:
            self.next_batch = 0 if h is None else int(h["batch_id"]) + 1

    def profile(self, clear_markers: bool = True) -> DataFrame:
        """The current profile's values."""
        stored = self.store.read()
        return stored if self.precedence == "batch" else register_values(stored, self.policy, clear_markers)

    def poll(self, raw: DataFrame | str) -> bool:
        """One loop turn of the reference's unify-merge mode; True if work was done.

        Every row above the previous mark is seen, wherever it lies: the mark is the whole table's, and the slice's bounds are
        pushed into the scan, so row groups of merged rows are skipped by their statistics. Given the raw table's path, the mark
        comes from the Parquet footers (``footer_mark``) and an idle poll reads no data. A slice with no more rows than
        ``hot_key_rows`` cannot hold a hot key, so it skips the hot-key scan.
        """
        if isinstance(raw, str):
            mark, raw = footer_mark(self.spark, raw, self.col), self.spark.read.parquet(raw)
        else:
            mark = high_water(raw, self.col)
        if mark is None or (self.prev is not None and mark <= self.prev):
            return False
        part = slice_range(raw, self.col, self.prev, mark)
        method = self.unify_method
        if method == "auto" and part.count() <= self.hot_key_rows:
            method = "window"
        done = self.run_slice(part, self.next_batch, self.prev, mark, method=method)
        if done["skipped"]:
            # the mark must never pass rows that were not merged
            raise RuntimeError(f"batch {self.next_batch} of {self.store.root} was published by someone else; open the job again")
        self.prev = mark
        self.next_batch += 1
        return True

    def run_slice(self, slice_df: DataFrame, batch_id: int, lo: Any = None, hi: Any = None,
                  method: str | None = None, trigger: int | None = None) -> dict:
        """Unify one slice (or stream micro-batch) and merge it; skips a batch already published.

        ``trigger``: the stream's micro-batch in which the slice was applied, kept with the version."""
        if self.store.applied(batch_id):
            return {"skipped": True}
        with self.log.step("cycle", batch_id, lo, hi):
            with self.log.step("unify", batch_id, lo, hi) as rec:
                collapse = unify if self.precedence == "batch" else unify_registers
                unified = collapse(slice_df, self.policy, method=method or self.unify_method, hot_key_rows=self.hot_key_rows)
                obs = Observation(f"unify_{batch_id}_{id(self)}")
                sized = unified.select(*self.policy.profile_columns())
                # measured on this write: the batch size (merge strategy) and, for a
                # touched-bucket store, the buckets the batch touches (<= N ids)
                metrics = size_exprs(sized.schema)
                if self.store.touched_only:
                    metrics.append(F.collect_set(self.store.bucket_of()).alias("buckets"))
                unified.observe(obs, *metrics).write.mode("overwrite").parquet(self.staging)
                rec["rows"] = int(obs.get["n"])
                size = to_batch_size(sized.schema, obs.get["n"], obs.get["v"])
                touched = obs.get.get("buckets")
            staged = self.spark.read.parquet(self.staging)
            if self.store.schema is None:
                self.store.schema = staged.select(*self.policy.profile_columns()).schema
            with self.log.step("merge", batch_id, lo, hi) as rec:
                stored = self.store.read_for(staged, touched)
                if self.precedence == "event_time":
                    tagged = merge_registers_tagged(stored, staged, self.policy)
                else:
                    tagged = merge_tagged(stored, staged, self.policy, strategy=self.strategy, known_size=size, unique_batch=True)
                s = F.col(STATE)
                obs = Observation(f"merge_{batch_id}_{id(self)}")
                counted = tagged.observe(
                    obs,
                    F.count(F.when(s == UPDATED, 1)).alias("updated"),
                    F.count(F.when(s == INSERTED, 1)).alias("inserted"),
                    F.count(F.when(s == UNTOUCHED, 1)).alias("untouched"),
                )
                self.store.publish(counted.drop(STATE), batch_id, mark=hi, empty=size.rows == 0, trigger=trigger)
                m = obs.get
                rec["rows"] = int(m["updated"]) + int(m["inserted"])
                rec["counts"] = {k: int(v) for k, v in m.items()}
            reset_staging(self.spark, self.staging, staged.schema)
        return {"skipped": False, **m}


@dataclass
class AppendJob:
    """The reference's select-insert mode: append ``(prev, mark]`` of the feed to staging, unchanged.

    Each slice has a folder of its own (``slice=<n>``) and, once written, a small record
    with its mark. A slice without a record was cut off: it is written again, over what is there, and
    ``read`` leaves it out. A new process goes on from the newest record.

    With ``overlap`` (an interval for a timestamp, a number for a number) every poll looks back behind the mark by
    that much and takes the rows that no earlier slice took, known by ``row_key``; it also does so when the mark has
    not moved. Rows that come later than that are lost, as without it (``late_rows`` reports them).
    """
    spark: SparkSession
    staging: str
    columns: list[str]
    col: str = "epoch_ts"
    prev: Any = None
    log: StepLog = field(default_factory=StepLog)
    next_batch: int = 0
    overlap: Any = None
    row_key: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.overlap is not None and not (self.row_key and {*self.row_key, self.col} <= {*self.columns}):
            raise ValueError("overlap needs row_key, and staging must hold it and the mark's column")
        done = [int(n.removesuffix(".json")) for n in list_names(self.spark, self._marks) if n.endswith(".json") and not n.startswith(".")]
        if done and self.prev is None:
            last = max(done)
            record = json.loads(read_text(self.spark, f"{self._marks}/{last}.json"))
            self.prev = decode_mark(record["mark"])
            self.next_batch = last + 1

    @property
    def _marks(self) -> str:
        return f"{self.staging}/_marks"

    def _new_rows(self, raw: DataFrame, mark: Any) -> DataFrame | None:
        moved = mark is not None and (self.prev is None or mark > self.prev)
        if self.overlap is None:
            return slice_range(raw, self.col, self.prev, mark) if moved else None
        if mark is None:
            return None
        taken = self.read() if self.next_batch else None
        found = look_back(raw, self.col, self.prev, mark if moved else self.prev, self.overlap, taken, self.row_key)
        return found if moved or not found.isEmpty() else None

    def poll(self, raw: DataFrame) -> bool:
        mark = high_water(raw, self.col)
        part = self._new_rows(raw, mark)
        if part is None:
            return False
        mark = mark if self.prev is None else max(mark, self.prev)
        with self.log.step("append", self.next_batch, self.prev, mark) as rec:
            obs = Observation(f"append_{self.next_batch}_{id(self)}")
            (part.select(*self.columns).observe(obs, F.count(F.lit(1)).alias("rows"))
                 .write.mode("overwrite").parquet(f"{self.staging}/slice={self.next_batch}"))
            if not create_text(self.spark, f"{self._marks}/{self.next_batch}.json", json.dumps({"mark": encode_mark(mark)})):
                raise RuntimeError(f"slice {self.next_batch} of {self.staging} was appended by another writer")
            rec["rows"] = int(obs.get["rows"])
        self.prev = mark
        self.next_batch += 1
        return True

    def read(self) -> DataFrame:
        """The appended rows of every finished slice."""
        return self.spark.read.parquet(self.staging).where(F.col("slice") < self.next_batch).drop("slice")


def run_loop(job: "UnifyMergeJob | AppendJob", read_raw, *, interval: float = 1.0,
             max_idle_polls: int | None = None, max_steps: int | None = None) -> int:
    """The reference's polling loop: work when the mark moved, else sleep ``interval``.

    ``read_raw`` returns the current raw table (re-listed on every call). Stops
    after ``max_idle_polls`` polls in a row found nothing new, or after
    ``max_steps`` steps; with neither it runs until interrupted (for a managed
    service prefer the stream, whose checkpoint also survives restarts).
    Returns the number of steps run.
    """
    import time as _time

    steps = idle = 0
    while max_steps is None or steps < max_steps:
        if job.poll(read_raw()):
            steps, idle = steps + 1, 0
            continue
        idle += 1
        if max_idle_polls is not None and idle >= max_idle_polls:
            break
        _time.sleep(interval)
    return steps
