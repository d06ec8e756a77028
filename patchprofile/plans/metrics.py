"""Step metrics: one record per append / unify / merge / cycle, and their summary."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.sources.fs import put_text

METRICS_SCHEMA = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("lo", T.StringType()),
    T.StructField("hi", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("started_at", T.DoubleType()),
    T.StructField("ended_at", T.DoubleType()),
    T.StructField("elapsed_ns", T.LongType()),
    T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
])


@dataclass
class StepLog:
    """Step records (a handful per batch, never data rows).

    With ``path`` every record is also written when its step ends, as one small JSON object in the folder of its batch, so a
    process that dies leaves the steps it finished; a step run again replaces its record. ``clock`` gives seconds.
    """
    records: list[tuple] = field(default_factory=list)
    path: str | None = None
    spark: SparkSession | None = None
    clock: Callable[[], float] = time.time

    @contextmanager
    def step(self, name: str, batch_id: int, lo=None, hi=None):
        rec = {"rows": None, "counts": None}
        t0 = self.clock()
        try:
            yield rec
        finally:
            t1 = self.clock()
            self.add((name, int(batch_id), None if lo is None else str(lo), None if hi is None else str(hi), rec["rows"], t0, t1, round((t1 - t0) * 1e9), rec["counts"]))

    def add(self, record: tuple) -> None:
        self.records.append(record)
        if self.path is not None:
            put_text(self.spark, f"{self.path}/batch={record[1]}/{record[0]}.json", json.dumps(dict(zip(METRICS_SCHEMA.fieldNames(), record))))

    def to_df(self, spark: SparkSession) -> DataFrame:
        width = len(METRICS_SCHEMA.fields)
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in self.records], METRICS_SCHEMA)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The step records under ``path``: every process's finished steps."""
    return spark.read.schema(METRICS_SCHEMA).json(f"{path}/batch=*")


def busy_ns(metrics: DataFrame) -> DataFrame:
    """``step, busy_ns``: the time in which at least one run of a step was going on.

    Runs overlap and leave gaps, so neither the sum of durations nor ``max(end) - min(start)`` is the time spent: intervals that
    touch are one island, and the islands' lengths are added up. Records without a start or end are left out.
    """
    spans = metrics.where("started_at IS NOT NULL AND ended_at IS NOT NULL AND ended_at >= started_at")
    order = Window.partitionBy("step").orderBy("started_at", "ended_at")
    reach = F.max("ended_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("started_at") <= reach, 0).otherwise(1)
    islands = spans.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    each = islands.groupBy("step", "_island").agg((F.max("ended_at") - F.min("started_at")).alias("s"))
    return each.groupBy("step").agg(F.round(F.sum("s") * F.lit(1e9)).cast("long").alias("busy_ns"))


def summarize(metrics: DataFrame, wall_clock_steps: tuple[str, ...] = ()) -> DataFrame:
    """Per step: count, min, max, total and average duration (integer division).

    The total is the sum of durations, except for steps named in ``wall_clock_steps`` (runs side by side), where it is the
    time in which any of them was going on (``busy_ns``).
    """
    out = metrics.groupBy("step").agg(
        F.count("elapsed_ns").alias("runs"),
        F.min("elapsed_ns").alias("min_ns"),
        F.max("elapsed_ns").alias("max_ns"),
        F.sum("elapsed_ns").alias("total_ns"),
        F.expr("sum(elapsed_ns) div count(elapsed_ns)").alias("avg_ns"),
        F.sum("rows").alias("rows"),
    )
    if not wall_clock_steps:
        return out
    side = F.col("step").isin(*wall_clock_steps)
    busy = busy_ns(metrics.where(side))
    total = F.when(side, F.coalesce("busy_ns", F.lit(0))).otherwise(F.col("total_ns"))
    return out.join(busy, "step", "left").withColumn("total_ns", total).drop("busy_ns")
