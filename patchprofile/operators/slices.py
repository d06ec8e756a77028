"""Incremental slices of an append-only feed and their high-water marks.

A slice is the half-open range ``(lo, hi]`` of a commit column (integer
``epoch``) or an ingest-time column (timestamp ``epoch_ts``). Bounds are
passed as typed literals, so the range reaches the Parquet scan as pushed
filters, and row groups outside it are skipped by their statistics.
"""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def high_water(df: DataFrame, col: str) -> Any:
    """``MAX(col)`` as a Python value; None for an empty table (no work).

    Unlike the reference, an empty table is not mapped to a zero mark, so a
    later read can never send the slice back to the beginning; errors raise.
    """
    return df.agg(F.max(col).alias("m")).first()["m"]


def high_water_df(df: DataFrame, col: str, default: Any = None, name: str = "high_water") -> DataFrame:
    """The mark as a one-row DataFrame (lazy; ``default`` replaces NULL)."""
    m = F.max(col)
    if default is not None:
        m = F.coalesce(m, F.lit(default))
    return df.agg(m.alias(name))


def in_slice(col: str | Column, lo: Any, hi: Any) -> Column:
    """``lo < col <= hi``; ``lo=None`` means no lower bound (the first slice)."""
    c = F.col(col) if isinstance(col, str) else col
    cond = c <= F.lit(hi)
    if lo is not None:
        cond = (c > F.lit(lo)) & cond
    return cond


def slice_range(df: DataFrame, col: str, lo: Any, hi: Any) -> DataFrame:
    return df.filter(in_slice(col, lo, hi))


def look_back(df: DataFrame, col: str, prev: Any, hi: Any, overlap: Any, taken: DataFrame | None, key: list[str]) -> DataFrame:
    """The rows of ``(prev - overlap, hi]`` that were not taken before.

    A row that arrives behind the mark ``prev`` by less than ``overlap`` is still picked up. ``taken`` holds what earlier
    slices took; it is read from ``prev - overlap`` on only, and its rows are known by ``key`` (unique, nulls
    equal). With ``prev`` None (the first slice) or ``taken`` None nothing is left out.
    """
    lo = None if prev is None else prev - overlap
    window = slice_range(df, col, lo, hi)
    if prev is None or taken is None:
        return window
    seen = taken.filter(F.col(col) > F.lit(lo)).select(*(F.col(k).alias(f"_seen_{k}") for k in key))
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in key]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return window.join(seen, on, "left_anti")


def footer_mark(spark: SparkSession, path: str, col: str) -> Any:
    """``MAX(col)`` of a Parquet table from the statistics in its footers; no data page is read.

    The aggregate is pushed into the scan in a session of its own, so the caller's settings stay as they are. Types whose
    statistics do not say the maximum (timestamps, text) are read by Spark as usual. None for an empty table.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return high_water(own.read.parquet(path), col)


def split_bounds(lo: Any, hi: Any, n: int) -> list[Any]:
    """``n`` consecutive slices covering ``(lo, hi]`` with integer arithmetic.

    Works for integers and for timestamps (split on whole microseconds).
    """
    if isinstance(hi, dt.datetime):
        span = hi - lo
        micros = span // dt.timedelta(microseconds=1)
        return [lo] + [lo + dt.timedelta(microseconds=micros * i // n) for i in range(1, n)] + [hi]
    return [lo] + [lo + (hi - lo) * i // n for i in range(1, n)] + [hi]


def labelled_slices(df: DataFrame, col: str, bounds: list[Any], label: str = "slice_no") -> DataFrame:
    """Every row of ``(bounds[0], bounds[-1]]`` tagged with its slice number (1-based).

    One scan with the whole range pushed down; the number is an expression.
    """
    return slice_range(df, col, bounds[0], bounds[-1]).withColumn(label, slice_number(col, bounds))


def slice_number(col: str, bounds: list[Any]) -> Column:
    """1-based number of the slice ``(bounds[i], bounds[i+1]]`` holding ``col``; NULL outside."""
    c = F.col(col)
    expr = None
    for i in range(1, len(bounds)):
        cond = c <= F.lit(bounds[i])
        if i == 1 and bounds[0] is not None:
            cond = (c > F.lit(bounds[0])) & cond
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def late_rows(df: DataFrame, arrival: Column, ts_col: str) -> DataFrame:
    """Rows an ingest-time slicer never picks up.

    ``arrival`` numbers the loads in commit order. After load ``a`` the slicer's
    mark is ``max(ts_col)`` of loads ``<= a``; a row of load ``a`` whose
    ``ts_col`` is not above the mark left by loads ``< a`` falls behind the
    mark and is never appended. The per-load marks are one row per load (a
    partial aggregate shrinks every map task to that before the shuffle), so
    the running maximum over them is bounded by the number of loads, not by
    the data. No broadcast is forced: AQE broadcasts the marks after measuring
    them, or joins them by shuffle if there are very many loads.
    """
    tagged = df.withColumn("arrival_no", arrival)
    marks = tagged.groupBy("arrival_no").agg(F.max(ts_col).alias("_mark"))
    before = Window.orderBy("arrival_no").rowsBetween(Window.unboundedPreceding, -1)
    prev = marks.select("arrival_no", F.max("_mark").over(before).alias("mark_at_arrival"))
    return tagged.join(prev, "arrival_no").filter(F.col(ts_col) <= F.col("mark_at_arrival"))
