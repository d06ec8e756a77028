"""Unify: collapse a slice of the feed to one row per key.

Per key, with the event order ``order_by DESC`` (nulls first) and a unique
tie-break:

* ``newest`` columns take the first non-null value (FIRST_VALUE IGNORE NULLS),
* ``oldest`` columns take the last non-null value (LAST_VALUE IGNORE NULLS),
* ``row`` columns take the values of the first row, nulls included.

Two physical forms give the same rows:

``aggregate``
    ``max_by``/``min_by`` over one event-order struct. Spark runs a partial
    (map-side) aggregate before the shuffle, so a key holding a third of all
    rows is reduced inside every map task and reaches its reducer as one row
    per map task. String buffers force sort-based aggregation, which costs
    about twice the window form per row on wide feeds.
``window``
    the reference's shape: one shared window, full frame, top-1 filter. Fast,
    but every row of a key goes to one task.

``auto`` (default) splits the feed by key size. A frequent-items sketch over a hash of the
key columns finds the keys with more than ``hot_key_rows`` rows: one scan of these columns, of
which only sketches of a fixed size leave a task; no key is shuffled. The rows of those (at
most ``max_hot_keys`` hashes, as literals of a filter) go through
the aggregate form, all other keys through the window form, and the two
results are concatenated. With no hot key it is the window form alone; with
more hot keys than the bound it is the aggregate form alone. Whichever way a key goes, its result is the same,
so neither a hash that two keys share nor the sketch's error can change a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchprofile.functions.ordering import event_order_desc, event_order_sql, order_sql, q
from patchprofile.policy import NEWEST, OLDEST, ROW, ColumnPolicy

_ROW = "__row"
_RN = "__rn"


HOT_KEY_ROWS = 500_000
MAX_HOT_KEYS = 10_000
#: Hashes a sketch keeps count of. Counts are low by at most about 4/3 of the rows over this number; up to three quarters of it they are exact.
TRACKED = 100_000
#: Sketches are brought together in two steps: first this many groups of tasks, then one.
GROUPS = 64


def unify(feed: DataFrame, policy: ColumnPolicy, method: str = "auto", *,
          hot_key_rows: int = HOT_KEY_ROWS, max_hot_keys: int = MAX_HOT_KEYS, hot_share: float | None = None) -> DataFrame:
    """One row per key. ``hot_share``: with ``auto``, a key is hot from this share of all rows on, instead of from ``hot_key_rows``."""
    policy.check_order()  # all forms agree only on a total order
    if method == "auto":
        return _unify_split(feed, policy, hot_key_rows, max_hot_keys, hot_share)
    if method == "aggregate":
        return _unify_aggregate(feed, policy)
    if method == "window":
        return _unify_window(feed, policy)
    raise ValueError(f"unknown unify method {method!r}")


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*(F.col(k) for k in keys))


def key_sketch(feed: DataFrame, keys: list[str]) -> DataFrame:
    """``sketch, rows``: frequent key hashes of a feed, a few rows; sketches of several loads can be united and kept with them."""
    hashed = feed.select(key_hash(keys).alias("h"))
    return (hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
            .agg(F.expr(f"approx_top_k_accumulate(h, {TRACKED})").alias("sketch"), F.count(F.lit(1)).alias("rows")).drop("g"))


def hot_hashes(sketches: DataFrame, hot_key_rows: int, max_hot_keys: int, hot_share: float | None = None) -> list[int] | None:
    """Hashes of keys with more than ``hot_key_rows`` rows (or ``hot_share`` of all); None when there are more than ``max_hot_keys``."""
    k = min(max_hot_keys + 1, TRACKED)
    # grouped, so that no sketches give no row
    united = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("rows").alias("rows"))
    row = united.select(F.expr(f"approx_top_k_estimate(sketch, {k})").alias("top"), "rows").first()
    if row is None:
        return []
    least = hot_key_rows if hot_share is None else hot_share * row["rows"]
    # the limit bounds what reaches the driver; it never drops data: past it the caller unifies every key with the aggregate form
    hot = [r["item"] for r in row["top"] if r["count"] > least]
    return None if len(hot) > max_hot_keys else hot


def _unify_split(feed: DataFrame, policy: ColumnPolicy, hot_key_rows: int, max_hot_keys: int, hot_share: float | None) -> DataFrame:
    keys = list(policy.keys)
    hot = hot_hashes(key_sketch(feed, keys), hot_key_rows, max_hot_keys, hot_share)
    if hot is None:
        return _unify_aggregate(feed, policy)
    if not hot:
        return _unify_window(feed, policy)
    is_hot = key_hash(keys).isin(hot)
    return _unify_window(feed.where(~is_hot), policy).unionByName(_unify_aggregate(feed.where(is_hot), policy))


# Wide policies (the reference unifies 190 columns) are built as SQL expression
# text: one call per column instead of a dozen Column-API calls through the
# JVM gateway; the plans are the same.

def _unify_aggregate(feed: DataFrame, policy: ColumnPolicy) -> DataFrame:
    order = event_order_sql(policy)
    row_cols = policy.columns_with(ROW)
    aggs = []
    if row_cols:
        fields = ", ".join(f"'{c}', {q(c)}" for c in row_cols)
        aggs.append(F.expr(f"max_by(named_struct({fields}), {order})").alias(_ROW))
    for c, rule in policy.unify_rules.items():
        present = f"CASE WHEN {q(c)} IS NOT NULL THEN {order} END"  # NULL ordering -> row skipped
        if rule == NEWEST:
            aggs.append(F.expr(f"max_by({q(c)}, {present})").alias(c))
        elif rule == OLDEST:
            aggs.append(F.expr(f"min_by({q(c)}, {present})").alias(c))
    grouped = feed.groupBy(*policy.keys).agg(*aggs)
    out = [f"{_ROW}.{q(c)} AS {q(c)}" if c in row_cols else q(c) for c in policy.unified_columns()]
    return grouped.selectExpr(*out)


def _unify_window(feed: DataFrame, policy: ColumnPolicy) -> DataFrame:
    spec = f"PARTITION BY {', '.join(q(k) for k in policy.keys)} ORDER BY {order_sql(policy)}"
    # The whole partition as a RANGE frame (same rows as the ROWS frame). With a
    # ROWS frame Catalyst turns every first() into its own nth_value frame, one
    # generated class per column; as aggregates over one frame all columns share
    # a single aggregate processor.
    full = f"({spec} RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    exprs = []
    for c in policy.unified_columns():
        rule = policy.unify_rules.get(c)
        if rule == NEWEST:
            exprs.append(f"first({q(c)}, true) OVER {full} AS {q(c)}")
        elif rule == OLDEST:
            exprs.append(f"last({q(c)}, true) OVER {full} AS {q(c)}")
        else:  # keys and row columns come from the top row itself
            exprs.append(q(c))
    exprs.append(f"row_number() OVER ({spec}) AS {_RN}")
    return feed.selectExpr(*exprs).filter(F.col(_RN) == 1).drop(_RN)


def top1_per_key(feed: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """The newest row of every key, nulls included (LIMIT 1 OVER (PARTITION BY keys ...)).

    ``row_number() == 1`` lets Spark place a partial group limit before the
    shuffle, so each map task forwards at most one row per key.
    """
    policy.check_order()
    w = Window.partitionBy(*policy.keys).orderBy(*event_order_desc(policy))
    return feed.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
