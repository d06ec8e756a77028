"""Profile feeds derived from the driver's tables.

The driver's tables hold no NULLs and no clear markers, so each feed injects
them by arithmetic on the row id. Every feed is a plain projection of a whole
table: its size grows with the table, and Catalyst prunes the scan to the
columns a query needs. The SQL twins used by the DuckDB oracle live in
``oracle_sql.py`` and must stay in step with these definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchprofile.policy import DROP, INSERT_ONLY, NEWEST, NOT_MERGED, OLDEST, ROW, ColumnPolicy

MARKER_INT = -11111
WIDE_COLUMNS = 190

# The feed policy: key (uid, utype), newest first by createddate, ties by epoch.
FEED_POLICY = ColumnPolicy(
    keys=("uid", "utype"),
    order_by="createddate",
    tie_break=("epoch",),
    unify_rules={
        "cid": ROW,
        "att1": NEWEST,
        "att2": NEWEST,
        "att3": NEWEST,
        "ad": OLDEST,
        "createddate": ROW,
    },
    merge_rules={"ad": INSERT_ONLY, "createddate": NOT_MERGED},
)

# The raw feed columns, in load order (staging copies them unchanged).
FEED_COLUMNS = ["uid", "utype", "epoch", "createddate", "epoch_ts", "cid", "att1", "att2", "att3", "ad"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores (a small
    file with a single row group), so a heavy projection above it runs in
    parallel. Large tables scan in many splits and pass through unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _nullif(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _delay(seconds: Column) -> Column:
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def profile_feed(spark: SparkSession, sf_dir: str, marker_key: bool = False, skewed: bool = False) -> DataFrame:
    """events -> profile feed: key (uid, utype), order createddate, epoch = event_id.

    With ``marker_key`` the 'error' events carry the clear marker as their
    utype, to exercise a key that equals the marker. With ``skewed`` every
    third event belongs to user 0: one key holds a third of all rows.
    """
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    utype = F.when(F.col("event_type").isin("click", "view"), F.lit("web")).otherwise(F.lit("app"))
    if marker_key:
        utype = F.when(F.col("event_type") == "error", F.lit(str(MARKER_INT))).otherwise(utype)
    uid = F.when(i % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id")) if skewed else F.col("user_id")
    return e.select(
        uid.alias("uid"),
        utype.alias("utype"),
        i.alias("epoch"),
        F.col("ts").alias("createddate"),
        (F.col("ts") + _delay((i % 17) * 97)).alias("epoch_ts"),
        _nullif(i % 6 == 0, F.concat(F.lit("c"), i.cast("string"))).alias("cid"),
        F.when(i % 3 == 0, F.lit(None)).when(i % 7 == 0, F.lit(str(MARKER_INT)))
         .otherwise(F.col("event_type")).alias("att1"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 11 == 0, F.lit(float(MARKER_INT)))
         .otherwise(F.col("value")).alias("att2"),
        F.when(i % 2 == 0, F.lit(None)).when(i % 13 == 0, F.lit(MARKER_INT).cast("long"))
         .otherwise(i % 1000).alias("att3"),
        _nullif(i % 4 == 0, F.col("ts")).alias("ad"),
    )


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> feed with out-of-order dates and repeated (key, date) pairs."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("uid"),
        F.col("o_orderstatus").alias("utype"),
        k.alias("epoch"),
        F.col("o_orderdate").alias("createddate"),
        (F.col("o_orderdate") + _delay((k % 23) * 3601)).alias("epoch_ts"),
        F.concat(F.lit("o"), k.cast("string")).alias("cid"),
        _nullif(k % 4 == 0, F.col("o_orderpriority")).alias("att1"),
        F.when(k % 9 == 0, F.lit(float(MARKER_INT))).otherwise(F.col("o_totalprice")).alias("att2"),
        _nullif(k % 2 == 0, k).alias("att3"),
        _nullif(k % 5 == 0, F.col("o_orderdate")).alias("ad"),
    )


WIDE_VARIANTS = 7


def wide_feed(spark: SparkSession, sf_dir: str, n: int = WIDE_COLUMNS) -> DataFrame:
    """events -> ``n`` text attributes, a third of them NULL, for wide unification.

    Column ``att<j>`` is NULL when ``(event_id + j) % 3 = 0``, otherwise one of
    seven per-row texts ``event_type || '_' || (event_id % (k + 7))`` with
    ``k = j % 7``; the NULL patterns differ by column, so each column's newest
    non-null value comes from a different row.
    """
    e = spread(table(spark, sf_dir, "events"))
    texts = [f"concat(event_type, '_', CAST(event_id % {k + 7} AS STRING)) AS _v{k}" for k in range(WIDE_VARIANTS)]
    base = e.selectExpr(
        "user_id AS uid",
        "CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END AS utype",
        "event_id AS epoch",
        "ts AS createddate",
        "CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('c', CAST(event_id AS STRING)) END AS cid",
        *texts,
    )
    atts = [f"CASE WHEN (epoch + {j}) % 3 = 0 THEN NULL ELSE _v{j % WIDE_VARIANTS} END AS att{j}"
            for j in range(n)]
    return base.selectExpr("uid", "utype", "epoch", "createddate", "cid", *atts)


def wide_policy(n: int = WIDE_COLUMNS) -> ColumnPolicy:
    rules = {"cid": ROW}
    rules.update({f"att{j}": NEWEST for j in range(n)})
    rules["createddate"] = ROW
    return ColumnPolicy(keys=("uid", "utype"), order_by="createddate", tie_break=("epoch",),
                        unify_rules=rules, merge_rules={"createddate": NOT_MERGED})


LOADED_ATTRIBUTES, DROPPED_COLUMNS = 189, 16


def wide_load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide feed as it is loaded: 209 columns (keys, time, id, 189 attributes, 16 that are never unified) and ``epoch``.

    Every tenth attribute of every 29th row is the clear marker.
    """
    feed = wide_feed(spark, sf_dir, LOADED_ATTRIBUTES)
    atts = [f"CASE WHEN epoch % 29 = 0 THEN '{MARKER_INT}' ELSE att{j} END AS att{j}" if j % 10 == 0 else f"att{j}" for j in range(LOADED_ATTRIBUTES)]
    extra = [f"CAST(epoch % {j + 3} AS STRING) AS extra{j}" for j in range(DROPPED_COLUMNS)]
    return feed.selectExpr("uid", "utype", "createddate", "cid", *atts, *extra, "epoch")


def wide_load_policy() -> ColumnPolicy:
    """191 merged columns beside the keys: the last two attributes keep their oldest value and are insert-only."""
    names = [f"att{j}" for j in range(LOADED_ATTRIBUTES)]
    rules = {"cid": ROW} | {c: NEWEST for c in names[:-2]} | {c: OLDEST for c in names[-2:]} | {"createddate": ROW}
    rules |= {f"extra{j}": DROP for j in range(DROPPED_COLUMNS)}
    return ColumnPolicy(keys=("uid", "utype"), order_by="createddate", tie_break=("epoch",),
                        unify_rules=rules, merge_rules={c: INSERT_ONLY for c in names[-2:]})


__all__ = ["FEED_POLICY", "FEED_COLUMNS", "profile_feed", "orders_feed",
           "wide_feed", "wide_policy", "wide_load_feed", "wide_load_policy", "table", "spread"]
