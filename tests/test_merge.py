import datetime as dt

import pytest

from conftest import rows
from patchprofile.operators.merge import STATE, batch_size, merge, merge_counts, merge_tagged
from patchprofile.policy import INSERT_ONLY, NEWEST, OLDEST, ColumnPolicy

POLICY = ColumnPolicy(keys=("k",), order_by="d", unify_rules={"s": NEWEST, "x": NEWEST, "n": NEWEST, "ad": OLDEST},
                      merge_rules={"ad": INSERT_ONLY})
SCHEMA = "k string, s string, x double, n long, ad timestamp_ntz"
T = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2025, 1, 1)


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_patch_rules(spark, strategy):
    target = _df(spark, [
        ("keep", "s0", 1.0, 10, T),
        ("upd", "s0", 1.0, 10, T),
        ("clr", "s0", 1.0, 10, T),
        ("untouched", "u", 2.0, 20, T),
    ])
    batch = _df(spark, [
        ("keep", None, None, None, T2),          # NULL keeps the stored value; ad is insert-only
        ("upd", "s1", 3.0, 30, T2),
        ("clr", "-11111", -11111.0, -11111, T2),  # marker clears text, double and integer columns
        ("new", "-11111", 5.0, None, T2),        # insert stores the marker as is
        (None, "nk", None, None, None),          # NULL key never matches: inserted
    ])
    out = merge(target, batch, POLICY, strategy=strategy)
    assert rows(out) == rows(_df(spark, [
        ("keep", "s0", 1.0, 10, T),
        ("upd", "s1", 3.0, 30, T),
        ("clr", None, None, None, T),
        ("untouched", "u", 2.0, 20, T),
        ("new", "-11111", 5.0, None, T2),
        (None, "nk", None, None, None),
    ]))


def test_clear_on_insert_and_counts(spark):
    target = _df(spark, [("a", "s", 1.0, 1, T)])
    batch = _df(spark, [("a", "t", None, None, None), ("b", "-11111", None, None, None)])
    tagged = merge_tagged(target, batch, POLICY, clear_on_insert=True, strategy="shuffle")
    got = {r["k"]: r["s"] for r in tagged.collect()}
    assert got == {"a": "t", "b": None}
    c = merge_counts(tagged).first().asDict()
    assert c == {"rows_updated": 1, "rows_inserted": 1, "rows_affected": 2, "rows_untouched": 0, "rows_total": 2}


def test_replayed_batch_with_marker_is_visible(spark):
    """Merging the same batch twice differs from once when a new key carries the marker."""
    empty = spark.createDataFrame([], SCHEMA)
    batch = _df(spark, [("n", "-11111", None, None, None)])
    once = merge(empty, batch, POLICY, strategy="shuffle")
    twice = merge(once, batch, POLICY, strategy="shuffle")
    assert once.first()["s"] == "-11111" and twice.first()["s"] is None


def test_marker_keys_optional(spark):
    pol = ColumnPolicy(keys=("k",), order_by="d", unify_rules={"s": NEWEST})
    t = spark.createDataFrame([("-11111", "a")], "k string, s string")
    b = spark.createDataFrame([("-11111", "b")], "k string, s string")
    assert merge(t, b, pol, strategy="shuffle").first()["k"] == "-11111"
    assert merge(t, b, pol, strategy="shuffle", null_marker_keys=True).first()["k"] is None


def test_auto_strategy_uses_measured_size(spark):
    target = _df(spark, [("a", "s", 1.0, 1, T)])
    batch = _df(spark, [("a", "xyz", None, None, None)])
    size = batch_size(batch)
    assert size.rows == 1 and size.bytes >= 16 + 8 * 5 + 4
    small = merge(target, batch, POLICY, strategy="auto")
    big = merge(target, batch, POLICY, strategy="auto", max_broadcast_bytes=1)
    assert rows(small) == rows(big)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert STATE not in small.columns


def test_merging_twice_equals_once_without_new_key_markers(spark):
    target = _df(spark, [("a", "s", 1.0, 1, T)])
    batch = _df(spark, [("a", "-11111", 2.0, None, T2), ("b", "t", None, 5, T2)])
    once = merge(target, batch, POLICY, strategy="shuffle")
    twice = merge(once, batch, POLICY, strategy="shuffle")
    assert rows(once) == rows(twice)


def test_marker_needs_a_type_that_holds_it(spark):
    from pyspark.sql import types as T

    from patchprofile.functions.markers import is_marker, marker_sql
    row = spark.sql("SELECT CAST(1 AS TINYINT) a, CAST(1 AS DECIMAL(4,2)) b, 5 c, CAST(-11111 AS DECIMAL(9,2)) d, -11111L e")
    types = {f.name: f.dataType for f in row.schema.fields}
    from pyspark.sql import functions as F
    got = row.select(*[is_marker(F.col(c), t, "-11111").alias(c) for c, t in types.items()]).first()
    assert tuple(got) == (False, False, False, True, True)
    text = row.selectExpr(*[marker_sql(c, t, "-11111") + f" AS {c}" for c, t in types.items()]).first()
    assert tuple(text) == tuple(got)
    assert marker_sql("c", T.IntegerType(), "CLEAR") == "false"


def test_broadcast_limit_honours_the_session(spark):
    from patchprofile.operators.merge import DEFAULT_BROADCAST_BYTES, broadcast_limit
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for conf, want in (("-1", -1), ("10MB", DEFAULT_BROADCAST_BYTES), ("1g", 1 << 30)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
            assert broadcast_limit(spark) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_unify_needs_a_tie_break(spark):
    import pytest

    from patchprofile.operators.unify import top1_per_key, unify
    df = spark.createDataFrame([(1, 1, "a")], "k int, d int, s string")
    policy = ColumnPolicy(keys=("k",), order_by="d", unify_rules={"s": NEWEST})
    for method in ("auto", "window", "aggregate"):
        with pytest.raises(ValueError):
            unify(df, policy, method=method)
    with pytest.raises(ValueError):
        top1_per_key(df, policy)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_two_batch_rows_of_one_key_raise(spark, strategy):
    target = _df(spark, [("a", "s", 1.0, 1, T)])
    batch = _df(spark, [("a", "x", 1.0, 1, T), ("a", "y", 1.0, 1, T)])
    with pytest.raises(Exception, match="two rows of one key"):
        merge(target, batch, POLICY, strategy=strategy).collect()
    nulls = _df(spark, [(None, "x", 1.0, 1, T), (None, "y", 1.0, 1, T)])
    assert merge(target, nulls, POLICY, strategy=strategy).count() == 3


def test_upsert_query_reads_staged_sides_only(spark, sf_small):
    from patchprofile import queries as Q
    plan = Q.merge_upsert(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    assert plan.count("Relation") <= 5  # the profile and its found-key scan; the small batch for each join
