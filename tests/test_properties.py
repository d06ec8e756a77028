"""Randomized checks against a brute-force model of the reference's statements.

The model applies the SQL semantics row by row in plain Python: per key, order
rows by (createddate DESC NULLS FIRST, epoch DESC), take the first non-null
value (newest), the last non-null value (oldest), the first row (row rule);
merge patches matched keys and inserts new ones as they are.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from patchprofile.operators.merge import merge
from patchprofile.operators.unify import unify
from patchprofile.policy import INSERT_ONLY, NEWEST, NOT_MERGED, OLDEST, ROW, ColumnPolicy

POLICY = ColumnPolicy(keys=("k",), order_by="d", tie_break=("e",),
                      unify_rules={"c": ROW, "a": NEWEST, "x": NEWEST, "b": OLDEST, "d": ROW},
                      merge_rules={"b": INSERT_ONLY, "d": NOT_MERGED})
SCHEMA = "k string, d timestamp_ntz, e long, c string, a string, x double, b string"
MARK = "-11111"

_day = st.one_of(st.none(), st.integers(0, 3).map(lambda i: dt.datetime(2024, 1, 1 + i)))
_text = st.sampled_from([None, None, "p", "q", MARK])
_num = st.sampled_from([None, 1.5, -11111.0, 2.0])
_row = st.tuples(st.sampled_from(["k1", "k2", "k3", None]), _day, _text, _text, _num, _text)


def _feed(draw_rows):
    # unique, shuffled commit numbers as the tie-break
    return [(k, d, i * 7 % 101, c, a, x, b) for i, (k, d, c, a, x, b) in enumerate(draw_rows)]


def _order_key(r):
    d, e = r[1], r[2]
    return (0 if d is None else 1, -(d.timestamp() if d else 0), -e)


def model_unify(feed):
    out = {}
    for key in {r[0] for r in feed}:
        g = sorted([r for r in feed if r[0] == key], key=_order_key)
        newest = lambda i: next((r[i] for r in g if r[i] is not None), None)
        oldest = next((r[6] for r in reversed(g) if r[6] is not None), None)
        out[key] = (key, g[0][1], g[0][3], newest(4), newest(5), oldest)
    return out


def _is_marker(v):
    return v == MARK or v == -11111.0


def model_merge(target, batch):
    res = dict(target)
    for k, (_, _d, c, a, x, b) in batch.items():
        if k is None or k not in target:
            res[k if k is not None else ("null", len(res))] = (k, c, a, x, b)
            continue
        old = target[k]
        new = [c, a, x]
        merged = [None if _is_marker(n) else (n if n is not None else o) for n, o in zip(new, old[1:4])]
        res[k] = (k, *merged, old[4])
    return res


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, min_size=1, max_size=25))
def test_unify_matches_model(spark, data):
    feed = _feed(data)
    df = spark.createDataFrame(feed, SCHEMA)
    want = sorted((tuple(v) for v in model_unify(feed).values()), key=lambda t: tuple((x is None, str(x)) for x in t))
    for method in ("window", "aggregate"):
        got = rows(unify(df, POLICY, method=method).select("k", "d", "c", "a", "x", "b"))
        assert got == want, method
    split = rows(unify(df, POLICY, method="auto", hot_key_rows=3).select("k", "d", "c", "a", "x", "b"))
    assert split == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, min_size=1, max_size=15), st.lists(_row, min_size=1, max_size=15))
def test_merge_matches_model(spark, first, second):
    f1 = _feed(first)
    f2 = [(k, d, 200 + e, c, a, x, b) for (k, d, e, c, a, x, b) in _feed(second)]
    u1, u2 = model_unify(f1), model_unify(f2)
    target = {k: (k, c, a, x, b) for k, (_, _d, c, a, x, b) in u1.items()}
    want = sorted(model_merge(target, u2).values(), key=lambda t: tuple((x is None, str(x)) for x in t))
    t_df = unify(spark.createDataFrame(f1, SCHEMA), POLICY).select("k", "c", "a", "x", "b")
    b_df = unify(spark.createDataFrame(f2, SCHEMA), POLICY)
    for strategy in ("shuffle", "broadcast"):
        got = rows(merge(t_df, b_df, POLICY, strategy=strategy).select("k", "c", "a", "x", "b"))
        assert got == want, strategy
