"""Event-time precedence: a last-writer-wins register per column.

The reference lets a later batch win even where its event time is older. Here every profile column keeps, beside its
value, the event order it was written at (event time, then the tie-break). Two registers merge to the one written later
(``oldest`` columns: earlier), which is commutative, associative and idempotent: a profile does not depend on how
the feed was cut into batches, on their order, or on a batch that comes twice. It equals one unify of the whole feed.

As for ``unify``, event time and tie-break together must be unique within a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.functions.markers import marker_sql
from patchprofile.functions.ordering import event_order_sql, q
from patchprofile.operators.merge import INSERTED, STATE, UNTOUCHED, UPDATED
from patchprofile.operators.unify import HOT_KEY_ROWS, unify
from patchprofile.policy import OLDEST, ROW, ColumnPolicy

_U, _T, _B = "__u_", "__t", "__b"


def _columns(policy: ColumnPolicy) -> list[str]:
    return [c for c in policy.profile_columns() if c not in policy.keys]


def to_registers(feed: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """The feed with every profile column as ``struct<at, value>``; NULL where the value is NULL and the rule skips NULLs."""
    at = event_order_sql(policy)
    out = [q(k) for k in policy.keys] + [f"{q(c)} AS {q(_order(c))}" for c in policy.order_columns()]
    for c in _columns(policy):
        reg = f"named_struct('at', {at}, 'value', {q(c)})"
        out.append(f"{reg if policy.unify_rules[c] == ROW else f'CASE WHEN {q(c)} IS NOT NULL THEN {reg} END'} AS {q(c)}")
    return feed.selectExpr(*out)


def _order(c: str) -> str:
    return f"__o_{c}"  # an order column may be a profile column too


def _register_policy(policy: ColumnPolicy) -> ColumnPolicy:
    rules = {c: policy.unify_rules[c] for c in _columns(policy)}
    return ColumnPolicy(policy.keys, _order(policy.order_by), tuple(_order(t) for t in policy.tie_break), policy.nulls_first, rules, {}, policy.marker)


def unify_registers(feed: DataFrame, policy: ColumnPolicy, method: str = "auto", hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """One row of registers per key of the slice: ``unify`` over registers, hot keys and all."""
    policy.check_order()
    return unify(to_registers(feed, policy), _register_policy(policy), method=method, hot_key_rows=hot_key_rows)


def merge_registers(target: DataFrame, batch: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """The registers of both, per key the later-written one of each column (``oldest`` columns: the earlier)."""
    return merge_registers_tagged(target, batch, policy).drop(STATE)


def merge_registers_tagged(target: DataFrame, batch: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """Merged registers plus ``__state``: updated (the key is in both), inserted or untouched.

    Both sides hold at most one row per key. Keys with a NULL are the same key in every batch, as they are within one slice:
    they are few (one row a side and key) and are brought together apart, so that the join of all others is on plain equality,
    which a profile bucketed by its keys serves without a shuffle.
    """
    cols, keys = _columns(policy), list(policy.keys)
    target, batch = target.select(*keys, *cols, F.lit(True).alias(_T)), batch.select(*keys, *cols, F.lit(True).alias(_B))
    lone = " OR ".join(f"{q(k)} IS NULL" for k in keys)
    state = f"CASE WHEN {_B} IS NULL THEN '{UNTOUCHED}' WHEN {_T} IS NULL THEN '{INSERTED}' ELSE '{UPDATED}' END AS {STATE}"

    def best(c: str, a: str, b: str) -> str:
        return f"{'least' if policy.unify_rules[c] == OLDEST else 'greatest'}({a}, {b})"

    right = batch.where(f"NOT ({lone})").selectExpr(*map(q, keys), *(f"{q(c)} AS {q(_U + c)}" for c in cols), _B)
    known = target.where(f"NOT ({lone})").join(right, keys, "full_outer").selectExpr(*map(q, keys), *(f"{best(c, q(c), q(_U + c))} AS {q(c)}" for c in cols), state)
    both = target.where(lone).unionByName(batch.where(lone), allowMissingColumns=True)
    grouped = both.groupBy(*keys).agg(*(F.expr(f"{'min' if policy.unify_rules[c] == OLDEST else 'max'}({q(c)})").alias(c) for c in cols),
                                      F.max(_T).alias(_T), F.max(_B).alias(_B))
    return known.unionByName(grouped.selectExpr(*map(q, keys), *map(q, cols), state))


def register_values(registers: DataFrame, policy: ColumnPolicy, clear_markers: bool = True) -> DataFrame:
    """The profile that registers stand for: their values, with a marker read as NULL (kept with ``clear_markers=False``)."""
    types = {f.name: f.dataType for f in registers.schema.fields}
    out = [q(k) for k in policy.keys]
    for c in _columns(policy):
        v = f"{q(c)}.value"
        if clear_markers:
            v = f"CASE WHEN NOT {marker_sql(v, types[c]['value'].dataType, policy.marker)} THEN {v} END"
        out.append(f"{v} AS {q(c)}")
    return registers.selectExpr(*out)
