"""Merge: patch-style upsert of a unified batch into the profile.

For every key of the batch (keys compared with ``=``, so NULL keys never match):

* matched, ``patch`` column: the marker clears the field (NULL), otherwise
  ``coalesce(new, old)``;
* matched, ``insert_only`` column: the stored value stays;
* not matched: the batch row is inserted as is, markers included (unless
  ``clear_on_insert``);
* profile rows without a batch row are untouched.

Two physical strategies give the same rows:

``shuffle``
    one full outer join on the keys. Free of extra exchanges when both sides
    are already hash-partitioned by the keys (e.g. both come from ``unify``);
    otherwise it shuffles the whole profile.
``broadcast``
    the profile is never shuffled: it is left-joined with the broadcast batch,
    and new keys are the batch keys that a broadcast semi-join did not find in
    the profile (that key set is no larger than the batch). Used only after
    the batch size is measured (``batch_size``) and found under the limit.

``auto`` measures the batch and picks ``broadcast`` when it fits, else
``shuffle``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.functions.markers import marker_sql
from patchprofile.functions.ordering import q
from patchprofile.policy import INSERT_ONLY, ColumnPolicy

_U = "__u"   # non-null flag: row came from the batch
_T = "__t"   # non-null flag: row came from the profile
STATE = "__state"
UPDATED, INSERTED, UNTOUCHED = "updated", "inserted", "untouched"

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _u(c: str) -> str:
    return f"__u_{c}"


@dataclass(frozen=True)
class BatchSize:
    rows: int
    bytes: int


def size_exprs(schema: T.StructType) -> list:
    """Aggregates giving (rows ``n``, variable bytes ``v``) of a frame with ``schema``;
    usable in ``agg`` or in ``observe`` on a write that happens anyway."""
    var = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
           for f in schema.fields
           if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    var_sum = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    return [F.count(F.lit(1)).alias("n"), F.coalesce(var_sum, F.lit(0)).cast("long").alias("v")]


def to_batch_size(schema: T.StructType, n: int, v: int) -> BatchSize:
    """Strings and binaries count their bytes; every field also counts an 8-byte
    slot, and each row a 16-byte header (the layout of Spark's unsafe rows)."""
    fixed = 16 + 8 * len(schema.fields)
    return BatchSize(int(n), int(n) * fixed + int(v or 0))


def batch_size(batch: DataFrame) -> BatchSize:
    """Measured in-memory size of a batch: one aggregate job over it."""
    row = batch.agg(*size_exprs(batch.schema)).first()
    return to_batch_size(batch.schema, row["n"], row["v"])


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_limit(spark) -> int:
    """Bytes up to which a measured batch is broadcast: the session's threshold, 64 MB where that
    is smaller, and never where the session switches broadcasts off (``-1``)."""
    conf = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", conf)
    if not m or m[2] not in _UNITS:
        return DEFAULT_BROADCAST_BYTES
    if int(m[1]) < 0:
        return -1
    return max(int(m[1]) * _UNITS[m[2]], DEFAULT_BROADCAST_BYTES)


def merge(target: DataFrame, batch: DataFrame, policy: ColumnPolicy, *,
          clear_on_insert: bool = False, null_marker_keys: bool = False,
          strategy: str = "auto", max_broadcast_bytes: int | None = None,
          known_size: BatchSize | None = None, unique_batch: bool = False) -> DataFrame:
    """New profile rows (the columns of ``policy.profile_columns()``)."""
    tagged = merge_tagged(target, batch, policy, clear_on_insert=clear_on_insert,
                          null_marker_keys=null_marker_keys, strategy=strategy,
                          max_broadcast_bytes=max_broadcast_bytes, known_size=known_size,
                          unique_batch=unique_batch)
    return tagged.drop(STATE)


def merge_counts(tagged: DataFrame) -> DataFrame:
    """Affected-row counts of a tagged merge: one row, one aggregate job."""
    s = F.col(STATE)
    updated = F.sum(F.when(s == UPDATED, 1).otherwise(0)).cast("long")
    inserted = F.sum(F.when(s == INSERTED, 1).otherwise(0)).cast("long")
    untouched = F.sum(F.when(s == UNTOUCHED, 1).otherwise(0)).cast("long")
    return tagged.agg(
        F.coalesce(updated, F.lit(0)).alias("rows_updated"),
        F.coalesce(inserted, F.lit(0)).alias("rows_inserted"),
        F.coalesce(updated + inserted, F.lit(0)).alias("rows_affected"),
        F.coalesce(untouched, F.lit(0)).alias("rows_untouched"),
        F.count(F.lit(1)).alias("rows_total"),
    )


def merge_tagged(target: DataFrame, batch: DataFrame, policy: ColumnPolicy, *,
                 clear_on_insert: bool = False, null_marker_keys: bool = False,
                 strategy: str = "auto", max_broadcast_bytes: int | None = None,
                 known_size: BatchSize | None = None, unique_batch: bool = False) -> DataFrame:
    """Merged profile plus a ``__state`` column: updated / inserted / untouched.

    Two batch rows of one key would multiply profile rows, so the merge raises on them (rows with a
    NULL key match nothing and are not checked). ``unique_batch`` says that the batch comes from
    ``unify``, with one row per key, and saves the check.

    ``known_size`` is the batch size measured earlier (e.g. observed while the
    batch was staged); without it ``auto`` runs one aggregate over the batch."""
    cols = policy.profile_columns()
    keys = list(policy.keys)
    values = [c for c in cols if c not in keys]
    batch = batch.select(*cols)
    target = target.select(*cols)
    types = {f.name: f.dataType for f in batch.schema.fields}
    if not unique_batch:
        batch = _one_row_per_key(batch, keys)

    if strategy == "auto":
        limit = broadcast_limit(batch.sparkSession) if max_broadcast_bytes is None else max_broadcast_bytes
        size = known_size if known_size is not None else batch_size(batch)
        strategy = "broadcast" if size.bytes <= limit else "shuffle"

    renamed = batch.selectExpr(*[q(k) for k in keys], *[f"{q(c)} AS {q(_u(c))}" for c in values],
                               f"true AS {_U}")
    flagged_target = target.selectExpr("*", f"true AS {_T}")

    # Expressions are SQL text: a 190-column merge is one call per column.
    def null_of(c: str) -> str:
        return f"CAST(NULL AS {types[c].simpleString()})"

    def patched(c: str) -> str:
        new, old = q(_u(c)), q(c)
        if policy.merge_rule(c) == INSERT_ONLY:
            return old
        return f"CASE WHEN {marker_sql(new, types[c], policy.marker)} THEN {null_of(c)} ELSE coalesce({new}, {old}) END"

    def inserted(c: str) -> str:
        new = q(_u(c))
        if clear_on_insert:
            return f"CASE WHEN {marker_sql(new, types[c], policy.marker)} THEN {null_of(c)} ELSE {new} END"
        return new

    def key_expr(k: str, matched: str) -> str:
        if not null_marker_keys:
            return f"{q(k)} AS {q(k)}"
        return (f"CASE WHEN {matched} AND {marker_sql(q(k), types[k], policy.marker)} THEN {null_of(k)} "
                f"ELSE {q(k)} END AS {q(k)}")

    if strategy == "shuffle":
        j = flagged_target.join(renamed, on=keys, how="full_outer")
        matched = f"({_T} IS NOT NULL AND {_U} IS NOT NULL)"
        new_only = f"{_T} IS NULL"
        out = [key_expr(k, matched) for k in keys]
        out += [f"CASE WHEN {new_only} THEN {inserted(c)} WHEN {matched} THEN {patched(c)} ELSE {q(c)} END AS {q(c)}"
                for c in values]
        out.append(f"CASE WHEN {new_only} THEN '{INSERTED}' WHEN {matched} THEN '{UPDATED}' "
                   f"ELSE '{UNTOUCHED}' END AS {STATE}")
        return j.selectExpr(*out)

    if strategy == "broadcast":
        # profile side: never shuffled, patched where the batch has the key
        j = flagged_target.join(F.broadcast(renamed), on=keys, how="left")
        matched = f"({_U} IS NOT NULL)"
        upd = [key_expr(k, matched) for k in keys]
        upd += [f"CASE WHEN {matched} THEN {patched(c)} ELSE {q(c)} END AS {q(c)}" for c in values]
        upd.append(f"CASE WHEN {matched} THEN '{UPDATED}' ELSE '{UNTOUCHED}' END AS {STATE}")
        # new keys: batch keys the profile lacks; the found-key set is <= batch size
        found = target.select(*keys).join(F.broadcast(batch.select(*keys)), on=keys, how="left_semi")
        fresh = renamed.join(F.broadcast(found), on=keys, how="left_anti")
        ins = [q(k) for k in keys] + [f"{inserted(c)} AS {q(c)}" for c in values] + [f"'{INSERTED}' AS {STATE}"]
        return j.selectExpr(*upd).unionByName(fresh.selectExpr(*ins))

    raise ValueError(f"unknown merge strategy {strategy!r}")


def _one_row_per_key(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch, raising when it is read and two rows share a key. The row number buffers no group. It costs one
    shuffle of the batch, which the join uses again unless it broadcasts or the profile has another number of buckets."""
    names = ", ".join(q(k) for k in keys)
    known = " AND ".join(f"{q(k)} IS NOT NULL" for k in keys)
    numbered = batch.selectExpr("*", f"row_number() OVER (PARTITION BY {names} ORDER BY {names}) AS __n")
    return numbered.where(f"CASE WHEN __n > 1 AND {known} THEN raise_error('the batch has two rows of one key') ELSE true END").drop("__n")


def empty_profile(batch: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """An empty profile with the batch's column types (first merge = insert all)."""
    schema = batch.select(*policy.profile_columns()).schema
    return batch.sparkSession.createDataFrame([], schema)
