"""Event order of a feed as a single comparable value.

``event_order_sql`` packs (null flag, event time, tie-breaks) into one struct
so that ``max``/``max_by`` over it picks the row an ``ORDER BY event DESC``
window would put first. Structs compare field by field, so one expression
serves every column rule of the unify and the top-1 row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchprofile.policy import ColumnPolicy


def event_order_desc(policy: ColumnPolicy) -> list[Column]:
    """The same order as window sort expressions (newest first)."""
    o = F.col(policy.order_by)
    first = o.desc_nulls_first() if policy.nulls_first else o.desc_nulls_last()
    return [first] + [F.col(t).desc_nulls_last() for t in policy.tie_break]


def q(name: str) -> str:
    """A column name quoted for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def order_sql(policy: ColumnPolicy) -> str:
    """ORDER BY text of the event order, newest first."""
    nulls = "NULLS FIRST" if policy.nulls_first else "NULLS LAST"
    parts = [f"{q(policy.order_by)} DESC {nulls}"] + [f"{q(t)} DESC NULLS LAST" for t in policy.tie_break]
    return ", ".join(parts)


def event_order_sql(policy: ColumnPolicy) -> str:
    """Struct that is larger for rows that come first in the DESC event order
    (nulls first: a NULL event time sets the leading flag)."""
    o = q(policy.order_by)
    flag = f"{o} IS NULL" if policy.nulls_first else f"{o} IS NOT NULL"
    fields = [f"'n', {flag}", f"'o', {o}"] + [f"'t{i}', {q(t)}" for i, t in enumerate(policy.tie_break)]
    return f"named_struct({', '.join(fields)})"
