"""Column policy: the configuration that replaces hundreds of repeated SQL lines.

A profile feed has key columns, an event-order column with a unique tie-break,
and one rule per attribute column. Unify rules decide how a slice collapses to
one row per key; merge rules decide how that row patches the stored profile.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

# Unify rules
NEWEST = "newest"  # newest non-null value per key (FIRST_VALUE ... IGNORE NULLS, order DESC)
OLDEST = "oldest"  # oldest non-null value per key (LAST_VALUE ... IGNORE NULLS, order DESC)
ROW = "row"        # value of the newest row, nulls included (top-1 row per key)
DROP = "drop"      # loaded and copied to staging, never unified

# Merge rules
PATCH = "patch"              # marker -> NULL, else coalesce(new, old)
INSERT_ONLY = "insert_only"  # written on insert, never updated
NOT_MERGED = "not_merged"    # reaches the unified batch, not the profile

# Fixed value: the text of the clear marker that the merge compares against.
CLEAR_MARKER = "-11111"


@dataclass(frozen=True)
class ColumnPolicy:
    keys: tuple[str, ...]
    order_by: str
    tie_break: tuple[str, ...] = ()
    # Null order of the DESC event order; the reference's engine puts NULLs
    # first in analytic windows, so a NULL event time ranks as the newest.
    nulls_first: bool = True
    unify_rules: Mapping[str, str] = field(default_factory=dict)
    merge_rules: Mapping[str, str] = field(default_factory=dict)
    marker: str = CLEAR_MARKER

    def __post_init__(self):
        for c, r in self.unify_rules.items():
            if r not in (NEWEST, OLDEST, ROW, DROP):
                raise ValueError(f"unknown unify rule {r!r} for {c}")
        for c, r in self.merge_rules.items():
            if r not in (PATCH, INSERT_ONLY, NOT_MERGED):
                raise ValueError(f"unknown merge rule {r!r} for {c}")
        overlap = set(self.keys) & set(self.unify_rules)
        if overlap:
            raise ValueError(f"key columns cannot carry unify rules: {sorted(overlap)}")

    # --- column sets -------------------------------------------------------
    def unified_columns(self) -> list[str]:
        """Columns of the unified batch, keys first, policy order after."""
        return list(self.keys) + [c for c, r in self.unify_rules.items() if r != DROP]

    def columns_with(self, rule: str) -> list[str]:
        return [c for c, r in self.unify_rules.items() if r == rule]

    def merge_rule(self, col: str) -> str:
        return self.merge_rules.get(col, PATCH)

    def profile_columns(self) -> list[str]:
        """Columns stored in the profile: unified columns minus not-merged ones."""
        return [c for c in self.unified_columns() if self.merge_rule(c) != NOT_MERGED]

    def check_order(self) -> None:
        """Unify needs a tie-break: without one, equal event times would let the physical form decide the result."""
        if not self.tie_break:
            raise ValueError("tie_break must name columns that order rows of equal event time")

    def order_columns(self) -> list[str]:
        return [self.order_by, *self.tie_break]

    def with_columns(self, rules: Mapping[str, str]) -> "ColumnPolicy":
        merged = dict(self.unify_rules)
        merged.update(rules)
        return ColumnPolicy(self.keys, self.order_by, self.tie_break, self.nulls_first,
                            merged, dict(self.merge_rules), self.marker)
