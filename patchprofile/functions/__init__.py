"""Column expressions shared by the operators (all built-in Spark functions)."""

from patchprofile.functions.markers import is_marker, marker_literal
from patchprofile.functions.markers import marker_sql
from patchprofile.functions.ordering import event_order_desc, event_order_sql, order_sql, q

__all__ = ["is_marker", "marker_literal", "marker_sql", "event_order_desc", "event_order_sql", "order_sql", "q"]
