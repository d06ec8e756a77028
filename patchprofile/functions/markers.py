"""The explicit "clear this field" marker.

The reference compares ``value::VARCHAR = '-11111'``. Rendering a number as
text is engine-specific (Spark renders the double -11111 as ``-11111.0``), so
the test here is type-aware: text columns compare the text, numeric columns
compare the number, and other types never carry the marker.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def fits(marker: str, dtype: T.DataType) -> bool:
    """Whether a column of ``dtype`` can hold the marker at all."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return True
    try:
        value = Decimal(marker)
    except InvalidOperation:
        return False
    if isinstance(dtype, _INTEGRAL):
        top = 1 << (_BITS[type(dtype)] - 1)
        return value == value.to_integral_value() and -top <= value < top
    if isinstance(dtype, T.DecimalType):
        scaled = value.scaleb(dtype.scale)
        return scaled == scaled.to_integral_value() and abs(scaled) < Decimal(10) ** dtype.precision
    return isinstance(dtype, _FRACTIONAL)


def marker_literal(marker: str, dtype: T.DataType) -> Column | None:
    """The marker as a literal of ``dtype``; None when the type cannot hold it."""
    if not fits(marker, dtype):
        return None
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit(marker)
    if isinstance(dtype, T.DecimalType) or isinstance(dtype, _INTEGRAL):
        return F.lit(Decimal(marker)).cast(dtype)
    return F.lit(float(marker)).cast(dtype)


def is_marker(col: Column, dtype: T.DataType, marker: str) -> Column:
    """True where ``col`` holds the clear marker; False (never NULL) otherwise."""
    lit = marker_literal(marker, dtype)
    if lit is None:
        return F.lit(False)
    return F.coalesce(col == lit, F.lit(False))


def marker_sql(expr: str, dtype: T.DataType, marker: str) -> str:
    """``is_marker`` as SQL expression text (for wide, generated projections)."""
    if not fits(marker, dtype):
        return "false"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        lit = "'" + marker.replace("'", "''") + "'"
    else:
        lit = f"CAST({marker} AS {dtype.simpleString()})"
    return f"coalesce({expr} = {lit}, false)"
