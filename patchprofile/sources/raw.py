"""A raw table laid out by ingest time, so that a slice reads only its own row groups."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ZERO = dt.datetime(1970, 1, 1)


def _number(kind: T.DataType, by: str) -> Column:
    """The column as a whole number, for which Parquet statistics are always written and used (those of zoneless timestamps are not)."""
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{by}`)")
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.col(by).cast("long")
    raise ValueError("a raw table is sorted by a zoneless timestamp or a whole number")


def _bound(value: Any) -> int:
    return (value - _ZERO) // dt.timedelta(microseconds=1) if isinstance(value, dt.datetime) else int(value)


def write_clustered(rows: DataFrame, path: str, by: str, *, partitions: int | None = None, row_group_bytes: int = 64 << 20, page_rows: int = 20_000) -> None:
    """Append ``rows`` range-sorted by ``by`` (NULLs first): every file, row group and page covers a narrow range, which its statistics
    and page index say, so ``read_clustered`` skips the others. One range shuffle; a time that many rows share stays in one task."""
    rows = rows.withColumn(f"_{by}_no", _number(rows.schema[by].dataType, by))
    dealt = rows.repartitionByRange(partitions, F.col(f"_{by}_no")) if partitions else rows.repartitionByRange(F.col(f"_{by}_no"))
    (dealt.sortWithinPartitions(f"_{by}_no").write.mode("append").option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", page_rows).parquet(path))


def read_clustered(table: DataFrame, by: str, lo: Any, hi: Any) -> DataFrame:
    """The rows of a clustered table with ``lo < by <= hi`` (``lo`` None: no lower bound)."""
    no = F.col(f"_{by}_no")
    rows = table.where(no <= F.lit(_bound(hi)))
    return (rows if lo is None else rows.where(no > F.lit(_bound(lo)))).drop(f"_{by}_no")
