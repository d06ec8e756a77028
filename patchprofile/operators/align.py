"""Name-aligned insert: values go to an explicit column list, the rest is NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``df`` in the column order and types of ``schema``.

    Columns of ``schema`` that ``df`` lacks become typed NULLs (the table's
    default); a column of ``df`` that ``schema`` lacks is an error, as an
    INSERT naming an unknown column would be.
    """
    have = set(df.columns)
    extra = have - set(schema.fieldNames())
    if extra:
        raise ValueError(f"columns not in the target: {sorted(extra)}")
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
