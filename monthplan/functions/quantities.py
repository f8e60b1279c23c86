"""Quantity types.

Quantities are ``decimal(18,3)`` from the moment they are computed, so sums are exact and independent of row order;
production rates keep six places.  Results leave the library as ``double`` (``to_edge``), which is what both Spark
and an outside SQL engine produce from the same decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QTY = T.DecimalType(18, 3)
RATE = T.DecimalType(18, 6)


def as_qty(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(QTY)


def as_rate(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(RATE)


def to_edge(df: DataFrame) -> DataFrame:
    """Cast decimals to double and small ints to bigint at the output edge of a query."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
