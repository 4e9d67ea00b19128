"""Dimension joins with a checked broadcast.

A dimension is broadcast only when its exact row count (known because
every dimension is written once when built) times an estimated row width
fits the spec's budget; otherwise the join is left to a shuffle join
(and AQE may still turn it into a broadcast at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import StarSpec

_WIDTH = {T.StringType: 32, T.LongType: 8, T.IntegerType: 4, T.DoubleType: 8,
          T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
          T.BooleanType: 1, T.FloatType: 4, T.ShortType: 2, T.ByteType: 1}


def row_width(schema: T.StructType) -> int:
    """Estimated in-memory bytes per row (UnsafeRow header + fields)."""
    return 8 + sum(_WIDTH.get(type(f.dataType), 64) + 8 for f in schema.fields)


def fits_broadcast(df: DataFrame, rows: int | None, spec: StarSpec) -> bool:
    return rows is not None and rows * row_width(df.schema) <= spec.broadcast_max_bytes


def dim_side(df: DataFrame, rows: int | None, spec: StarSpec) -> DataFrame:
    """``broadcast(df)`` when its checked size fits, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, rows, spec) else df
