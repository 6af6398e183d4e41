"""Broadcasts behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 10 << 20
#: What a row costs besides its values, about.
ROW_BYTES = 16


def _value_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        raise ValueError(f"no size is known for {field.name}")
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """What the values of df take, about."""
    row = F.lit(ROW_BYTES)
    for field in df.schema:
        row = row + _value_bytes(field)
    return df.agg(F.sum(row)).first()[0] or 0


def is_bounded(df: DataFrame, max_bytes: int) -> bool:
    """Whether the values of df take at most ``max_bytes``, measured."""
    return measured_bytes(df) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it is small enough, else df as it is."""
    return F.broadcast(df) if is_bounded(df, max_bytes) else df
