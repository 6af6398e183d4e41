"""Orders of keys and of counts. Spark compares strings by their UTF-8 bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_order(df: DataFrame) -> DataFrame:
    """By decade, w1, w2; a missing word (a single word's or a decade's row) first."""
    return df.orderBy("decade", F.asc_nulls_first("w1"), F.asc_nulls_first("w2"))


def order_by_counts(df: DataFrame) -> DataFrame:
    """By c12, then c1; ties by key."""
    return df.orderBy("c12", "c1", "decade", "w1", "w2")


def output_order(df: DataFrame) -> DataFrame:
    """By decade, second word, first word: the order of written scores."""
    return df.orderBy("decade", "w2", "w1")
