"""Row filters of the n-gram preparation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import arity
from .bounded import MAX_BROADCAST_BYTES, broadcast_if_bounded


#: Up to so many stop words stand in the condition itself. A join makes a key row for every
#: word that it looks up, and took as long as cleaning the texts.
MAX_LISTED = 256


def filter_arity(ngrams: DataFrame, n: int) -> DataFrame:
    """Rows whose n-gram has exactly n tokens."""
    return ngrams.where(arity("ngram") == n)


def drop_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is the empty string."""
    return df.where(reduce(and_, [F.col(c) != "" for c in columns]))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def listed_words(stop_words: DataFrame) -> list[str] | None:
    """The words of a short list, None of a longer one."""
    words = [r[0] for r in stop_words.limit(MAX_LISTED + 1).collect()]
    return None if len(words) > MAX_LISTED else sorted({w for w in words if w is not None})


def is_listed(c: str, words: list[str]) -> Column:
    return F.col(c).isin(words) if words else F.lit(False)


def drop_stop_words(
    df: DataFrame,
    stop_words: DataFrame,
    columns: Sequence[str],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows in which no column is a stop word. ``stop_words`` has one column.

    The list is matched as given against cleaned words. It is broadcast while its
    counted size allows; a longer one becomes an ordinary anti join.
    """
    (word,) = stop_words.columns
    stop = broadcast_if_bounded(stop_words, max_broadcast_bytes)
    for c in columns:
        df = df.join(stop.withColumnRenamed(word, c), c, "left_anti")
    return df
