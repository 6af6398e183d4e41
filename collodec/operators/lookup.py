"""Key lookup join that broadcasts a small table and splits hot keys of a large one.

A word pair table joined on one of its words is skewed as language is: one word of one
decade may hold a third of all pairs. A key with more rows than a partition's fair share
is split: its rows are spread over the splits by a hash of their remaining columns, and
its row in the looked-up table is repeated once per split.

With fair = rows / parts, fewer than ``parts`` keys can have more rows than that. So the
list of hot keys, which is broadcast, has fewer than ``parts`` rows whatever the data,
and the repeated rows number at most 2 * parts. A mergeable summary of frequent keys finds
them: only rows of keys that it names are counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bounded import MAX_BROADCAST_BYTES, is_bounded, measured_bytes

SPLIT = "_split"
SPLITS = "_splits"


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Counters of the summary of frequent keys, per partition. Its error is at most 3.5 rows of
#: as many as there are counters (a power of two above 4/3 of what is asked for), and a key is
#: in it for sure from two errors on: 8 leave no key out that has more than a fair share.
COUNTERS = 8
#: The most that the function takes.
MAX_COUNTERS = 1_000_000


def frequent_keys(rows: DataFrame, key: Sequence[str], parts: int) -> DataFrame:
    """One row: ``top``, hashes of all keys with more than 1 / parts of the rows, and ``n``.

    Every task keeps a bounded summary of frequent keys, and the summaries are merged: no key
    of the rows is exchanged. Fewer than 2 * parts hashes come out, some of keys with less.
    """
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in key)})"
    top = F.expr(f"approx_top_k({hashed}, {2 * parts}, {COUNTERS * parts})")
    return rows.agg(F.transform(top, lambda t: t["item"]).alias("top"), F.count(F.lit(1)).alias("n"))


def hot_keys(rows: DataFrame, key: Sequence[str], parts: int) -> DataFrame:
    """(key, _splits) of the keys that have more than one partition's share of the rows.

    Rows of the frequent keys alone are counted; the list, fewer than ``parts`` rows, is made
    here, once for both sides of a join.
    """
    parts = min(parts, MAX_COUNTERS // COUNTERS)
    top, n = frequent_keys(rows, key, parts).first()
    fair = max(n // parts, 1)
    of_frequent = rows.where(F.xxhash64(*key).isin(top))
    sizes = of_frequent.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    splits = F.least(F.ceil(F.col("_rows") / fair), F.lit(parts)).cast("int")
    hot = sizes.where(F.col("_rows") > fair).select(*key, splits.alias(SPLITS))
    return rows.sparkSession.createDataFrame(hot.collect() if top else [], hot.schema)


def assign_split(
    df: DataFrame, hot: DataFrame, key: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Give each row of df one of its key's splits, by a hash of the spread columns."""
    split = F.pmod(F.xxhash64(*spread), F.coalesce(SPLITS, F.lit(1))).cast("int")
    return df.join(F.broadcast(hot), list(key), "left").withColumn(SPLIT, split).drop(SPLITS)


def repeat_hot(keyed: DataFrame, hot: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key and split; the splits are numbered from 0."""
    numbers = F.sequence(F.lit(0), F.coalesce(SPLITS, F.lit(1)) - 1)
    with_splits = keyed.join(F.broadcast(hot), list(key), "left")
    return with_splits.select(*keyed.columns, F.explode(numbers).alias(SPLIT))


#: The most of a looked-up table that a task holds as a hash table, on average: hashes deal its
#: keys evenly, each is there once. Beyond that both sides are sorted, which needs no memory.
MAX_HASHED_BYTES = 32 << 20
MIN_HASHED_BYTES = 4 * MAX_BROADCAST_BYTES


def _hashed_if_bounded(keyed: DataFrame, values: DataFrame, parts: int) -> DataFrame:
    """``keyed``, with a hint to hash it where its partitions fit a task's memory.

    The rows that look it up are then not sorted. A smaller table is left to Spark, which
    broadcasts one that is small as it is stored, and a hint would keep it from that.
    """
    fits = MIN_HASHED_BYTES < measured_bytes(values) <= parts * MAX_HASHED_BYTES
    return keyed.hint("shuffle_hash") if fits else keyed


def _renamed(columns: Mapping[str, str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in columns.items()]


def lookup_join(
    df: DataFrame,
    keyed: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    spread: Sequence[str],
    how: str = "left",
    rows: DataFrame | None = None,
    parts: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """df with columns of ``keyed`` added on equal keys.

    keyed   one row per key; it is measured here and its plan runs twice, so it should be
            a stored table
    on      keyed column -> df column
    take    keyed column -> new column
    spread  df columns that tell the rows of one key apart
    how     "left" keeps rows without a match, "inner" drops them
    rows    a stored table with the keys of df, to find the hot ones by; df itself if not
            given
    """
    key = list(on.values())
    values = keyed.select(*_renamed({**on, **take}))
    if is_bounded(values, max_broadcast_bytes):
        joined = df.join(F.broadcast(values), key, how)
    else:
        hot = hot_keys(df if rows is None else rows, key, parts or shuffle_parts(df))
        repeated = _hashed_if_bounded(repeat_hot(values, hot, key), values, shuffle_parts(df))
        joined = assign_split(df, hot, key, spread).join(repeated, [*key, SPLIT], how)
    return joined.select(*df.columns, *take.values())
