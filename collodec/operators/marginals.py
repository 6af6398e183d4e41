"""Attach C(w1), C(w2) and N to word pairs.

Pairs, unigrams and totals are looked at more than once (how many rows, which keys are
hot), so they should be stored tables; where pairs are derived from one that is, pass
that one as ``rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bounded import MAX_BROADCAST_BYTES
from .lookup import SPLIT, assign_split, hot_keys, lookup_join, repeat_hot, shuffle_parts


def _how(required: bool) -> str:
    return "inner" if required else "left"


def attach_first_marginal(
    pairs: DataFrame,
    unigrams: DataFrame,
    required: bool = False,
    rows: DataFrame | None = None,
    parts: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add c1 = C(w1). A word without a count gives NULL, or no row if required."""
    return lookup_join(
        pairs,
        unigrams,
        on={"w": "w1", "decade": "decade"},
        take={"c": "c1"},
        spread=["w2"],
        how=_how(required),
        rows=rows,
        parts=parts,
        max_broadcast_bytes=max_broadcast_bytes,
    )


def attach_second_marginal(
    pairs: DataFrame,
    unigrams: DataFrame,
    required: bool = False,
    rows: DataFrame | None = None,
    parts: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add c2 = C(w2). A word without a count gives NULL, or no row if required."""
    return lookup_join(
        pairs,
        unigrams,
        on={"w": "w2", "decade": "decade"},
        take={"c": "c2"},
        spread=["w1"],
        how=_how(required),
        rows=rows,
        parts=parts,
        max_broadcast_bytes=max_broadcast_bytes,
    )


def attach_total(
    pairs: DataFrame,
    totals: DataFrame,
    default: int = 1,
    rows: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add n, the decade's total; ``default`` for a decade that has none.

    There is one total per decade, so they are broadcast, unless the years are such that
    there are too many.
    """
    joined = lookup_join(
        pairs,
        totals,
        on={"decade": "decade"},
        take={"n": "n"},
        spread=["w1", "w2"],
        rows=rows,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    return joined.withColumn("n", F.coalesce("n", F.lit(default).cast("bigint")))


def pair_marginals(
    pairs: DataFrame, unigrams: DataFrame, totals: DataFrame, required: bool = False
) -> DataFrame:
    """(w1, w2, decade, c1, c12, n): pairs with all but the second word's count."""
    with_first = attach_first_marginal(pairs, unigrams, required)
    with_total = attach_total(with_first, totals, rows=pairs)
    return with_total.select("w1", "w2", "decade", "c1", "c12", "n")


def union_marginals_and_pairs(unigrams: DataFrame, pairs: DataFrame) -> DataFrame:
    """One key space (w1, w2, decade): w2 is NULL in the rows of single words."""
    words = unigrams.withColumnsRenamed({"w": "w1", "c": "c1"})
    return pairs.unionByName(words, allowMissingColumns=True)


def split_union(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Undo ``union_marginals_and_pairs``: (unigrams, pairs)."""
    words = rows.where(F.col("w2").isNull()).select(
        F.col("w1").alias("w"), "decade", F.col("c1").alias("c")
    )
    pairs = rows.where(F.col("w2").isNotNull()).select("w1", "w2", "decade", "c12")
    return words, pairs


def marginal_by_window(
    pairs: DataFrame, unigrams: DataFrame, parts: int | None = None
) -> DataFrame:
    """``attach_first_marginal`` as a window over the union of both tables.

    The word's own row is the header of its group and its count is carried to the
    group's pairs. Hot groups are split, each split with a header of its own.
    """
    key = ["w1", "decade"]
    hot = hot_keys(pairs, key, parts or shuffle_parts(pairs))
    headers = repeat_hot(unigrams.withColumnsRenamed({"w": "w1", "c": "c1"}), hot, key)
    rows = assign_split(pairs, hot, key, ["w2"])
    group = Window.partitionBy("decade", "w1", SPLIT)
    carried = F.max("c1").over(group)
    return (
        rows.unionByName(headers, allowMissingColumns=True)
        .withColumn("c1", carried)
        .where(F.col("w2").isNotNull())
        .select(*pairs.columns, "c1")
    )


def reverse_pairs(pairs: DataFrame) -> DataFrame:
    """Swap w1 and w2; twice is the identity."""
    swapped = {"w1": "w2", "w2": "w1"}
    return pairs.select(*[F.col(swapped.get(c, c)).alias(c) for c in pairs.columns])
