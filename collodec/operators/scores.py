"""Score pairs that have all four counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.likelihood import (
    Terms,
    likelihood_terms,
    likelihoods,
    log_likelihood_ratio,
    ratio_of_likelihoods,
)

_LIKELIHOODS = [f"_l{i}" for i in range(1, 5)]


def with_terms(counted: DataFrame, mode: str = "log") -> DataFrame:
    """Add p, p1 and p2."""
    return counted.withColumns(likelihood_terms(mode=mode)._asdict())


def term_columns() -> Terms:
    return Terms(*[F.col(name) for name in Terms._fields])


def with_scores(counted: DataFrame, mode: str = "log") -> DataFrame:
    """Add llr. The terms get a projection of their own, which keeps the code small.

    In ieee mode so do the likelihoods, which the logarithm's cases name four times each.
    """
    rows = with_terms(counted, mode)
    if mode == "ieee":
        rows = rows.withColumns(dict(zip(_LIKELIHOODS, likelihoods(terms=term_columns()))))
        llr = ratio_of_likelihoods(*map(F.col, _LIKELIHOODS))
    else:
        llr = log_likelihood_ratio(mode=mode, terms=term_columns())
    return rows.withColumn("llr", llr).drop(*Terms._fields, *_LIKELIHOODS)
