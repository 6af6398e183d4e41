"""Log-likelihood ratio of a word pair, as Columns.

Counts: c1 = C(w1), c2 = C(w2), c12 = C(w1 w2), n = all kept words of the decade.
The result is log lambda, not -2 log lambda: more negative is a stronger collocation.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

# What stands in for a probability of exactly 0 or 1.
PROBABILITY_FOR_ZERO = 0.01
PROBABILITY_FOR_ONE = 0.99

MODES = ("log", "ieee")


class Terms(NamedTuple):
    p: Column
    p1: Column
    p2: Column


def _doubles(*columns: Column | str) -> list[Column]:
    return [as_column(c).cast("double") for c in columns]


def adjust_probability(p: Column | str) -> Column:
    p = as_column(p)
    return (
        F.when(p == 0.0, F.lit(PROBABILITY_FOR_ZERO))
        .when(p == 1.0, F.lit(PROBABILITY_FOR_ONE))
        .otherwise(p)
    )


def _quotient(a: Column, b: Column) -> Column:
    """a / b, NULL for b = 0 (a plain ``/`` fails the job under ANSI)."""
    return a / F.nullif(b, F.lit(0.0))


def _ieee_quotient(a: Column, b: Column) -> Column:
    by_zero = (
        F.when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
        .when(a == 0, F.lit(float("nan")))
    )
    return F.when(b == 0, by_zero).otherwise(_quotient(a, b))


def _ieee_ln(x: Column) -> Column:
    # NaN > 0 holds in Spark, and ln(NaN) is NaN.
    return (
        F.when(x == 0, F.lit(float("-inf")))
        .when(x < 0, F.lit(float("nan")))
        .otherwise(F.log(x))
    )


def likelihood_terms(c1="c1", c2="c2", c12="c12", n="n", mode: str = "log") -> Terms:
    """p = c2/n, p1 = c12/c1, p2 = (c2-c12)/(n-c1), boundary values replaced.

    In log mode 0/0 counts as 0; it only arises where the term's exponents are 0.
    """
    c1, c2, c12, n = _doubles(c1, c2, c12, n)
    if mode == "ieee":
        quotients = (
            _ieee_quotient(c2, n),
            _ieee_quotient(c12, c1),
            _ieee_quotient(c2 - c12, n - c1),
        )
    else:
        left_over, others = c2 - c12, n - c1
        p2 = F.when((left_over == 0) & (others == 0), F.lit(0.0)).otherwise(
            _quotient(left_over, others)
        )
        quotients = (_quotient(c2, n), _quotient(c12, c1), p2)
    return Terms(*[adjust_probability(q) for q in quotients])


def binomial_likelihood(k: Column | str, n: Column | str, x: Column | str) -> Column:
    """x^k (1-x)^(n-k) in IEEE doubles; underflows to 0 on large counts."""
    k, n, x = _doubles(k, n, x)
    return F.pow(x, k) * F.pow(F.lit(1.0) - x, n - k)


def binomial_log_likelihood(k: Column | str, n: Column | str, x: Column | str) -> Column:
    """ln of ``binomial_likelihood``, with 0 * ln 0 = 0 and no underflow."""
    k, n, x = _doubles(k, n, x)
    hits = F.when(k == 0, F.lit(0.0)).otherwise(k * F.log(x))
    misses = F.when(n == k, F.lit(0.0)).otherwise((n - k) * F.log1p(-x))
    return hits + misses


def valid_counts(c1="c1", c2="c2", c12="c12", n="n") -> Column:
    """Counts that one contingency table can have; NULL or false otherwise."""
    c1, c2, c12, n = [as_column(c) for c in (c1, c2, c12, n)]
    return (
        (c1 > 0)
        & (c12 <= c1)
        & (c12 <= c2)
        & (c2 <= n)
        & (c1 <= n)
        & (c2 - c12 <= n - c1)
    )


def _draws(c1, c2, c12, n, terms: Terms) -> list[tuple[Column, Column, Column]]:
    p, p1, p2 = terms
    c1, c2, c12, n = _doubles(c1, c2, c12, n)
    return [(c12, c1, p), (c2 - c12, n - c1, p), (c12, c1, p1), (c2 - c12, n - c1, p2)]


def likelihoods(c1="c1", c2="c2", c12="c12", n="n", *, terms: Terms) -> list[Column]:
    """The four L of the ieee mode."""
    return [binomial_likelihood(*draw) for draw in _draws(c1, c2, c12, n, terms)]


def ratio_of_likelihoods(a: Column, b: Column, c: Column, d: Column) -> Column:
    """log lambda of the ieee mode from ``likelihoods``."""
    return _ieee_ln(a) + _ieee_ln(b) - _ieee_ln(c) - _ieee_ln(d)


def log_likelihood_terms(
    c1="c1", c2="c2", c12="c12", n="n", mode: str = "log", terms: Terms | None = None
) -> list[Column]:
    """The four ln L whose signed sum (+ + - -) is log lambda."""
    terms = terms or likelihood_terms(c1, c2, c12, n, mode)
    if mode == "ieee":
        return [_ieee_ln(x) for x in likelihoods(c1, c2, c12, n, terms=terms)]
    return [binomial_log_likelihood(*draw) for draw in _draws(c1, c2, c12, n, terms)]


def log_likelihood_ratio(
    c1="c1", c2="c2", c12="c12", n="n", mode: str = "log", terms: Terms | None = None
) -> Column:
    """log lambda of the pair.

    ``log``  works on logarithms throughout: finite for every valid table, NULL otherwise.
    ``ieee`` multiplies powers first, as the formula is written: NaN or infinite where
             the powers underflow.

    Pass ``terms`` as columns of the table where speed matters (``with_scores`` does):
    written out in one expression they repeat so often that the JVM does not compile it.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {MODES}")
    terms = terms or likelihood_terms(c1, c2, c12, n, mode)
    if mode == "ieee":
        return ratio_of_likelihoods(*likelihoods(c1, c2, c12, n, terms=terms))
    valid = valid_counts(c1, c2, c12, n)
    p, p1, p2 = terms
    c1, c2, c12, n = _doubles(c1, c2, c12, n)
    left_over, others = c2 - c12, n - c1
    # No term is 0 or 1, so every logarithm is finite.
    ratio = (
        c12 * (F.log(p) - F.log(p1))
        + (c1 - c12) * (F.log1p(-p) - F.log1p(-p1))
        + left_over * (F.log(p) - F.log(p2))
        + (others - left_over) * (F.log1p(-p) - F.log1p(-p2))
    )
    return F.when(valid, ratio)
