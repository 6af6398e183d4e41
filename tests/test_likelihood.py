import math
import re

import pytest
from pyspark.sql import functions as F

from collodec.functions import (
    adjust_probability,
    binomial_likelihood,
    binomial_log_likelihood,
    log_likelihood_ratio,
    log_likelihood_terms,
)
from collodec.operators import with_scores
from collodec.plans.catalogue import QUERIES

NAN, INF = math.nan, math.inf

# (c1, c2, c12, n), ieee score, log score
VECTORS = [
    ((10, 8, 3, 1000), -9.057093620884395, -9.057093620884388),
    ((1, 1, 1, 500), -2.1884395043373335, -2.1884395043373335),
    ((5, 1, 1, 500), 0.26332093408610024, 0.26332093408609936),
    ((100, 5, 5, 100), 0.0, 0.0),
    ((3, 1, 1, 80000), INF, 793.6164841138124),
    ((20, 1, 1, 74000), 735.5054159923385, 735.2823376935545),
    ((200, 180, 50, 20000), NAN, -131.6764015269879),
    ((1000, 900, 100, 1000000), NAN, -382.7178621184412),
    ((10, 2, 3, 1000), NAN, None),
    ((7, 5, 1, 1), 12.102943015802365, None),
    ((None, 5, 1, 100), None, None),
]


@pytest.fixture(scope="module")
def counted(spark):
    return spark.createDataFrame(
        [counts for counts, _, _ in VECTORS], "c1 bigint, c2 bigint, c12 bigint, n bigint"
    ).coalesce(1)


def same(got, expected):
    if expected is None:
        return got is None
    if math.isnan(expected):
        return math.isnan(got)
    return got == pytest.approx(expected, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("mode", ["log", "ieee"])
@pytest.mark.parametrize("staged", [True, False])
def test_vectors(counted, mode, staged):
    scored = (
        with_scores(counted, mode)
        if staged
        else counted.withColumn("llr", log_likelihood_ratio(mode=mode))
    )
    got = {tuple(r)[:4]: r.llr for r in scored.collect()}
    for counts, ieee, log in VECTORS:
        assert same(got[counts], ieee if mode == "ieee" else log), counts


def test_sum_of_factors_is_the_ratio(counted):
    a, b, c, d = log_likelihood_terms()
    df = counted.select((a + b - c - d).alias("x"), log_likelihood_ratio().alias("llr"))
    for r in df.where("llr is not null").collect():
        assert r.x == pytest.approx(r.llr, abs=1e-8)


def test_zero_denominators(spark):
    df = spark.createDataFrame(
        [(0, 0, 0, 0), (0, 3, 1, 10), (5, 3, 1, 0), (5, 4, 1, 5)],
        "c1 bigint, c2 bigint, c12 bigint, n bigint",
    )
    assert [r.llr for r in with_scores(df).collect()] == [None] * 4
    ieee = [r.llr for r in with_scores(df, "ieee").collect()]
    assert all(x is not None for x in ieee)


def test_adjust_probability(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (NAN,)], "p double")
    got = [r[0] for r in df.select(adjust_probability("p")).collect()]
    assert got[:3] == [0.01, 0.99, 0.5] and math.isnan(got[3])


def test_binomial_forms_agree(spark):
    cases = [(0.0, 10.0, 0.3), (3.0, 10.0, 0.3), (10.0, 10.0, 0.3), (0.0, 4.0, 0.0), (4.0, 4.0, 1.0)]
    df = spark.createDataFrame(cases, "k double, n double, x double")
    rows = df.select(
        binomial_likelihood("k", "n", "x").alias("l"),
        F.exp(binomial_log_likelihood("k", "n", "x")).alias("e"),
    ).collect()
    for r, (k, n, x) in zip(rows, cases):
        assert r.l == pytest.approx(x**k * (1 - x) ** (n - k))
        assert r.e == pytest.approx(r.l)


def test_unknown_mode():
    with pytest.raises(ValueError):
        log_likelihood_ratio(mode="exact")


def test_ieee_classes_are_compiled(spark, capsys):
    """The JVM interprets methods of more than 8,000 bytes, row by row."""
    scored = QUERIES["collocations_ieee"](spark, "/root/testdata/sf0.001")
    capsys.readouterr()
    scored.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    scored.collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored.select("*").explain("codegen")
        sizes += [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000
