"""Read back what earlier stages wrote, and stop lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import merge_totals
from .strict import check_mode, exactly, number, read_named

UNIGRAM_SCHEMA = "w string, decade int, c bigint"
BIGRAM_SCHEMA = "w1 string, w2 string, decade int, c12 bigint"
TOTALS_SCHEMA = "decade int, n bigint"
PAIRS_SCHEMA = "w1 string, w2 string, decade int, c1 bigint, c12 bigint, n bigint"
SCORES_SCHEMA = (
    "w1 string, w2 string, decade int, c1 bigint, c2 bigint, c12 bigint, n bigint, llr double"
)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, taken as it stands."""
    return spark.read.text(path).withColumnRenamed("value", "word")


def _measures_line() -> tuple[Column, Column]:
    """The key fields and the measures of ``w1 w2 decade<TAB>c1 c2 c12 n``."""
    line = F.col("value")
    parts = exactly(F.split(line, "\t"), 2, line)
    return exactly(F.split(parts[0], " "), 3, line), exactly(F.split(parts[1], " "), 4, line)


def read_unigrams(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """U(w, decade, c). Of a text line's measures only the first counts."""
    if fmt == "parquet":
        return read_named(spark, path, UNIGRAM_SCHEMA)
    key, measures = _measures_line()
    return spark.read.text(path).select(
        key[0].alias("w"), number(key[2], "int").alias("decade"), number(measures[0], "bigint").alias("c")
    )


def read_bigrams(spark: SparkSession, path: str) -> DataFrame:
    """B(w1, w2, decade, c12), which a run keeps as parquet."""
    return read_named(spark, path, BIGRAM_SCHEMA)


def read_pairs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(w1, w2, decade, c1, c12, n); the second word's count is not known yet."""
    if fmt == "parquet":
        return read_named(spark, path, PAIRS_SCHEMA)
    key, measures = _measures_line()
    return spark.read.text(path).select(
        key[0].alias("w1"),
        key[1].alias("w2"),
        number(key[2], "int").alias("decade"),
        number(measures[0], "bigint").alias("c1"),
        number(measures[2], "bigint").alias("c12"),
        number(measures[3], "bigint").alias("n"),
    )


def read_totals(
    spark: SparkSession, path: str, fmt: str = "parquet", mode: str = "FAILFAST"
) -> DataFrame:
    """N(decade, n), partial totals from several files added up.

    Text lines are ``decade n``; FAILFAST fails the job on another form, DROPMALFORMED
    passes over such lines, after which their decade may have no total.
    """
    check_mode(mode)
    if fmt == "parquet":
        return merge_totals(read_named(spark, path, TOTALS_SCHEMA, mode))
    lines = spark.read.text(path)
    fields = F.split("value", " ")
    if mode == "DROPMALFORMED":
        decade, n = (F.get(fields, F.lit(i)).try_cast(t) for i, t in enumerate(("int", "bigint")))
        lines = lines.where((F.size(fields) == 2) & decade.isNotNull() & n.isNotNull())
    fields = exactly(fields, 2, F.col("value"))
    return merge_totals(
        lines.select(number(fields[0], "int").alias("decade"), number(fields[1], "bigint").alias("n"))
    )


def read_scores(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scored pairs; as text only (w1, w2, decade, llr)."""
    if fmt == "parquet":
        return read_named(spark, path, SCORES_SCHEMA)
    line = F.col("value")
    parts = exactly(F.split(line, "\tLogLikelihood is: "), 2, line)
    key = exactly(F.split(parts[0], " "), 3, line)
    return spark.read.text(path).select(
        key[0].alias("w1"),
        key[1].alias("w2"),
        number(key[2], "int").alias("decade"),
        number(parts[1], "double").alias("llr"),
    )
