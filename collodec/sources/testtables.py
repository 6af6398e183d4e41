"""N-gram rows made from the test tables (lineitem, part, documents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LATIN = "abcdefghijklmnopqrstuvwxyz"
# As many letters from alef on.
HEBREW = "".join(chr(0x05D0 + i) for i in range(len(LATIN)))
ALEF, QAMATS = chr(0x05D0), chr(0x05B8)


def to_hebrew(word: str) -> str:
    """The letters that a plain word has after transliteration and cleaning."""
    return word.translate(str.maketrans(LATIN, HEBREW))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _each_once(rows: DataFrame) -> DataFrame:
    """N-gram rows with one occurrence each: every use of them adds up occurrences."""
    return rows.withColumn("occurrences", F.lit(1).cast("bigint"))


def product_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word product names by year of shipping.

    Shipments are counted per part before the join, so a part that ships a third of all
    lines joins as one row per year.
    """
    shipped = (
        _table(spark, sf_dir, "lineitem")
        .select("l_partkey", F.year("l_shipdate").alias("year"))
        .groupBy("l_partkey", "year")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    parts = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("ngram"))
    return (
        shipped.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("ngram", "year")
        .agg(F.sum("occurrences").alias("occurrences"))
    )


def words_of(bigrams: DataFrame) -> DataFrame:
    """The 1-gram table of a 2-gram table: each pair counts for both of its words."""
    return (
        bigrams.select(F.explode(F.split("ngram", " ")).alias("ngram"), "year", "occurrences")
        .groupBy("ngram", "year")
        .agg(F.sum("occurrences").alias("occurrences"))
    )


def product_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_of(product_bigrams(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, lang, text): whole texts; the year is made up."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return rows.select(
        (F.lit(1900) + F.col("doc_id") % 30).cast("int").alias("year"), "lang", "text"
    )


def _english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).where(F.col("lang") == "en")


def _in_hebrew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts with Latin letters written as Hebrew ones, alef pointed."""
    letters = F.translate(F.lower("text"), LATIN, HEBREW)
    pointed = F.replace(letters, F.lit(ALEF), F.lit(ALEF + QAMATS))
    return _documents(spark, sf_dir).withColumn("text", pointed)


def _tokens() -> Column:
    """Split at white space; a text that starts or ends with some has no empty token."""
    return F.array_remove(F.split("text", "[ \\t\\r\\n]+"), "").alias("tokens")


def _token_ngrams(documents: DataFrame) -> DataFrame:
    return _each_once(documents.select(F.explode(_tokens()).alias("ngram"), "year"))


def _neighbour_ngrams(documents: DataFrame) -> DataFrame:
    """Adjacent tokens of a document; its last token has no neighbour."""
    following = F.slice("tokens", F.lit(2), F.size("tokens"))
    pairs = F.arrays_zip(F.col("tokens").alias("a"), following.alias("b"))
    rows = documents.select(_tokens(), "year").select(F.inline(pairs).alias("a", "b"), "year")
    return _each_once(rows.where(F.col("b").isNotNull()).select(F.concat("a", F.lit(" "), "b").alias("ngram"), "year"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir)


def english_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _english(spark, sf_dir)


def hebrew_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_hebrew(spark, sf_dir)


def document_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_ngrams(_documents(spark, sf_dir))


def document_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbour_ngrams(_documents(spark, sf_dir))


def english_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the documents that are English, for what depends on the language."""
    return _token_ngrams(_english(spark, sf_dir))


def english_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbour_ngrams(_english(spark, sf_dir))


def hebrew_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents in Hebrew letters, punctuation and accents kept."""
    return _token_ngrams(_in_hebrew(spark, sf_dir))


def hebrew_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbour_ngrams(_in_hebrew(spark, sf_dir))
