"""Preparation of n-gram rows and their aggregations.

Every aggregation is a hash aggregate with a partial step before its shuffle, so a
word that holds a third of the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_ngram, clean_token, decade, first_token, framed_tokens, holds_words, last_token
from .bounded import broadcast_if_bounded, measured_bytes
from .filters import drop_empty, drop_null_keys, drop_stop_words, is_listed, listed_words


def cleaned_once(ngrams: DataFrame, language: str) -> DataFrame:
    """(_cleaned, year, occurrences), every n-gram cleaned once, however often it is used.

    It comes out of a generator: into a plain projection of both words, or a filter on one,
    the cleaning would be copied.
    """
    cleaned = F.struct(clean_ngram("ngram", language).alias("_cleaned"), "year", "occurrences")
    return ngrams.select(F.inline(F.array(cleaned)))


def prepare_unigrams(ngrams: DataFrame, language: str, stop_words: DataFrame) -> DataFrame:
    """1-gram rows -> (w, decade, occurrences), cleaned, without stop words."""
    rows = drop_null_keys(ngrams, ["ngram", "year"]).where(holds_words("ngram", 1, language))
    words = rows.select(
        clean_token("ngram", language).alias("w"), decade("year").alias("decade"), "occurrences"
    )
    return drop_stop_words(words, stop_words, ["w"])


def prepare_bigrams(ngrams: DataFrame, language: str, stop_words: DataFrame) -> DataFrame:
    """2-gram rows -> (w1, w2, decade, occurrences), cleaned, without stop words.

    A pair goes if either word is empty or a stop word; words are never bridged.
    """
    rows = drop_null_keys(ngrams, ["ngram", "year"]).where(holds_words("ngram", 2, language))
    pairs = rows.select(
        clean_token(first_token("ngram"), language).alias("w1"),
        clean_token(last_token("ngram"), language).alias("w2"),
        decade("year").alias("decade"),
        "occurrences",
    )
    return drop_stop_words(pairs, stop_words, ["w1", "w2"])


def framed(texts: DataFrame, language: str) -> DataFrame:
    """No filter on the text, under which Catalyst would make it once more; a NULL has no rows."""
    return drop_null_keys(texts, ["year"]).select(framed_tokens("text", language).alias("_tokens"), "year")


def _inside(first: int, frame: int) -> Column:
    """The framed tokens from one on, as many as there are without the frame."""
    return F.slice("_tokens", F.lit(first), F.greatest(F.size("_tokens") - frame, F.lit(0)))


def text_unigrams(texts: DataFrame, language: str) -> DataFrame:
    """(text, year) -> (w, year, occurrences): a row for each token, cleaned, empty ones too."""
    # By inline, not explode: for that Catalyst puts a filter on the array, made anew, in front.
    return framed_unigrams(framed(texts, language))


def framed_unigrams(rows: DataFrame) -> DataFrame:
    """``text_unigrams`` of framed tokens."""
    words = F.inline(F.arrays_zip(_inside(2, 2).alias("w"))).alias("w")
    return rows.select(words, "year").withColumn("occurrences", F.lit(1).cast("bigint"))


def text_bigrams(texts: DataFrame, language: str) -> DataFrame:
    """(text, year) -> (w1, w2, year, occurrences): a row for each token and the one after it.

    A text is cleaned before it is taken apart: one replacement, where n-gram rows need one
    for each token of each pair, and a search besides.
    """
    return framed_bigrams(framed(texts, language))


def framed_bigrams(rows: DataFrame) -> DataFrame:
    """``text_bigrams`` of framed tokens."""
    pairs = F.inline(F.arrays_zip(_inside(2, 3).alias("w1"), _inside(3, 3).alias("w2"))).alias("w1", "w2")
    return rows.select(pairs, "year").withColumn("occurrences", F.lit(1).cast("bigint"))


def _kept(rows: DataFrame, stop_words: DataFrame, words: list[str], others: tuple[str, ...] = ()) -> DataFrame:
    filled = drop_empty(rows, words)
    listed = listed_words(stop_words)
    if listed is not None:
        for w in words:
            filled = filled.where(~is_listed(w, listed))
    kept = filled.select(*words, *others, decade("year").alias("decade"), "occurrences")
    if listed is None:
        return drop_stop_words(kept, stop_words, words)
    # The order of columns that the joins leave.
    return kept.select(*reversed(words), *others, "decade", "occurrences")


def keep_unigrams(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """``text_unigrams`` -> (w, decade, occurrences), as ``prepare_unigrams`` leaves them."""
    return _kept(rows, stop_words, ["w"])


def keep_bigrams(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """``text_bigrams`` -> (w1, w2, decade, occurrences), as ``prepare_bigrams`` leaves them."""
    return _kept(rows, stop_words, ["w1", "w2"])


#: Of text, per task. The partial sums of the pairs of much more do not fit a task's memory,
#: and Spark then sorts them: several times the work.
TASK_BYTES = 24 << 20


def dealt(texts: DataFrame) -> DataFrame:
    """The texts in parts of which a task's partial sums stay in memory, measured."""
    size = measured_bytes(texts.select("text"))
    if size <= TASK_BYTES * texts.sparkSession.sparkContext.defaultParallelism:
        return texts
    return texts.repartition(-(-size // TASK_BYTES))


def text_followers(texts: DataFrame, language: str) -> DataFrame:
    """(text, year) -> (w1, w2, year, occurrences): a row for each token, with the one after it or an empty one."""
    return framed_followers(framed(texts, language))


def framed_followers(rows: DataFrame) -> DataFrame:
    """``text_followers`` of framed tokens."""
    pairs = F.inline(F.arrays_zip(_inside(2, 2).alias("w1"), _inside(3, 2).alias("w2"))).alias("w1", "w2")
    return rows.select(pairs, "year").withColumn("occurrences", F.lit(1).cast("bigint"))


def keep_followers(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """``text_followers`` -> (w1, w2, decade, occurrences): each kept word, w2 NULL where no kept word follows.

    ``bigram_counts`` of them holds B and U: one pass over the texts, and one shuffle, for both.
    """
    kept = _kept(rows, stop_words, ["w1"], ("w2",))
    listed = listed_words(stop_words)
    if listed is not None:
        dropped = (F.col("w2") == "") | is_listed("w2", listed)
    else:
        (word,) = stop_words.columns
        stop = stop_words.select(F.col(word).alias("w2"), F.lit(True).alias("_stop")).distinct()
        kept = kept.join(broadcast_if_bounded(stop), "w2", "left")
        dropped = (F.col("w2") == "") | F.col("_stop").isNotNull()
    return kept.select("w1", F.when(~dropped, F.col("w2")).alias("w2"), "decade", "occurrences")


def words_of_followers(counted: DataFrame) -> DataFrame:
    """U of counted ``keep_followers``: every kept token is the first word of one of them."""
    return counted.groupBy(F.col("w1").alias("w"), "decade").agg(F.sum("c12").alias("c"))


def pairs_of_followers(counted: DataFrame) -> DataFrame:
    """B of counted ``keep_followers``."""
    return counted.where(F.col("w2").isNotNull())


def unigram_counts(words: DataFrame) -> DataFrame:
    """U: C(w) per (w, decade), over all surface forms and years."""
    return words.groupBy("w", "decade").agg(F.sum("occurrences").alias("c"))


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """B: C(w1 w2) per (w1, w2, decade)."""
    return pairs.groupBy("w1", "w2", "decade").agg(F.sum("occurrences").alias("c12"))


def decade_totals(unigrams: DataFrame) -> DataFrame:
    """N: all kept unigram occurrences per decade."""
    return unigrams.groupBy("decade").agg(F.sum("c").alias("n"))


def merge_totals(totals: DataFrame) -> DataFrame:
    """Add up the partial totals of one decade."""
    return totals.groupBy("decade").agg(F.sum("n").alias("n"))


def unigram_grouping_sets(words: DataFrame) -> DataFrame:
    """U and N in one table: the rows with NULL for w are the decade totals.

    Words are counted first, so that what is doubled for the second grouping is U and not
    every occurrence.
    """
    return unigram_counts(words).groupingSets(
        [[F.col("decade"), F.col("w")], [F.col("decade")]], F.col("decade"), F.col("w")
    ).agg(F.sum("c").alias("c"))


def sum_measures(pairs: DataFrame) -> DataFrame:
    """Sum all four measures per pair and decade; the identity where keys are unique."""
    measures = ["c1", "c2", "c12", "n"]
    return pairs.groupBy("w1", "w2", "decade").agg(*[F.sum(m).alias(m) for m in measures])
