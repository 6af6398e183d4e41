import pytest

import random

from pyspark.sql import functions as F

from collodec.functions import text
from collodec.plans import catalogue
from collodec.plans.catalogue import QUERIES
from collodec.sources import testtables
from collodec.operators import counts, filters
from collodec.operators.counters import counted_bigrams, counted_text_bigrams, counted_text_tables, counted_text_unigrams, counted_unigrams
from collodec.operators.counts import keep_bigrams, keep_unigrams, text_bigrams, text_unigrams
from collodec.operators import (
    bigram_counts,
    decade_totals,
    drop_empty,
    drop_null_keys,
    drop_stop_words,
    filter_arity,
    merge_totals,
    prepare_bigrams,
    prepare_unigrams,
    sum_measures,
    unigram_counts,
    unigram_grouping_sets,
)

from conftest import rows_of

UNIGRAMS = [
    ("God,", 1801, 10),
    ("god", 1809, 5),
    ("god", 1810, 7),
    ("The", 1801, 999),
    ("Can't", 1801, 4),
    ("--", 1801, 3),
    ("1984", 1801, 2),
    ("café", 1801, 2),
    ("god ", 1801, 1),
    (" god", 1801, 1),
    ("a b", 1801, 1),
    (None, 1801, 1),
    ("god", None, 1),
]

BIGRAMS = [
    ("calm God", 1611, 3),
    ("Calm god.", 1619, 2),
    ("the god", 1611, 3),
    ("god the", 1611, 3),
    ("god -- end", 1611, 3),
    ("-- god", 1611, 3),
    ("god --", 1611, 3),
    (" god", 1611, 3),
    ("god", 1611, 3),
    ("god  end", 1611, 3),
    ("god end ", 1620, 4),
]


def test_unigrams(ngrams, stop_words):
    words = unigram_counts(prepare_unigrams(ngrams(UNIGRAMS), "eng", stop_words))
    assert rows_of(words, "w", "decade", "c") == [
        ("1984", 1800, 2),
        ("caf", 1800, 2),
        ("god", 1800, 16),
        ("god", 1810, 7),
    ]
    assert rows_of(decade_totals(words), "decade", "n") == [(1800, 20), (1810, 7)]


def test_bigrams(ngrams, stop_words):
    pairs = bigram_counts(prepare_bigrams(ngrams(BIGRAMS), "eng", stop_words))
    assert rows_of(pairs, "w1", "w2", "decade", "c12") == [
        ("calm", "god", 1610, 5),
        ("god", "end", 1620, 4),
    ]


def test_hebrew(ngrams, spark):
    stop = spark.createDataFrame([("של",)], "word string")
    rows = [
        ("שָׁלוֹם־x", 1801, 2),
        ("אב12", 1801, 2),
        ("של", 1801, 5),
        ("abc", 1801, 5),
    ]
    words = unigram_counts(prepare_unigrams(ngrams(rows), "heb", stop))
    assert rows_of(words, "w", "decade", "c") == [
        ("אב", 1800, 2),
        ("שלום", 1800, 2),
    ]


def test_grouping_sets_are_words_and_totals(ngrams, stop_words):
    prepared = prepare_unigrams(ngrams(UNIGRAMS), "eng", stop_words)
    words = unigram_counts(prepared)
    both = unigram_grouping_sets(prepared)
    assert rows_of(both.where("w is not null"), "w", "decade", "c") == rows_of(words)
    assert rows_of(both.where("w is null"), "decade", "c") == rows_of(decade_totals(words))


def test_merge_totals(spark):
    totals = spark.createDataFrame([(1800, 3), (1800, 4), (1810, 1)], "decade int, n bigint")
    assert rows_of(merge_totals(totals)) == [(1800, 7), (1810, 1)]


def test_sum_measures_is_the_identity_on_unique_keys(spark):
    schema = "w1 string, w2 string, decade int, c1 bigint, c2 bigint, c12 bigint, n bigint"
    rows = [("a", "b", 1800, 5, 4, 2, 90), ("a", "c", 1800, 5, 3, 1, 90)]
    once = spark.createDataFrame(rows, schema)
    assert rows_of(sum_measures(once)) == rows
    twice = sum_measures(once.unionByName(once))
    assert rows_of(twice) == [(*r[:3], *(2 * m for m in r[3:])) for r in rows]


def test_overflow_fails(ngrams, stop_words):
    big = ngrams([("god", 1801, 2**62)] * 2)
    with pytest.raises(Exception, match="(?i)overflow"):
        unigram_counts(prepare_unigrams(big, "eng", stop_words)).collect()


def test_filters(spark, ngrams):
    grams = ngrams([("a", 1, 1), ("a b", 1, 1), ("a b c", 1, 1)])
    for n, expected in ((1, "a"), (2, "a b"), (3, "a b c")):
        assert rows_of(filter_arity(grams, n), "ngram") == [(expected,)]
    pairs = spark.createDataFrame(
        [("a", "b", 1), ("", "b", 1), ("a", "", 1), (None, "b", 1), ("a", "b", None)],
        "w1 string, w2 string, decade int",
    )
    assert drop_empty(pairs, ["w1", "w2"]).count() == 2
    assert drop_null_keys(pairs, ["w1", "w2", "decade"]).count() == 3


def test_long_stop_list_is_not_broadcast(spark):
    words = spark.range(1000).selectExpr("cast(id as string) w")
    stop = spark.range(0, 1000, 2).selectExpr("cast(id as string) word")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        short = drop_stop_words(words, stop, ["w"])
        long = drop_stop_words(words, stop, ["w"], max_broadcast_bytes=499)
        assert "BroadcastHashJoin" in plan_of(short)
        assert "BroadcastHashJoin" not in plan_of(long)
        assert rows_of(short) == rows_of(long) and short.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("language", ["eng", "heb"])
def test_ngrams_are_judged_once(spark, ngrams, language):
    """One search says what tokens, their number and their cleaning say one by one."""
    rng = random.Random(5)
    odd = ["a", "B", "9", "א", "ת", "-", "K", "é", " ", " ", "\n", "\t", " ", "\U0001f600"]
    rows = [("".join(rng.choices(odd, k=rng.randint(0, 7))), 1801, 1) for _ in range(3000)] + [(None, 1801, 1)]
    rows += [("a" * 100_000 + " " + "-" * 100_000, 1801, 1), ("-" * 100_000 + "a א" + "b" * 100_000, 1801, 1)]
    df = ngrams(rows)
    for n in (1, 2):
        tokens = text.ngram_tokens("ngram")
        whole = text.arity("ngram") == n
        for i in range(n):
            whole = whole & text.survives_cleaning(F.get(tokens, F.lit(i)), language)
        judged = df.select(F.coalesce(whole, F.lit(False)) == F.coalesce(text.holds_words("ngram", n, language), F.lit(False)))
        assert all(r[0] for r in judged.collect())
    cleaned = F.transform(text.ngram_tokens("ngram"), lambda t: text.clean_token(t, language))
    assert df.where(F.concat_ws(" ", cleaned) != text.clean_ngram("ngram", language)).where(text.arity("ngram") == 2).count() == 0
    plan = prepare_bigrams(df, language, spark.sql("SELECT 'x' AS word"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("rlike") <= 1


def test_null_keys_clean_once(spark):
    plan = QUERIES["null_keys"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("language", ["eng", "heb"])
def test_texts_are_counted_as_their_ngrams(spark, language):
    """Cleaned whole and then taken apart, or taken apart and then cleaned: the same rows."""
    rng = random.Random(7)
    odd = ["a", "B", "the", "9", "א", "ת", "-", "K", "é", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", " ", "\U0001f600"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 30))) for _ in range(600)]
    texts += ["", " ", " \n", "--", "god -- end", " god ", "God,\tend.\r\n", None]
    df = spark.createDataFrame([(t, rng.choice([1801, 1815, None])) for t in texts], "text string, year int")
    stop = spark.sql("SELECT 'the' AS word")
    rows = df.select(testtables._tokens(), "text", "year")
    ones, twos = testtables._token_ngrams(rows), testtables._neighbour_ngrams(rows)
    words = prepare_unigrams(ones, language, stop)
    pairs = prepare_bigrams(twos, language, stop)
    assert rows_of(keep_unigrams(text_unigrams(df, language), stop)) == rows_of(words) != []
    assert rows_of(keep_bigrams(text_bigrams(df, language), stop)) == rows_of(pairs) != []
    for by_text, by_row, rows in (
        (counted_text_unigrams, counted_unigrams, ones),
        (counted_text_bigrams, counted_bigrams, twos),
    ):
        (table, own), (expected, counters) = by_text(df, language, stop), by_row(rows, language, stop)
        assert rows_of(table) == rows_of(expected)
        wanted = counters.values()
        # Of n-grams without a year, which texts do not give.
        undated = rows.where("year IS NULL").count()
        assert own.values() == wanted | {"rows_read": wanted["rows_read"] - undated}


@pytest.mark.parametrize("name", ["bigram_counts", "unigram_counts"])
def test_documents_are_cleaned_before_they_are_taken_apart(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("rlike") == 0 and "regexp_replace" in plan
    assert "regexp_replace" not in plan[: plan.index("Generate")]
    # White space, then what is dropped: each once.
    assert plan.count("regexp_replace") == 2


def test_texts_are_made_once(spark):
    """Letters written as others stand once in each count, not again in a filter."""
    texts = testtables.hebrew_texts(spark, "/root/testdata/sf0.001")
    for rows in (text_unigrams(texts, "heb"), text_bigrams(texts, "heb")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("translate(") == 1 and plan.count("regexp_replace") == 2


@pytest.mark.parametrize("listed", [256, 0])
def test_words_and_pairs_of_one_pass(spark, monkeypatch, workspace, listed):
    """(U, B) and all counters from one pass over texts, as from one for each; stop list in the row or joined."""
    monkeypatch.setattr(filters, "MAX_LISTED", listed)
    rng = random.Random(11)
    tokens = ["a", "B,", "the", "--", "x9", "God", "end.", "The", "\u05d0"]
    texts = [rng.choice(["", " "]) + " ".join(rng.choices(tokens, k=rng.randint(0, 9))) for _ in range(300)]
    texts += ["", " ", "--", "the", "the the", "god", "god the", "the god", "god -- end", None]
    df = spark.createDataFrame([(t, rng.choice([1801, 1815, None])) for t in texts], "text string, year int")
    stop = spark.sql("SELECT word FROM VALUES ('the'), ('the'), ('a'), (NULL) AS t(word)")
    words = unigram_counts(keep_unigrams(text_unigrams(df, "eng"), stop))
    pairs = bigram_counts(keep_bigrams(text_bigrams(df, "eng"), stop))
    got_words, got_pairs, own = counted_text_tables(df, "eng", stop, workspace.materialize)
    assert rows_of(got_words, "w", "decade", "c") == rows_of(words, "w", "decade", "c") != []
    assert rows_of(got_pairs, "w1", "w2", "decade", "c12") == rows_of(pairs, "w1", "w2", "decade", "c12") != []
    for count, found in ((counted_text_unigrams, own[0]), (counted_text_bigrams, own[1])):
        table, expected = count(df, "eng", stop)
        table.collect()
        assert found.values() == expected.values() and found.values()["kept"] > 0


def test_short_stop_list_is_no_join(spark):
    texts = testtables.document_texts(spark, "/root/testdata/sf0.001")
    stop = spark.sql("SELECT 'the' AS word")
    for rows in (keep_unigrams(text_unigrams(texts, "eng"), stop), keep_bigrams(text_bigrams(texts, "eng"), stop)):
        assert "Join" not in plan_of(rows)


@pytest.mark.parametrize("name", ["required_marginals", "stage_counters", "attach_marginals_split", "missing_marginals"])
def test_documents_are_read_once(spark, monkeypatch, name):
    """Words and pairs come out of one pass: texts are cleaned for one of all tables written."""
    cleaned, write = [], catalogue.Workspace.materialize
    monkeypatch.setattr(
        catalogue.Workspace,
        "materialize",
        lambda self, df: cleaned.append(df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")) or write(self, df),
    )
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(cleaned)[-2:] == [0, 2]


def test_large_texts_are_dealt(spark, monkeypatch):
    """As many parts as partial sums need to stay in memory, however few the scan makes."""
    df = spark.createDataFrame([(f"god end {i}", 1801) for i in range(200)], "text string, year int").coalesce(1)
    assert counts.dealt(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(counts, "TASK_BYTES", 300)
    parts = counts.dealt(df)
    assert parts.rdd.getNumPartitions() > 8 and rows_of(parts) == rows_of(df)
