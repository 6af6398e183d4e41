import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from collodec.functions import (
    arity,
    clean_token,
    decade,
    first_token,
    format_measures_line,
    format_score_line,
    last_token,
    ngram_tokens,
    survives_cleaning,
)

ALL_CHARACTERS = "".join(
    chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) != "Cs"
)


@pytest.fixture(scope="module")
def characters(spark):
    """Every character, in lumps between kept letters."""
    lumps = [(f"aZ{ALL_CHARACTERS[i:i + 4096]}9",) for i in range(0, len(ALL_CHARACTERS), 4096)]
    return spark.createDataFrame(lumps, "t string")


def test_english_cleaning_of_every_character(characters):
    for r in characters.select("t", clean_token("t", "eng").alias("w")).collect():
        assert r.w == re.sub("[^A-Za-z0-9]", "", r.t).lower()


def test_hebrew_cleaning_of_every_character(characters):
    for r in characters.select("t", clean_token("t", "heb").alias("w")).collect():
        assert r.w == re.sub("[^א-ת]", "", r.t)


@pytest.mark.parametrize("language", ["eng", "heb"])
def test_survives_cleaning_is_a_nonempty_clean_token(spark, language):
    tokens = [(c,) for c in ALL_CHARACTERS[:0x3000]] + [("",), ("--",), ("a-",), ("-א",)]
    df = spark.createDataFrame(tokens, "t string")
    differing = df.where(survives_cleaning("t", language) != (clean_token("t", language) != ""))
    assert differing.count() == 0


@pytest.mark.parametrize(
    "token, language, expected",
    [
        ("God,", "eng", "god"),
        ("Can't", "eng", "cant"),
        ("1984", "eng", "1984"),
        ("café", "eng", "caf"),
        ("--", "eng", ""),
        ("Kelvin", "eng", "elvin"),
        ("שָׁלוֹם־x", "heb", "שלום"),
        ("אב12", "heb", "אב"),
    ],
)
def test_cleaning_examples(spark, token, language, expected):
    row = spark.createDataFrame([(token,)], "t string").select(clean_token("t", language)).first()
    assert row[0] == expected


def test_unknown_language():
    with pytest.raises(ValueError):
        clean_token("t", "lat")


def test_tokens_and_arity(spark):
    grams = ["god", "god ", "god   ", " god", "a b", "a  b", "a b ", "a b c", "", "  ", "\ta b"]
    df = spark.createDataFrame([(g,) for g in grams], "g string")
    rows = df.select(
        "g",
        ngram_tokens("g").alias("tokens"),
        arity("g").alias("arity"),
        first_token("g").alias("first"),
        last_token("g").alias("last"),
    ).collect()
    for r in rows:
        # Only spaces are no token at all.
        only_spaces = r.g != "" and not r.g.strip(" ")
        assert r.tokens == ([] if only_spaces else r.g.rstrip(" ").split(" "))
        assert r.arity == len(r.tokens)
        if r.tokens:
            assert r.first == r.tokens[0]
            assert r.last == r.tokens[-1]


def test_decade_truncates(spark):
    years = {1801: 1800, 1809: 1800, 1810: 1810, 2000: 2000, 9: 0, 0: 0, -5: 0, -15: -10}
    df = spark.createDataFrame([(y,) for y in years], "y int")
    assert {r.y: r.d for r in df.select("y", decade("y").alias("d")).collect()} == years


def test_lines(spark):
    df = spark.createDataFrame(
        [("salt", "wind", 1730, -12.25)], "w1 string, w2 string, decade int, llr double"
    )
    line = df.select(format_score_line()).first()[0]
    assert line == "salt wind 1730\tLogLikelihood is: -12.25"
    numbers = [F.lit(i) for i in (7, 0, 3, 900)]
    line = df.select(format_measures_line("w1", "w2", "decade", *numbers)).first()[0]
    assert line == "salt wind 1730\t7 0 3 900"
