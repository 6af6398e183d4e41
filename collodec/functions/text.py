"""Token cleaning, tokenising, decade roll-up and text lines, as Columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CleanRule:
    """What a language keeps of a token: one character class, then a case step."""

    kept: str
    dropped: str
    lower: bool


# \p{Alnum} is [A-Za-z0-9] in Java's regex (ASCII only unless told otherwise). Its
# negation runs about four times as fast as [^A-Za-z0-9] in Spark's regexp_replace.
# The Hebrew range is alef to tav, written as escapes to keep it legible.
CLEAN_RULES = {
    "eng": CleanRule(kept=r"\p{Alnum}", dropped=r"\P{Alnum}", lower=True),
    "heb": CleanRule(kept=r"[\u05D0-\u05EA]", dropped=r"[^\u05D0-\u05EA]", lower=False),
}


#: A missing number in a text line.
NULL_MARK = "\\N"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_rule(language: str) -> CleanRule:
    if language not in CLEAN_RULES:
        raise ValueError(f"unknown language {language!r}; known: {sorted(CLEAN_RULES)}")
    return CLEAN_RULES[language]


def clean_token(c: Column | str, language: str) -> Column:
    """Strip what the language does not keep, then lower-case if it has case.

    Strip first: lower-casing first would turn some non-ASCII letters (U+212A) into
    ASCII ones and keep them.
    """
    rule = clean_rule(language)
    stripped = F.regexp_replace(as_column(c), rule.dropped, "")
    return F.lower(stripped) if rule.lower else stripped


def survives_cleaning(c: Column | str, language: str) -> Column:
    """True where ``clean_token`` leaves something.

    Same rows as ``clean_token(c) != ''``. That filter would be pushed below the
    projection and clean every token twice; this one stops at the first kept character.
    """
    return as_column(c).rlike(clean_rule(language).kept)


def _dropped_but_spaces(language: str) -> str:
    return f"[{clean_rule(language).dropped}&&[^ ]]"


def holds_words(c: Column | str, n: int, language: str) -> Column:
    """True where the n-gram has n tokens and ``clean_token`` leaves something of each.

    One pass instead of a count of tokens and a search in each; possessive throughout, so
    that no token, however long, is gone over again.
    """
    token = f"{_dropped_but_spaces(language)}*+{clean_rule(language).kept}[^ ]*+"
    return as_column(c).rlike(r"\A" + " ".join([token] * n) + r" *+\z")


def clean_ngram(c: Column | str, language: str) -> Column:
    """``clean_token`` of every token at once; the spaces between them stay."""
    rule = clean_rule(language)
    stripped = F.regexp_replace(F.rtrim(as_column(c)), _dropped_but_spaces(language), "")
    return F.lower(stripped) if rule.lower else stripped


def framed_tokens(c: Column | str, language: str) -> Column:
    """The tokens of a text, between white space, each as ``clean_token`` leaves it, and an empty one on either side.

    One replacement for the whole text. A token of which nothing is left stays as an empty
    one, so that its neighbours do not become neighbours of each other. The frame makes texts
    with white space at their ends, or nothing else, no case of their own.
    """
    rule = clean_rule(language)
    framed = F.concat(F.lit(" "), as_column(c), F.lit(" "))
    stripped = F.regexp_replace(F.regexp_replace(framed, "[ \\t\\r\\n]+", " "), _dropped_but_spaces(language), "")
    return F.split(F.lower(stripped) if rule.lower else stripped, " ")


def _only_spaces(c: Column | str) -> Column:
    return (F.rtrim(as_column(c)) == "") & (as_column(c) != "")


def ngram_tokens(c: Column | str) -> Column:
    """Tokens between single spaces; trailing empty tokens do not count.

    Only spaces are no token, nothing at all is one empty token.
    """
    none = F.array().cast("array<string>")
    return F.when(_only_spaces(c), none).otherwise(F.split(F.rtrim(as_column(c)), " "))


def arity(c: Column | str) -> Column:
    """The number of ``ngram_tokens``, counted by bytes instead of splitting."""
    ngram = F.rtrim(as_column(c))
    without_spaces = F.replace(ngram, F.lit(" "), F.lit(""))
    n = F.octet_length(ngram) - F.octet_length(without_spaces) + 1
    return F.when(_only_spaces(c), 0).otherwise(n)


def first_token(c: Column | str) -> Column:
    return F.substring_index(F.rtrim(as_column(c)), " ", 1)


def last_token(c: Column | str) -> Column:
    return F.substring_index(F.rtrim(as_column(c)), " ", -1)


def decade(year: Column | str) -> Column:
    """1987 -> 1980, truncating towards zero."""
    y = as_column(year)
    return (y - y % F.lit(10)).cast("int")


def _number(c: Column | str) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(NULL_MARK))


def format_score_line(w1="w1", w2="w2", decade="decade", llr="llr") -> Column:
    """``w1 w2 decade<TAB>LogLikelihood is: x``, x marked where it is missing."""
    key = F.concat_ws(" ", as_column(w1), as_column(w2), _number(decade))
    # Fixed value: the words in front of the score.
    score = F.concat(F.lit("LogLikelihood is: "), _number(llr))
    return F.concat_ws("\t", key, score)


def format_measures_line(w1, w2, decade, c1, c2, c12, n) -> Column:
    """``w1 w2 decade<TAB>c1 c2 c12 n``; a unigram row has ``*`` for w2.

    There are always four measures; a missing one is marked.
    """
    key = F.concat_ws(" ", as_column(w1), as_column(w2), _number(decade))
    measures = F.concat_ws(" ", *map(_number, (c1, c2, c12, n)))
    return F.concat_ws("\t", key, measures)


def format_totals_line(decade="decade", n="n") -> Column:
    """``decade n``"""
    return F.concat_ws(" ", _number(decade), _number(n))
