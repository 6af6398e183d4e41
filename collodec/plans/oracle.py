"""The registered queries in SQL, for a second engine to check them by."""

from __future__ import annotations

from ..sources.testtables import ALEF, HEBREW, LATIN, QAMATS
from .catalogue import ENGLISH_STOP_WORDS, HEBREW_STOP_WORDS

# The steps up to N, U and B, each under a name of its own; a query lists what it uses.


def _values(words: list[str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{w}')" for w in words) + ") AS t(word)"


def _clean(token: str, language: str) -> str:
    if language == "eng":
        return f"lower(regexp_replace({token}, '[^A-Za-z0-9]', '', 'g'))"
    return f"regexp_replace({token}, '[^{chr(0x05D0)}-{chr(0x05EA)}]', '', 'g')"


def _decade(year: str) -> str:
    return f"CAST(trunc({year} / 10.0) * 10 AS INTEGER)"


PRODUCT_STEPS = {
    "bi": """
        SELECT p_name AS ngram, CAST(year(l_shipdate) AS INTEGER) AS year,
               count(*) AS occurrences
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "uni": """
        SELECT ngram, year, CAST(sum(occurrences) AS BIGINT) AS occurrences
        FROM (SELECT unnest(string_split(ngram, ' ')) AS ngram, year, occurrences FROM bi)
        GROUP BY ALL""",
}


def _document_steps(where: str, letters: str) -> dict[str, str]:
    return {
        "docs": f"""
            SELECT doc_id, CAST(1900 + doc_id % 30 AS INTEGER) AS year,
                   list_filter(string_split_regex(text, '[ \\t\\r\\n]+'),
                               lambda x: x <> '') AS tokens
            FROM documents {where}""",
        "uni": f"""
            SELECT {letters.format('token')} AS ngram, year, count(*) AS occurrences
            FROM (SELECT unnest(tokens) AS token, year FROM docs) GROUP BY ALL""",
        "bi": f"""
            SELECT {letters.format("a || ' ' || b")} AS ngram, year, count(*) AS occurrences
            FROM (SELECT unnest(tokens[1:-2]) AS a, unnest(tokens[2:]) AS b, year
                  FROM docs WHERE len(tokens) > 1)
            GROUP BY ALL""",
    }


TEXT_STEPS = _document_steps("", "{}")
ENGLISH_STEPS = _document_steps("WHERE lang = 'en'", "{}")
HEBREW_STEPS = _document_steps(
    "", f"replace(translate(lower({{}}), '{LATIN}', '{HEBREW}'), '{ALEF}', '{ALEF}{QAMATS}')"
)


def _count_steps(language: str, stop_words: list[str]) -> dict[str, str]:
    clean1, clean2 = _clean("tokens[1]", language), _clean("tokens[2]", language)
    return {
        "stop": _values(stop_words),
        "words": f"""
            SELECT w, decade, occurrences FROM (
                SELECT {clean1} AS w, {_decade('year')} AS decade, occurrences
                FROM (SELECT string_split(rtrim(ngram, ' '), ' ') AS tokens, * FROM uni)
                WHERE len(tokens) = 1)
            WHERE w <> '' AND w NOT IN (SELECT word FROM stop)""",
        "pairs": f"""
            SELECT w1, w2, decade, occurrences FROM (
                SELECT {clean1} AS w1, {clean2} AS w2, {_decade('year')} AS decade, occurrences
                FROM (SELECT string_split(rtrim(ngram, ' '), ' ') AS tokens, * FROM bi)
                WHERE len(tokens) = 2)
            WHERE w1 <> '' AND w2 <> '' AND w1 NOT IN (SELECT word FROM stop)
              AND w2 NOT IN (SELECT word FROM stop)""",
        "u": """
            SELECT w, decade, CAST(sum(occurrences) AS BIGINT) AS c FROM words GROUP BY ALL""",
        "n": "SELECT decade, CAST(sum(c) AS BIGINT) AS n FROM u GROUP BY ALL",
        "b": """
            SELECT w1, w2, decade, CAST(sum(occurrences) AS BIGINT) AS c12
            FROM pairs GROUP BY ALL""",
        "counted": """
            SELECT b.w1, b.w2, b.decade, x.c AS c1, y.c AS c2, b.c12, coalesce(n.n, 1) AS n
            FROM b LEFT JOIN u x ON x.w = b.w1 AND x.decade = b.decade
                   LEFT JOIN u y ON y.w = b.w2 AND y.decade = b.decade
                   LEFT JOIN n ON n.decade = b.decade""",
        "valid": """
            SELECT *, CAST(c1 AS DOUBLE) AS k1, CAST(c2 AS DOUBLE) AS k2,
                   CAST(c12 AS DOUBLE) AS k12, CAST(n AS DOUBLE) AS kn,
                   coalesce(c1 > 0 AND c12 <= c1 AND c12 <= c2 AND c2 <= n AND c1 <= n
                            AND c2 - c12 <= n - c1, false) AS ok
            FROM counted""",
        "terms": """
            SELECT *,
                CASE WHEN NOT ok THEN NULL WHEN k2 = 0 THEN 0.01 WHEN k2 = kn THEN 0.99
                     ELSE k2 / kn END AS p,
                CASE WHEN NOT ok THEN NULL WHEN k12 = 0 THEN 0.01 WHEN k12 = k1 THEN 0.99
                     ELSE k12 / k1 END AS p1,
                CASE WHEN NOT ok THEN NULL WHEN k2 = k12 THEN 0.01
                     WHEN k2 - k12 = kn - k1 THEN 0.99
                     ELSE (k2 - k12) / (kn - k1) END AS p2
            FROM valid""",
        "logs": """
            SELECT *,
                k12 * ln(p) + (k1 - k12) * ln(1 - p) AS a,
                (k2 - k12) * ln(p) + (kn - k1 - k2 + k12) * ln(1 - p) AS b,
                k12 * ln(p1) + (k1 - k12) * ln(1 - p1) AS c,
                (k2 - k12) * ln(p2) + (kn - k1 - k2 + k12) * ln(1 - p2) AS d
            FROM terms""",
        "scored": "SELECT *, a + b - c - d AS llr FROM logs",
    }


ENGLISH_COUNTS = _count_steps("eng", ENGLISH_STOP_WORDS)
PRODUCTS = {**PRODUCT_STEPS, **ENGLISH_COUNTS}
TEXTS = {**TEXT_STEPS, **ENGLISH_COUNTS}
ENGLISH_TEXTS = {**ENGLISH_STEPS, **ENGLISH_COUNTS}
HEBREWS = {**HEBREW_STEPS, **_count_steps("heb", HEBREW_STOP_WORDS)}


def _with(steps: dict[str, str], select: str) -> str:
    # The steps that others read more than once are computed once, whatever the engine.
    kept = {"docs", "uni", "bi", "u", "b", "often"}
    named = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in kept else ''}({body})" for name, body in steps.items()
    )
    return f"WITH {named}\n{select}"


def _rounded(expression: str, digits: int = 3) -> str:
    r = f"round({expression}, {digits})"
    return f"CASE WHEN {r} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {r} END"


MIXED = """
    SELECT ngram, year, CAST(occurrences AS BIGINT) AS occurrences
    FROM (SELECT * FROM uni UNION ALL SELECT * FROM bi)
    WHERE len(string_split(rtrim(ngram, ' '), ' ')) = {}"""

CLEANED = """
    SELECT * FROM (
        SELECT ngram, CAST(sum(occurrences) AS BIGINT) AS occurrences, {} AS w
        FROM uni GROUP BY ngram)
    WHERE w <> ''"""

BIGRAM_ROWS = "SELECT ngram, year, CAST(occurrences AS BIGINT) AS occurrences FROM bi"

SCORES = f"SELECT w1, w2, decade, c1, c2, c12, n, {_rounded('llr')} AS llr FROM scored"

SINGLE_MARGINAL = """
    SELECT b.w1, b.w2, b.decade, b.c12, u.c AS {name}
    FROM b LEFT JOIN u ON u.w = b.{word} AND u.decade = b.decade"""

FREQUENT = {**TEXTS, "often": "SELECT * FROM u WHERE c >= 2"}
TWO_MARGINALS = """
    SELECT b.w1, b.w2, b.decade, b.c12, x.c AS c1, y.c AS c2
    FROM b {join} often x ON x.w = b.w1 AND x.decade = b.decade
           {join} often y ON y.w = b.w2 AND y.decade = b.decade"""

PARTIAL_PAIRS = "SELECT w1, w2, decade, c1, c12, n FROM counted"
UNIGRAMS = "SELECT w, decade, c FROM u"
TOTALS = "SELECT decade, n FROM n"
FIRST_MARGINAL = _with(TEXTS, SINGLE_MARGINAL.format(name="c1", word="w1"))



def _counters() -> str:
    """One row per counter of the counting stages; a row of the tables is one occurrence."""
    tokens = "string_split(rtrim(ngram, ' '), ' ')"
    parts = []
    for stage, rows, n, counted, kept, measure in (
        ("unigrams", "uni", 1, "u", "words", "c"), ("bigrams", "bi", 2, "b", "pairs", "c12"),
    ):
        right = f"len({tokens}) = {n}"
        clean = " AND ".join([right, *[_clean(f"{tokens}[{i}]", "eng") + " <> ''" for i in range(1, n + 1)]])
        values = {
            "rows_read": f"SELECT sum(occurrences) FROM {rows}",
            "right_arity": f"SELECT sum(occurrences) FROM {rows} WHERE {right}",
            "cleaned": f"SELECT sum(occurrences) FROM {rows} WHERE {clean}",
            "kept": f"SELECT sum(occurrences) FROM {kept}",
            "groups": f"SELECT count(*) FROM {counted}",
            "occurrences": f"SELECT sum({measure}) FROM {counted}",
        }
        parts += [f"SELECT '{stage}' AS stage, '{k}' AS counter, CAST(({v}) AS BIGINT) AS value" for k, v in values.items()]
    return " UNION ALL ".join(parts)


# The formula as it is written: powers, their products, logarithms of those.
_DRAWS = (("k12", "k1", "p"), ("k2 - k12", "kn - k1", "p"), ("k12", "k1", "p1"), ("k2 - k12", "kn - k1", "p2"))


def _ieee_steps() -> dict[str, str]:
    powers, logs = [], []
    for i, (k, m, x) in enumerate(_DRAWS):
        powers.append(f"pow({x}, {k}) * pow(1 - {x}, ({m}) - ({k})) AS l{i}")
        hits, misses = f"({k}) * ln({x})", f"(({m}) - ({k})) * ln(1 - {x})"
        logs += [hits, misses, f"{hits} + {misses}"]
    guarded = [
        f"CASE WHEN l{i} > 0 THEN ln(l{i}) ELSE CAST('-infinity' AS DOUBLE) END" for i in range(4)
    ]
    low = " OR ".join(f"({x}) < -700" for x in logs)
    band = " OR ".join(f"({x}) BETWEEN -746 AND -700" for x in logs)
    return {
        "powers": f"SELECT *, {', '.join(powers)}, {low} AS low, {band} AS band FROM terms",
        "ieee": f"""
            SELECT *, {guarded[0]} + {guarded[1]} - {guarded[2]} - {guarded[3]} AS score
            FROM powers""",
        "classed": """
            SELECT *, CASE WHEN NOT ok THEN 'no table' WHEN band THEN 'near underflow'
                           WHEN NOT low THEN 'value' WHEN isnan(score) THEN 'NaN'
                           WHEN isinf(score) AND score > 0 THEN '+Infinity'
                           WHEN isinf(score) THEN '-Infinity' ELSE 'finite' END AS kind
            FROM ieee""",
    }


IEEE_STEPS = _ieee_steps()

ORACLE_SQL: dict[str, str] = {
    "ngram_fields": _with(
        PRODUCTS,
        """SELECT ngram, year, CAST(occurrences AS BIGINT) AS occurrences,
                  CAST(len(string_split(ngram, ' ')) AS INTEGER) AS n_tokens FROM bi""",
    ),
    "ngram_fields_malformed": _with(PRODUCTS, BIGRAM_ROWS + " WHERE year NOT IN (1996, 1997)"),
    "ngram_quarantine": _with(PRODUCTS, """
        SELECT CASE year WHEN 1996 THEN 'occurrences' WHEN 1997 THEN 'fields' WHEN 1998 THEN 'year' ELSE 'kept' END AS kind,
               concat_ws(chr(9), ngram, CASE WHEN year = 1998 THEN 'y' ELSE '' END || year,
                         CASE year WHEN 1996 THEN 'many' WHEN 1997 THEN NULL ELSE CAST(occurrences AS VARCHAR) END) AS line
        FROM bi"""),
    "stage_counters": _with(TEXTS, _counters()),
    "add_release": _with(TEXTS, UNIGRAMS),
    "ngram_rows_malformed": _with(PRODUCTS, BIGRAM_ROWS + " WHERE year NOT IN (1996, 1997)"),
    "read_ngrams_parquet": _with(PRODUCTS, BIGRAM_ROWS),
    "read_ngrams_text": _with(PRODUCTS, BIGRAM_ROWS),
    "read_ngrams_sequence": _with(PRODUCTS, BIGRAM_ROWS),
    "filter_unigrams": _with(PRODUCTS, MIXED.format(1)),
    "filter_bigrams": _with(PRODUCTS, MIXED.format(2)),
    "clean_eng": _with(ENGLISH_TEXTS, CLEANED.format(_clean("ngram", "eng"))),
    "clean_heb": _with(HEBREWS, CLEANED.format(_clean("ngram", "heb"))),
    "clean_by_language": f"""
        SELECT 'eng' AS language, w, decade, c FROM ({_with(ENGLISH_TEXTS, UNIGRAMS)})
        UNION ALL
        SELECT 'heb' AS language, w, decade, c FROM ({_with(HEBREWS, UNIGRAMS)})""",
    "stop_unigrams": _with(
        TEXTS, "SELECT w, CAST(sum(occurrences) AS BIGINT) AS c FROM words GROUP BY w"
    ),
    "stop_bigrams": _with(
        TEXTS,
        "SELECT w1, w2, CAST(sum(occurrences) AS BIGINT) AS c12 FROM pairs GROUP BY w1, w2",
    ),
    "read_stop_words": _with(
        TEXTS,
        """SELECT w, decade, CAST(sum(occurrences) AS BIGINT) AS c FROM words
           WHERE w NOT IN (SELECT w FROM words GROUP BY w HAVING sum(occurrences) >= 100)
           GROUP BY ALL""",
    ),
    "null_keys": _with(
        TEXTS,
        f"""SELECT w1, w2, decade, CAST(sum(occurrences) AS BIGINT) AS c12 FROM (
              SELECT {_clean('tokens[1]', 'eng')} AS w1, {_clean('tokens[2]', 'eng')} AS w2,
                     {_decade('year')} AS decade, occurrences
              FROM (SELECT string_split(rtrim(ngram, ' '), ' ') AS tokens, * FROM bi)
              WHERE len(tokens) = 2 AND year >= 1905)
            WHERE w1 <> '' AND w2 <> '' GROUP BY ALL""",
    ),
    "decade_bucket": _with(
        PRODUCTS,
        f"""SELECT ngram, year, {_decade('year')} AS decade,
                   CAST(occurrences AS BIGINT) AS occurrences
            FROM (SELECT * FROM bi UNION ALL SELECT ngram, -year AS year, occurrences FROM bi)""",
    ),
    "unigram_counts": _with(TEXTS, UNIGRAMS),
    "decade_totals": _with(TEXTS, TOTALS),
    "unigram_grouping_sets": _with(
        PRODUCTS,
        """SELECT decade, w, CAST(sum(occurrences) AS BIGINT) AS c FROM words
           GROUP BY GROUPING SETS ((decade, w), (decade))""",
    ),
    "merge_totals": _with(
        TEXTS,
        f"""SELECT {_decade('year')} AS decade, CAST(sum(occurrences) AS BIGINT) AS n
            FROM uni GROUP BY 1""",
    ),
    "bigram_counts": _with(TEXTS, "SELECT w1, w2, decade, c12 FROM b"),
    "sum_measures": _with(
        PRODUCTS,
        f"""SELECT string_split(ngram, ' ')[1] AS w1, string_split(ngram, ' ')[2] AS w2,
                   {_decade('year')} AS decade, CAST(sum(occurrences) AS BIGINT) AS c1,
                   CAST(sum(2 * occurrences) AS BIGINT) AS c2, count(*) AS c12,
                   CAST(sum(year) AS BIGINT) AS n
            FROM bi GROUP BY 1, 2, 3""",
    ),
    "union_marginals_and_pairs": _with(
        PRODUCTS,
        """SELECT w1, w2, decade, c12, CAST(NULL AS BIGINT) AS c1 FROM b
           UNION ALL SELECT w, NULL, decade, NULL, c FROM u""",
    ),
    "split_union": _with(
        PRODUCTS,
        """SELECT 'unigrams' AS side, decade, count(*) AS n_rows, CAST(sum(c) AS BIGINT) AS total
           FROM u GROUP BY decade
           UNION ALL
           SELECT 'pairs', decade, count(*), CAST(sum(c12) AS BIGINT) FROM b GROUP BY decade""",
    ),
    "attach_first_marginal": FIRST_MARGINAL,
    "marginal_by_window": FIRST_MARGINAL,
    "attach_second_marginal": _with(TEXTS, SINGLE_MARGINAL.format(name="c2", word="w2")),
    "attach_marginals_split": _with(
        TEXTS, "SELECT w1, w2, decade, c12, c1, c2 FROM counted"
    ),
    "attach_total_split": _with(TEXTS, "SELECT w1, w2, decade, c12, n FROM counted"),
    "attach_total": _with(
        PRODUCTS,
        """SELECT w1, w2, b.decade, c12, coalesce(n.n, 1) AS n
           FROM b LEFT JOIN n ON n.decade = b.decade AND n.decade <> 2000""",
    ),
    "pair_marginals": _with(PRODUCTS, PARTIAL_PAIRS),
    "missing_marginals": _with(FREQUENT, TWO_MARGINALS.format(join="LEFT JOIN")),
    "required_marginals": _with(FREQUENT, TWO_MARGINALS.format(join="JOIN")),
    "reverse_pairs": _with(PRODUCTS, "SELECT w2 AS w1, w1 AS w2, decade, c12 FROM b"),
    "likelihood_terms": _with(
        PRODUCTS,
        "SELECT w1, w2, decade, "
        + ", ".join(f"{_rounded(t, 9)} AS {t}" for t in ("p", "p1", "p2"))
        + " FROM terms WHERE ok",
    ),
    "binomial_log_likelihood": _with(
        PRODUCTS,
        "SELECT w1, w2, decade, "
        + ", ".join(f"{_rounded(t)} AS ln_l{i}" for i, t in enumerate("abcd", start=1))
        + " FROM logs WHERE ok",
    ),
    "binomial_likelihood": _with(
        TEXTS,
        f"""SELECT w1, w2, decade,
                   {_rounded('pow(p1, k12) * pow(1 - p1, k1 - k12)', 6)} AS likelihood
            FROM terms WHERE ok""",
    ),
    "collocations": _with(PRODUCTS, SCORES),
    "collocations_text": _with(ENGLISH_TEXTS, SCORES),
    "strongest_pairs": _with(ENGLISH_TEXTS, f"""
        SELECT decade, CAST(rank AS INTEGER) AS rank, w1, w2, llr FROM (
            SELECT *, row_number() OVER (PARTITION BY decade ORDER BY llr, w1, w2) AS rank FROM ({SCORES}))
        WHERE rank <= 20"""),
    "collocations_heb": _with(HEBREWS, SCORES),
    "collocations_ieee": _with(
        {**ENGLISH_TEXTS, **IEEE_STEPS},
        f"""SELECT w1, w2, decade, kind, CASE WHEN kind = 'value' THEN {_rounded('score')} END AS llr
            FROM classed""",
    ),
    "key_order": _with(
        TEXTS,
        """SELECT *, row_number() OVER (ORDER BY decade, w1 NULLS FIRST, w2 NULLS FIRST) AS position
           FROM (SELECT w1, w2, decade, c12 AS occurrences FROM b
                 UNION ALL SELECT w, NULL, decade, c FROM u
                 UNION ALL SELECT NULL, NULL, decade, n FROM n)""",
    ),
    "order_by_counts": _with(
        PRODUCTS,
        """SELECT w1, w2, decade, c1, c12,
                  row_number() OVER (ORDER BY c12, c1, decade, w1, w2) AS position
           FROM counted""",
    ),
    "output_order": _with(
        TEXTS,
        """SELECT w1, w2, decade, c12,
                  row_number() OVER (ORDER BY decade, w2, w1) AS position FROM b""",
    ),
    "score_lines": _with(
        PRODUCTS,
        f"""SELECT w1 || ' ' || w2 || ' ' || decade || chr(9) || 'LogLikelihood is: '
                   || CAST(CAST({_rounded('llr')} AS DECIMAL(20, 3)) AS VARCHAR) AS line
            FROM scored""",
    ),
    "measure_lines": _with(
        PRODUCTS,
        """SELECT w1 || ' ' || w2 || ' ' || decade || chr(9)
                  || c1 || ' ' || c2 || ' ' || c12 || ' ' || n AS line
           FROM counted""",
    ),
    "write_unigrams": _with(TEXTS, UNIGRAMS),
    "write_unigrams_text": _with(TEXTS, UNIGRAMS),
    "write_totals": _with(TEXTS, "SELECT decade, 2 * n AS n FROM n"),
    "write_totals_text": _with(TEXTS, TOTALS),
    "write_pairs": _with(PRODUCTS, PARTIAL_PAIRS),
    "write_pairs_text": _with(PRODUCTS, PARTIAL_PAIRS),
    "write_pairs_text_missing": _with(
        PRODUCTS,
        "SELECT w1, w2, decade, CASE WHEN c1 >= 2000 THEN c1 END AS c1, c12, n FROM counted",
    ),
    "write_scores_text_missing": _with(
        PRODUCTS,
        f"""SELECT w1, w2, decade,
                   CASE WHEN c1 >= 2000 AND c2 >= 2000 THEN {_rounded('llr')} END AS llr
            FROM scored""",
    ),
    "write_scores": _with(PRODUCTS, f"SELECT w1, w2, decade, {_rounded('llr')} AS llr FROM scored"),
    "run_documents": _with(TEXTS, SCORES),
    "run_batch": _with(PRODUCTS, SCORES),
}
