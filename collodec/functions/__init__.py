from .likelihood import (
    adjust_probability,
    binomial_likelihood,
    binomial_log_likelihood,
    likelihood_terms,
    log_likelihood_ratio,
    log_likelihood_terms,
    valid_counts,
)
from .text import (
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

__all__ = [
    "adjust_probability",
    "arity",
    "binomial_likelihood",
    "binomial_log_likelihood",
    "clean_token",
    "decade",
    "first_token",
    "format_measures_line",
    "format_score_line",
    "last_token",
    "likelihood_terms",
    "log_likelihood_ratio",
    "log_likelihood_terms",
    "ngram_tokens",
    "survives_cleaning",
    "valid_counts",
]
