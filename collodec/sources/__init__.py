from .ngrams import Corpus, corpus, parse_ngram_line, read_ngrams
from .tables import read_pairs, read_stop_words, read_totals, read_unigrams

__all__ = [
    "Corpus",
    "corpus",
    "parse_ngram_line",
    "read_ngrams",
    "read_pairs",
    "read_stop_words",
    "read_totals",
    "read_unigrams",
]
