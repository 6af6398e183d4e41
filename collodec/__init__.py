"""Collocations per decade from n-gram counts, on Spark."""

from .plans.materialize import Workspace
from .plans.pipeline import Run, collocations, run, score_pairs
from .sinks.tables import RunPaths
from .sources.ngrams import Corpus, convert_ngrams, corpus, read_ngrams
from .sources.tables import read_stop_words

__all__ = [
    "Corpus",
    "Run",
    "RunPaths",
    "Workspace",
    "collocations",
    "convert_ngrams",
    "corpus",
    "read_ngrams",
    "read_stop_words",
    "run",
    "score_pairs",
]
