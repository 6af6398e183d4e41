"""Write the results of each stage.

Parquet output is laid out by decade, so that queries for some decades read no others.
A REBALANCE by decade comes first: it gathers a decade's rows into files of a good size,
and splits a large decade over as many tasks as it needs.

Tables may be written in turns: one job after the other, each with keys of its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..functions.text import format_measures_line, format_score_line, format_totals_line
from ..operators.ordering import output_order


def new_run_id() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class RunPaths:
    """Where one run keeps its tables: every run has a folder of its own."""

    root: str
    run_id: str = field(default_factory=new_run_id)

    def _path(self, name: str) -> str:
        return f"{self.root}/{self.run_id}/{name}"

    @property
    def unigrams(self) -> str:
        return self._path("unigrams")

    @property
    def totals(self) -> str:
        return self._path("totals")

    @property
    def bigrams(self) -> str:
        return self._path("bigrams")

    @property
    def pairs(self) -> str:
        return self._path("pairs")

    @property
    def scores(self) -> str:
        return self._path("scores")


#: As (this one, of how many).
Turn = tuple[int, int]
WHOLE: Turn = (0, 1)


def _writer(df: DataFrame, turn: Turn) -> DataFrameWriter:
    """The first turn fails on an existing table; the last one marks the table as whole."""
    this, of = turn
    writer = df.write.mode("append" if this else "errorifexists")
    return writer if this == of - 1 else writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


def _parquet(df: DataFrame, turn: Turn) -> DataFrameWriter:
    """zstd: two thirds of what snappy leaves of words and counts, for as much time."""
    return _writer(df, turn).option("compression", "zstd")


def _write_by_decade(df: DataFrame, path: str, turn: Turn = WHOLE) -> None:
    _parquet(df.hint("rebalance", "decade"), turn).partitionBy("decade").parquet(path)


def _check_format(fmt: str) -> None:
    if fmt not in ("parquet", "text"):
        raise ValueError(f"unknown format {fmt!r}; known: parquet, text")


def write_unigrams(unigrams: DataFrame, path: str, fmt: str = "parquet") -> None:
    """U; as text ``w * decade<TAB>c 0 0 0``."""
    _check_format(fmt)
    if fmt == "parquet":
        return _write_by_decade(unigrams, path)
    zero = F.lit(0)
    line = format_measures_line("w", F.lit("*"), "decade", "c", zero, zero, zero)
    unigrams.select(line).write.text(path)


def write_totals(totals: DataFrame, path: str, fmt: str = "parquet") -> None:
    """N; as text ``decade n``."""
    _check_format(fmt)
    if fmt == "parquet":
        return totals.write.parquet(path)
    totals.select(format_totals_line()).write.text(path)


def write_bigrams(bigrams: DataFrame, path: str, turn: Turn = WHOLE) -> None:
    """B, as its aggregation leaves it: it is read once more per word, each time in full."""
    _parquet(bigrams, turn).parquet(path)


def write_pairs(
    pairs: DataFrame, path: str, fmt: str = "parquet", by_decade: bool = True, turn: Turn = WHOLE
) -> None:
    """Pairs with c1, c12 and n; as text ``w1 w2 decade<TAB>c1 0 c12 n``.

    Laying parquet out by decade costs an exchange of all pairs, for readers of some
    decades; who reads all of them once does without.
    """
    _check_format(fmt)
    if fmt == "parquet":
        return _write_by_decade(pairs, path, turn) if by_decade else _parquet(pairs, turn).parquet(path)
    line = format_measures_line("w1", "w2", "decade", "c1", F.lit(0), "c12", "n")
    _writer(pairs.select(line), turn).text(path)


def write_scores(
    scores: DataFrame, path: str, fmt: str = "parquet", sorted: bool = False, turn: Turn = WHOLE
) -> None:
    """Scored pairs; as text ``w1 w2 decade<TAB>LogLikelihood is: x``.

    ``sorted`` orders all output by decade, second word and first word: a range
    partitioning on the whole key, so that no decade has to fit in one task. It takes one turn.
    """
    _check_format(fmt)
    if sorted:
        if turn != WHOLE:
            raise ValueError("sorted output is written whole")
        scores = output_order(scores)
    if fmt == "text":
        _writer(scores.select(format_score_line()), turn).text(path)
    elif sorted:
        _parquet(scores, turn).partitionBy("decade").parquet(path)
    else:
        _write_by_decade(scores, path, turn)
