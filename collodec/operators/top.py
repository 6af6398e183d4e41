"""The strongest pairs of every decade, without sorting or gathering a decade."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .lookup import shuffle_parts

_ORDER = [("decade", "ascending"), ("llr", "ascending"), ("w1", "ascending"), ("w2", "ascending")]


def _strongest(table: pa.Table, k: int) -> pa.Table:
    """The k first rows of each decade, in order, with their place in it."""
    table = table.take(pc.sort_indices(table, sort_keys=_ORDER, null_placement="at_start"))
    decade = table.column("decade").fill_null(np.iinfo(np.int32).min).to_numpy()
    starts = np.flatnonzero(np.append(True, decade[1:] != decade[:-1])[: len(decade)])
    place = np.arange(len(decade)) - np.repeat(starts, np.diff(np.append(starts, len(decade))))
    kept = np.flatnonzero(place < k)
    return table.take(pa.array(kept)).append_column("rank", pa.array(place[kept] + 1, pa.int32()))


def _heaps(batches: Iterator[pa.RecordBatch], k: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """What a task has of the strongest: k rows a decade are held, whatever comes."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]).select(columns)
        # Here and not in a filter: below the scores' projection a filter would repeat all of their terms.
        llr = rows.column("llr")
        rows = rows.filter(pc.and_(pc.is_valid(llr), pc.invert(pc.is_nan(llr))))
        held = _strongest(rows if held is None else pa.concat_tables([held, rows]), k).select(columns)
    if held is not None:
        yield from _strongest(held, k).combine_chunks().to_batches()


def strongest_pairs(scores: DataFrame, k: int) -> DataFrame:
    """(decade, rank, w1, w2, llr): the ``k`` pairs of lowest log λ per decade, ties by words.

    Every task keeps a heap of k rows a decade; only these meet, and are merged the same way.
    A pair without a score (NULL, NaN) is in no list; -Infinity comes first.
    """
    columns = ["decade", "llr", "w1", "w2"]
    schema = "decade int, llr double, w1 string, w2 string, rank int"
    own = scores.select(*columns).mapInArrow(lambda b: _heaps(b, k, columns), schema).drop("rank")
    merged = own.repartition(shuffle_parts(scores), "decade")
    return merged.mapInArrow(lambda b: _heaps(b, k, columns), schema).select("decade", "rank", "w1", "w2", "llr")
