"""A set of hashes of fixed size, which may hold more than was put in, never less.

What is looked up in it only narrows a search: results do not depend on its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed

#: 16 MB, whatever the data.
MAP_BITS = 27


def _bit(values: np.ndarray) -> np.ndarray:
    return (mixed(values ^ np.uint64(0x5DEECE66D)) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


class BitMap:
    """A set of 64-bit values that may hold more than was put in; of fixed size."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, value: int) -> bool:
        return bool(self.of(np.array([value], np.uint64))[0])

    def of(self, values: np.ndarray) -> np.ndarray:
        bit = _bit(values)
        return (self.words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def bit_map(values: DataFrame) -> BitMap:
    """The map of a column of longs. What the driver gets has a fixed size."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique(_bit(batch.column(0).to_numpy().view(np.uint64)))
            masks = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(masks)], ["word", "mask"])

    masks = values.mapInArrow(bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    words = np.zeros((1 << MAP_BITS) // 64, np.uint64)
    found = masks.toArrow()
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return BitMap(words)
