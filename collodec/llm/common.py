"""What the operators share: tables, the shared folder, whole texts as byte arrays."""

from __future__ import annotations

import atexit
import gc
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import Workspace, default_folder

#: Text bytes that a task works on at once; one longer text is worked on by itself.
CHUNK_BYTES = (2 << 20) - 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORKSPACES: dict[str, Workspace] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below ``spark.checkpoint.dir``, which all executors see.

    All such folders of one Spark application are in one workspace, deleted when Python
    ends if the application still runs.
    """
    name = spark.sparkContext.applicationId
    if name not in _WORKSPACES:
        _WORKSPACES[name] = Workspace(spark, default_folder(spark))
        atexit.register(_clear, name)
    return _WORKSPACES[name].new_path()


def _clear(name: str) -> None:
    own = _WORKSPACES.pop(name)
    if own.spark.sparkContext._jsc is not None:
        own.close()


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, and read from it: its lineage ends there."""
    path = folder or shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[Hashable, object] = {}


def per_worker(key: Hashable, make: Callable[[], object]):
    """What ``make`` gives, made once per Python worker and kept between its tasks.

    The last value of each kind (the key's first part) is kept.
    """
    kind = key[0] if isinstance(key, tuple) else key
    if _KEPT.get(kind, (None,))[0] != key:
        _KEPT.pop(kind, None)
        _KEPT[kind] = key, make()
    return _KEPT[kind][1]


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and the text, NULL as the empty text."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def as_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``size`` bytes of text or one row."""
    # A worker serves one task after the other; what the last one left stays until here.
    gc.collect()
    pa.default_memory_pool().release_unused()
    for batch in batches:
        ends = np.cumsum(lengths(batch.column(column)), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text."""
    return np.diff(text_bytes(column)[1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets of the texts: one more than texts)."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    dtype = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, dtype)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def runs_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, index of the text) of each maximal run of True that stays in one text."""
    n = len(mask)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_strings(data: np.ndarray, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte strings of all runs of ``mask``, as an Arrow array."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[mask].tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)


def joined(parts: list[np.ndarray], dtype: type = np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, np.uint64(base), np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS[:] = tables
    return _POWERS[0], _POWERS[1]


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings [start, end) of ``data``, equal for equal strings."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    sums = (total[ends] - total[starts]) * down[starts]
    return mixed(sums + (ends - starts).astype(np.uint64) * np.uint64(_MIX[0]))
