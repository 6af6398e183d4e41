"""Benchmark decontamination by an FM-index over each shard of the training texts.

A shard is the part of a task's documents that is worked on at once. Its words become ids
of the benchmark's vocabulary (0: any other word, or the end of a document); stretches of
known words that are shorter than the shortest test phrase cannot hold one and are left
out. The Burrows-Wheeler transform of what stays is kept in a wavelet tree. All test
phrases are searched backward at once, each step two rank queries per phrase; phrases leave
when their row range is empty. Occurrences are located by walking back to sampled suffix
positions, and overlapping ones are merged to removal spans.

The benchmark travels with the tasks in blocks of some ``BLOCK_BYTES`` of text. Every document
passes all blocks in turn, and between two blocks the documents and what was found are
written, so the driver holds two blocks at most: there is no bound on the benchmark, and
nothing is shuffled.

Rules: a NULL or empty text has no words and is clean. A NULL item has no words and is
never found; an item without an id counts under the id "null". Repeated documents each get
a row, repeated items count once. Other columns are not looked at. An empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, run_strings, runs_of, spread, stored, text_bytes, texts

WINDOW = 13
BLOCK_BYTES = 16 << 20
SAMPLE_EVERY = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Word bytes after lower-casing: digits, a to z, all of a code point from U+0080 on.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, start, end, text index, code points before each byte) of a text column."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    mask = _WORD[data]
    starts, ends, doc = runs_of(mask, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return run_strings(data, mask, starts, ends), starts, ends, doc, points


class Phrases:
    """A block of the benchmark: its vocabulary and windows by length."""

    def __init__(self, items: list[tuple[str, str]]):
        column = pa.array([text for _, text in items], pa.large_string())
        words, _, _, doc, _ = words_of(column)
        encoded = words.dictionary_encode()
        self.vocabulary = encoded.dictionary
        ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        bounds = np.searchsorted(doc, np.arange(len(items) + 1))
        found: dict[bytes, set[str]] = {}
        for (item, _), low, high in zip(items, bounds[:-1], bounds[1:], strict=True):
            size = min(WINDOW, high - low)
            for at in range(low, high - size + 1) if size else ():
                found.setdefault(ids[at : at + size].tobytes(), set()).add(item)
        by_size: dict[int, list[bytes]] = {}
        for key in found:
            by_size.setdefault(len(key) // 8, []).append(key)
        #: length: (matrix of windows, ids of the items of each)
        self.windows = {
            size: (
                np.frombuffer(b"".join(keys), np.int64).reshape(-1, size),
                [sorted(found[k]) for k in keys],
            )
            for size, keys in by_size.items()
        }


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by doubling the sorted length."""
    n = len(symbols)
    rank, width = symbols.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (max(int(rank.max()), n) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        width *= 2
        if rank[order[-1]] == n - 1 or width >= 2 * n:
            return order


class Bits:
    """A bit vector with rank, a count for each 64 bits."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits in front of each position."""
        at = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & low).astype(np.int64)


class WaveletTree:
    """rank(symbol, i) by one bit vector per bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for bit in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> bit) & 1
            self.levels.append((bit, Bits(bits)))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def ranks(self, symbol: np.ndarray, *positions: np.ndarray) -> list[np.ndarray]:
        """For each of ``positions``: how many of the symbol stand in front of it."""
        places = [np.zeros_like(symbol), *positions]  # the first: where the symbol's block starts
        for bit, level in self.levels:
            right = ((symbol >> bit) & 1).astype(bool)
            for k, i in enumerate(places):
                ones = level.ones(i)
                places[k] = np.where(right, level.zeros + ones, i - ones)
        return [p - places[0] for p in places[1:]]

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        symbol = np.zeros_like(i)
        for bit, level in self.levels:
            word = level.words[i >> 6] >> (i & 63).astype(np.uint64)
            right = (word & np.uint64(1)).astype(bool)
            ones = level.ones(i)
            i = np.where(right, level.zeros + ones, i - ones)
            symbol |= right.astype(np.int64) << bit
        return symbol


class FMIndex:
    """Of symbols below ``n_symbols``; a smaller one is put behind the last."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        symbols, n_symbols = np.append(symbols + 1, 0), n_symbols + 1
        order = suffix_array(symbols)
        self.tree = WaveletTree(symbols[order - 1], n_symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=n_symbols))))
        self.size = len(symbols)
        sampled = (order % SAMPLE_EVERY == 0) | (order == 0)
        self.sampled = Bits(sampled)
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``phrases``, first, last + 1) of the row ranges of those that occur."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[which, step] + 1
            below, above = self.tree.ranks(symbol, low, high)
            low, high = self.first[symbol] + below, self.first[symbol] + above
            live = low < high
            which, low, high = which[live], low[live], high[live]
            if not len(which):
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows."""
        position, steps = np.zeros(len(rows), np.int64), 0
        open_rows = np.arange(len(rows))
        while len(open_rows):
            here = rows[open_rows]
            word = self.sampled.words[here >> 6] >> (here & 63).astype(np.uint64)
            known = (word & np.uint64(1)).astype(bool)
            position[open_rows[known]] = self.samples[self.sampled.ones(here[known])] + steps
            open_rows, here = open_rows[~known], here[~known]
            symbol = self.tree.access(here)
            rows[open_rows] = self.first[symbol] + self.tree.ranks(symbol, here)[0]
            steps += 1
        return position


def _occurrences(ids: np.ndarray, doc: np.ndarray, phrases: Phrases) -> Iterator[tuple]:
    """(length, index of the window, first word) arrays of all windows in the shard."""
    known = ids > 0
    edges = np.searchsorted(doc, np.unique(doc))
    starts, ends, _ = runs_of(known, np.append(edges, len(ids)))
    long = ends - starts >= min(phrases.windows)
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return
    # A 0 in front of each stretch, and one more at the end.
    at = spread(starts - 1, sizes + 1)
    heads = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = ids[np.maximum(at, 0)]
    symbols[heads] = 0
    symbols, at = np.append(symbols, 0), np.append(at, -1)
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    for size, (windows, _) in phrases.windows.items():
        which, low, high = index.search(windows)
        rows = spread(low, high - low)
        yield size, np.repeat(which, high - low), at[index.locate(rows)]


def _search(batches: Iterator[pa.RecordBatch], phrases: Phrases, schema: pa.Schema) -> Iterator:
    for batch in as_batches(batches):
        column = batch.column("text")
        words, starts, ends, doc, points = words_of(column)
        codes = pc.index_in(words, value_set=phrases.vocabulary).fill_null(-1)
        ids = codes.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        n_words = np.bincount(doc, minlength=batch.num_rows)
        change = np.zeros(len(ids) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for row, (low, high) in enumerate(zip(*_bounds(doc, batch.num_rows), strict=True)):
            for a, b in batch.column("_spans")[row].as_py() if high > low else ():
                change[low + a] += 1
                change[low + b] -= 1
        for size, which, first in _occurrences(ids, doc, phrases) if phrases.windows else ():
            np.add.at(change, first, 1)
            np.add.at(change, first + size, -1)
            names = phrases.windows[size][1]
            pairs = np.unique(doc[first] * len(names) + which) if len(first) else ()
            for pair in pairs:
                items.setdefault(int(pair // len(names)), set()).update(names[pair % len(names)])
        hit = np.cumsum(change[:-1]) > 0
        edges = np.concatenate(([0], np.cumsum(n_words)))
        span_start, span_end, span_doc = runs_of(hit, edges)
        text_start = points[np.concatenate(([0], np.cumsum(_sizes(column))))]
        spans, removed = [[] for _ in n_words], [[] for _ in n_words]
        for a, b, d in zip(span_start, span_end, span_doc, strict=True):
            spans[d].append((int(a - edges[d]), int(b - edges[d])))
            removed[d].append(
                (int(points[starts[a]] - text_start[d]), int(points[ends[b - 1]] - text_start[d]))
            )
        new = {
            "n_words": n_words,
            "n_hit": np.bincount(doc[hit], minlength=batch.num_rows),
            "_spans": spans,
            "removal": removed,
            "item_ids": [
                sorted(items.get(d, set()) | set(old.as_py()))
                for d, old in enumerate(batch.column("item_ids"))
            ],
        }
        columns = [
            pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type)
            for f in schema
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _bounds(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.searchsorted(doc, np.arange(n)), np.searchsorted(doc, np.arange(n), "right")


def _sizes(column: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(column)[1])


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Phrases]:
    items, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text")
    for item, text in rows.where("text IS NOT NULL").toLocalIterator():
        items.append((item, text))
        size += len(text.encode())
        if size >= block_bytes:
            yield Phrases(items)
            items, size = [], 0
    yield Phrases(items)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *keys: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: ``keys``, n_words, n_hit, item_ids (sorted strings) and ``removal``.

    ``removal`` holds the merged spans of hit words as code points of the text, end
    exclusive; ``_spans`` the same in words. With its text a document also keeps ``text``.
    """
    rows = texts(docs, *keys).select(
        *keys,
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.expr("CAST(array() AS array<array<long>>)").alias("_spans"),
        F.expr("CAST(array() AS array<array<long>>)").alias("removal"),
        F.expr("CAST(array() AS array<string>)").alias("item_ids"),
    )
    blocks = _blocks(benchmark, block_bytes)
    phrases = next(blocks)
    for following in blocks:
        rows = stored(rows.mapInArrow(_searcher(phrases, rows.schema), rows.schema))
        phrases = following
    out = rows.drop("text").schema
    return rows.mapInArrow(_searcher(phrases, out), out)


def _searcher(phrases: Phrases, out):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    return lambda batches: _search(batches, phrases, schema)


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def brute_force(texts_: list[str | None], items: list[tuple[object, str | None]]) -> list[tuple]:
    """(n_words, n_hit, item ids) per text, word by word; for tests."""
    import re

    def words(text: str | None) -> list[str]:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    result = []
    for own in map(words, texts_):
        hit, found = set(), set()
        for item, text in items:
            item_words = words(text)
            size = min(WINDOW, len(item_words))
            windows = {tuple(item_words[i : i + size]) for i in range(len(item_words) - size + 1)}
            for i in range(len(own) - size + 1) if size else ():
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        result.append((len(own), len(hit), sorted(found)))
    return result


def sha256(item_ids: list[str]) -> str:
    return hashlib.sha256(",".join(item_ids).encode()).hexdigest()


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are; nothing is shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("row"), F.col("text"))
    found = decontaminate(packed, benchmark, "row")
    return found.where(~is_contaminated()).select("row.*")
