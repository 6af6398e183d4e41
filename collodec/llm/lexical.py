"""Ranked lexical search: an index in shards, searched by Block-Max MaxScore.

A shard holds about ``SHARD_BYTES`` of text as one row of a table: its terms with their
lists, a list in blocks of ``BLOCK`` documents, a block as gaps and frequencies of 1, 2 or 4
bytes, and beside it its last document, its highest frequency and the least length of its
documents. From these two follows the highest score that a block can give, whatever the
corpus' counts turn out to be: the index is built in one pass, and shards can be added later.

Items are searched in blocks of bounded size. One pass over the lists' heads gives each term's
document count; then every task takes its shards one after the other, with a heap per item:

* lists are added from the highest bound (weight by highest block score) down, until the
  bounds of the others together are below the heap's least score, or that of the k best sums
  so far. These others are not essential: who is in no other list cannot get in.
* a candidate whose sum and the remaining bounds do not reach that score is rejected; then one
  for which the maximum of its block in the next list is too little, before that block is
  decompressed.

A document with the heap's least score may still get in by its id, so only less is rejected.
Tasks give their heaps, k rows an item, and the best of all follow by a window.

Terms are known by 64-bit hashes of their bytes: for an item's term to be taken for another of
10^9 terms of a corpus has a chance of 10^-10.

Rules: NULL and empty texts have no terms, and count in nothing. Every row is a document, and
every row of the items an item, also repeated ones; a NULL id sorts first. Of no documents or
no items the result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_batches, joined, lengths, runs_of, shared_folder, slice_hashes, spread, stored, text_bytes, texts

SHARD_BYTES = 16 << 20
BLOCK = 128
#: Bytes of items' texts searched for in one pass.
ITEM_BYTES = 1 << 20
BEST = 50

_TERM = np.zeros(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM[_low:_high] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, index of its text)."""
    data, offsets = text_bytes(column)
    starts, ends, text = runs_of(_TERM[data], offsets)
    return slice_hashes(_LOWER[data], starts, ends), text


def length_parts(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m, of its number of terms."""
    return 50 + (50 * n.astype(np.int64) * n_docs) // max(n_terms, 1)


def frequency_parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


_COLUMNS = {
    "n": np.int32, "terms": np.uint64, "df": np.int32, "last": np.int32, "max_tf": np.int32, "min_n": np.int32,
    "at": np.int64, "widths": np.uint8, "payload": np.uint8,
}
_HEADS = ["terms", "df", "max_tf", "min_n"]


def _widths(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


class Shard:
    """Lists of some documents, numbered from 0."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)
        blocks = -(-self.df.astype(np.int64) // BLOCK)
        self.first = np.concatenate(([0], np.cumsum(blocks)))

    @classmethod
    def pack(cls, hashes: np.ndarray, docs: np.ndarray, n: np.ndarray) -> Shard:
        """Of every term its hash and document, documents in order."""
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], docs[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(hashes)))
        hashes, docs = hashes[at], docs[at].astype(np.int64)
        count = len(docs)
        lists = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:count])
        df = np.diff(np.append(lists, count))
        begins = np.flatnonzero((np.arange(count) - np.repeat(lists, df)) % BLOCK == 0)
        counts = np.diff(np.append(begins, count))
        before = np.append(-1, docs[:-1])[:count]
        before[lists] = -1
        gaps = docs - before - 1
        reduced = (lambda f, x: f.reduceat(x, begins)) if count else (lambda f, x: np.zeros(0, np.int64))
        max_tf, wide = reduced(np.maximum, tf), _widths(reduced(np.maximum, gaps))
        tall = _widths(max_tf)
        size = counts * (wide + tall)
        start = np.cumsum(size) - size
        payload = np.zeros(int(size.sum()), np.uint8)
        for values, width, place in ((gaps, wide, start), (tf, tall, start + counts * wide)):
            for w in (1, 2, 4):
                own = np.flatnonzero(width == w)
                chosen = values[spread(begins[own], counts[own])].astype(f"<u{w}")
                payload[spread(place[own], counts[own] * w)] = chosen.view(np.uint8)
        return cls(
            n=n.astype(np.int32), terms=hashes[lists], df=df.astype(np.int32), last=docs[begins + counts - 1].astype(np.int32),
            max_tf=max_tf.astype(np.int32), min_n=reduced(np.minimum, n[docs]).astype(np.int32), at=start,
            widths=(wide * 8 + tall).astype(np.uint8), payload=payload,
        )

    def counts(self, blocks: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Documents of the blocks, given the list of each."""
        return np.minimum(BLOCK, self.df[own] - BLOCK * (blocks - self.first[own]))

    def decode(self, blocks: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, frequencies) of blocks of one list, in order."""
        if len(blocks) == 1:
            return self._block(int(blocks[0]), own)
        counts = self.counts(blocks, own)
        starts = np.cumsum(counts) - counts
        out = []
        widths = self.widths[blocks].astype(np.int64)
        for width, place in ((widths // 8, self.at[blocks]), (widths % 8, self.at[blocks] + counts * (widths // 8))):
            values = np.zeros(int(counts.sum()), np.int64)
            for w in np.unique(width).tolist():
                some = np.flatnonzero(width == w)
                raw = self.payload[spread(place[some], counts[some] * w)]
                values[spread(starts[some], counts[some])] = raw.view(f"<u{w}")
            out.append(values)
        gaps, tf = out
        before = np.where(blocks == self.first[own], -1, self.last[blocks - 1])
        docs = np.cumsum(gaps + 1)
        docs += np.repeat(before - (docs[starts] - gaps[starts] - 1), counts)
        return docs, tf


    def _block(self, block: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        at, nth = int(self.at[block]), block - int(self.first[own])
        n = min(BLOCK, int(self.df[own]) - BLOCK * nth)
        wide, tall = divmod(int(self.widths[block]), 8)
        middle = at + n * wide
        docs = np.cumsum(self.payload[at:middle].view(f"<u{wide}"), dtype=np.int64)
        docs += np.arange(int(self.last[block - 1]) + 1 if nth else 0, n + (int(self.last[block - 1]) + 1 if nth else 0))
        return docs, self.payload[middle : middle + n * tall].view(f"<u{tall}")


def _index(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    held: list[tuple[pa.Array, np.ndarray, np.ndarray, int]] = []
    size = 0
    for batch in as_batches(batches, size=SHARD_BYTES // 16):
        hashes, text = terms_of(batch.column("text"))
        held.append((batch.column(key), hashes, text, batch.num_rows))
        size += int(lengths(batch.column("text")).sum())
        if size >= SHARD_BYTES:
            yield _as_row(held)
            held, size = [], 0
    if held:
        yield _as_row(held)


def _as_row(held: list[tuple[pa.Array, np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    before = np.cumsum([0, *[h[3] for h in held]])
    docs = joined([h[2] + b for h, b in zip(held, before)])
    n = np.bincount(docs, minlength=int(before[-1]))
    shard = Shard.pack(joined([h[1] for h in held], np.uint64), docs, n)
    ids = pa.concat_arrays([h[0] for h in held])
    columns = {
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "n_docs": pa.array([int((n > 0).sum())], pa.int64()),
        "n_terms": pa.array([int(n.sum())], pa.int64()),
        **{c: pa.array([getattr(shard, c).astype(t).tobytes()], pa.binary()) for c, t in _COLUMNS.items()},
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def build_index(docs: DataFrame, key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """The index of every row's text, a stored table of one row per shard."""
    rows = texts(docs, key)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"ids array<{kind}>, n_docs long, n_terms long, " + ", ".join(f"{c} binary" for c in _COLUMNS)
    return stored(rows.mapInArrow(lambda b: _index(b, key), schema), folder)


def _arrays(batch: pa.RecordBatch, k: int, columns: Sequence[str]) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(batch.column(c)[k].as_buffer(), _COLUMNS[c]) for c in columns}


def _found(terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted hash among sorted ones, -1 for none."""
    if not len(terms):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return np.where(terms[at] == wanted, at, -1)


def _document_counts(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(wanted), np.int64)
    for batch in batches:
        for k in range(batch.num_rows):
            heads = _arrays(batch, k, ["terms", "df"])
            at = _found(heads["terms"], wanted)
            total[at >= 0] += heads["df"][at[at >= 0]]
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])


class Heap:
    """The best documents of an item so far: highest score, then smallest id, NULL first."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), []

    @property
    def least(self) -> int:
        """A document below this does not get in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        scores, ids = np.concatenate((self.scores, scores)), [*self.ids, *ids]
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is not None, ids[i] if ids[i] is not None else 0))
        order = order[: self.k]
        self.scores, self.ids = scores[order], [ids[i] for i in order]


class Searcher:
    """Searches one shard after the other; counts the blocks that it decompresses."""

    def __init__(self, wanted: np.ndarray, weights: np.ndarray, items: list[np.ndarray], n_docs: int, n_terms: int, k: int):
        self.wanted, self.weights, self.items = wanted, weights, items
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k
        self.heaps = [Heap(k) for _ in items]
        self.blocks_read = self.blocks_met = 0

    def search(self, shard: Shard, ids: pa.Array) -> None:
        place = _found(shard.terms, self.wanted)
        m = length_parts(shard.n, self.n_docs, self.n_terms)
        tops: dict[int, tuple[np.ndarray, int]] = {}
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        terms = np.flatnonzero((place >= 0) & (self.weights > 0))
        first = shard.first[place[terms]]
        blocks = shard.first[place[terms] + 1] - first
        heads = spread(first, blocks)
        least = length_parts(shard.min_n[heads], self.n_docs, self.n_terms)
        top = np.repeat(self.weights[terms], blocks) * frequency_parts(shard.max_tf[heads], least)
        cuts = np.concatenate(([0], np.cumsum(blocks))).tolist()
        for term, a, b in zip(terms.tolist(), cuts[:-1], cuts[1:], strict=True):
            tops[term] = top[a:b], int(top[a:b].max())
        for item, heap in zip(self.items, self.heaps, strict=True):
            self._search_item(shard, ids, m, place, tops, lists, item, heap)

    def _decoded(self, shard: Shard, blocks: np.ndarray, term: int, own: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.blocks_read += len(blocks)
        docs, tf = shard.decode(blocks, own)
        return docs, self.weights[term] * frequency_parts(tf, m[docs])

    def _search_item(self, shard, ids, m, place, tops, lists, item, heap) -> None:
        own = sorted((t for t in item.tolist() if t in tops), key=lambda t: -tops[t][1])
        if not own:
            return
        bounds = np.array([tops[t][1] for t in own])
        rest = np.append(np.cumsum(bounds[::-1])[::-1], 0)
        self.blocks_met += sum(len(tops[t][0]) for t in own)
        least, sums, j = heap.least, np.zeros(len(m), np.int64), 0
        # Essential lists: their documents may get in by them alone.
        while j < len(own) and rest[j] >= least:
            term = own[j]
            if term not in lists:
                blocks = np.arange(shard.first[place[term]], shard.first[place[term] + 1])
                lists[term] = self._decoded(shard, blocks, term, place[term], m)
            docs, scores = lists[term]
            sums[docs] += scores
            j += 1
            if len(sums) > self.k:
                least = max(least, int(np.partition(sums, -self.k)[-self.k]))
        candidates = np.flatnonzero(sums)
        for j in range(j, len(own)):
            candidates = candidates[sums[candidates] + rest[j] >= least]
            if not len(candidates):
                return
            term = own[j]
            first, top = int(shard.first[place[term]]), tops[term][0]
            block = np.searchsorted(shard.last[first : first + len(top)], candidates)
            inside = block < len(top)
            most = np.where(inside, top[np.minimum(block, len(top) - 1)], 0)
            keep = sums[candidates] + most + rest[j + 1] >= least
            candidates, block = candidates[keep], block[keep & inside]
            if len(block):
                docs, scores = self._decoded(shard, np.unique(block) + first, term, place[term], m)
                at = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
                hit = docs[at] == candidates
                sums[candidates[hit]] += scores[at[hit]]
        candidates = candidates[sums[candidates] >= least]
        if len(candidates) > self.k:
            # Ties with the k-th stay: their ids decide.
            candidates = candidates[sums[candidates] >= np.partition(sums[candidates], -self.k)[-self.k]]
        heap.add(sums[candidates], ids.take(pa.array(candidates)).to_pylist())


def _searched(
    batches: Iterator[pa.RecordBatch], make: Searcher, numbers: list[int], kind: pa.DataType
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            make.search(Shard(**_arrays(batch, k, list(_COLUMNS))), batch.column("ids")[k].values)
    number = [i for i, heap in zip(numbers, make.heaps, strict=True) for _ in heap.ids]
    found = [x for heap in make.heaps for x in heap.ids]
    scores = joined([heap.scores for heap in make.heaps])
    yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(found, kind), pa.array(scores)], ["item", "doc", "score"])


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items as (number, text), in blocks of bounded size; the driver has one at a time."""
    block: list[tuple[int, str]] = []
    size = 0
    for row in items.toLocalIterator():
        block.append((row["item"], row["text"] or ""))
        size += len(block[-1][1].encode())
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: DataFrame, items: DataFrame, item_key: str = "item_id", doc_key: str = "doc_id", k: int = BEST) -> DataFrame:
    """The ``k`` best documents of every row of ``items``: item_key, rank, doc_key, score."""
    spark = index.sparkSession
    counts = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = counts[0] or 0, counts[1] or 0
    kind = index.schema["ids"].dataType.elementType
    numbered = stored(texts(items, item_key).withColumn("item", F.monotonically_increasing_id()))
    found = "item long, doc " + kind.simpleString() + ", score long"
    parts = []
    for block in _item_blocks(numbered):
        hashes, owner = terms_of(pa.array([t for _, t in block], pa.large_string()))
        wanted, code = np.unique(hashes, return_inverse=True)
        heads = index.select("terms", "df")
        totals = heads.mapInArrow(lambda b, w=wanted: _document_counts(b, w), "term long, df long")
        df = np.zeros(len(wanted), np.int64)
        for row in totals.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
            df[row["term"]] = row["df"]
        weights = np.array([weight(d, n_docs) if d else 0 for d in df.tolist()], np.int64)
        own = [np.unique(code[owner == i]) for i in range(len(block))]
        make = Searcher(wanted, weights, own, n_docs, n_terms, k)
        numbers = [i for i, _ in block]
        arrow = pa.from_numpy_dtype(np.int64) if kind.simpleString() == "bigint" else None
        best = index.mapInArrow(lambda b, m=make, n=numbers, a=arrow: _searched(b, m, n, a), found)
        parts.append(stored(best, shared_folder(spark)))
    best = spark.createDataFrame([], found) if not parts else parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = numbered.select("item", item_key).join(ranked, "item")
    return named.select(item_key, "rank", F.col("doc").alias(doc_key), "score")


def search_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's rows: all documents indexed, every benchmark item searched for."""
    return search(build_index(docs), items)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{LETTERS.upper()}', '{LETTERS}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{LETTERS.upper()}', '{LETTERS}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf SEMI JOIN asked USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, total),
m AS (SELECT doc_id, 50 + (50 * n * n_docs) // n_terms AS m FROM n, total),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {BEST}
"""
