"""Token-id files in Simple-8b: 64-bit words of which 4 bits select how many ids follow.

A file holds the ids of consecutive documents. Ids are packed in blocks of ``BLOCK`` ids,
each of which starts with a new word, and the word offset of every block is stored: any
block is read by itself, and all blocks of a file at once. An id of more than 60 bits is
escaped: selector 0, then the id as a word of its own.

File layout (little endian): magic, version, then the numbers of ids, words, blocks and
documents, each 8 bytes; the words; the blocks' word offsets; the documents' ids, 8 bytes
each; a byte per document that says whether its id is known; the documents' first
positions. Files end after ``FILE_IDS`` ids, at a document's end.

Tasks write and read files through pyarrow's file systems, so the folder has to be in a store
that these know by its URI: ``file``, ``hdfs``, ``s3``, ``gs``; not ``s3a``, ``abfss``.

Rules: documents come in ascending id, NULL first, equal ids in the order of their texts'
hashes; a NULL text is empty and has the end id only. Every row of the input is a document,
also repeated ones. A text that holds the tokenizer's special token gets its id, as the
library does. Other columns are not looked at. An empty table gives no file and no row.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_batches, joined, per_worker, shared_folder, spread, stored, text_bytes, texts

# Fixed values of Simple-8b: ids per word by selector, and bits of each.
COUNTS = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120])
BITS = np.array([64, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])

BLOCK = 128
FILE_IDS = 1 << 21
KNOWN_PIECES = 300_000
CHUNK = 4 << 20  # the more text at once, the fewer pieces to look up
PACK_IDS = 1 << 17  # ids worked on at once, whole blocks
END_ID = 2
MAGIC, VERSION = 0x4238_504D_4953, 1


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    smeared = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        smeared |= smeared >> np.uint64(shift)
    return np.bitwise_count(smeared).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block) of unsigned values."""
    parts = [_pack(values[i : i + PACK_IDS]) for i in range(0, len(values), PACK_IDS)]
    sizes = np.array([len(words) for words, _ in parts], np.uint64)
    before = np.cumsum(sizes) - sizes
    offsets = [o + b for (_, o), b in zip(parts, before, strict=True)]
    return joined([words for words, _ in parts], np.uint64), joined(offsets, np.uint64)


def _pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = values.astype(np.uint64)
    n = len(values)
    # Bits of the widest of the next c values, from two shorter windows; the end is padded.
    widest = {1: np.zeros(n + COUNTS[-1], np.uint8)}
    widest[1][:n] = _bit_lengths(values)
    for count in COUNTS[2:]:
        shorter = max(c for c in widest if c >= (count + 1) // 2)
        low, shift = widest[shorter], count - shorter
        widest[count] = np.maximum(low[: len(low) - shift], low[shift:])
    best = np.zeros(n, np.uint8)
    for s in range(1, 16):  # from few values to many
        best[widest[COUNTS[s]][:n] <= BITS[s]] = s
    cursor = np.arange(0, n, BLOCK, dtype=np.int64)
    limit = np.minimum(cursor + BLOCK, n)
    starts, selectors = [], []
    while len(cursor):
        # Where fewer values are left than fit, as many as are left.
        most = np.searchsorted(COUNTS, limit - cursor, "right") - 1
        chosen = np.minimum(best[cursor].astype(np.int64), most)
        starts.append(cursor)
        selectors.append(chosen)
        cursor = cursor + COUNTS[chosen]
        live = cursor < limit
        cursor, limit = cursor[live], limit[live]
    start, selector = joined(starts), joined(selectors)
    order = np.argsort(start)
    start, selector = start[order], selector[order]
    size = 1 + (selector == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(selector):
        own = selector == s
        if s == 0:
            words[place[own] + 1] = values[start[own]]
            continue
        word = np.full(int(own.sum()), np.uint64(s) << np.uint64(60), np.uint64)
        for k in range(COUNTS[s] if BITS[s] else 0):
            word |= values[start[own] + k] << np.uint64(k * BITS[s])
        words[place[own]] = word
    return words, place[np.searchsorted(start, np.arange(0, n, BLOCK))].astype(np.uint64)


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    literal = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == 0):  # escapes only
        if not literal[at]:
            literal[at + 1] = True
    count = np.where(literal, 0, COUNTS[selector])
    first = np.cumsum(count) - count
    values = np.zeros(n, np.uint64)
    for s in np.unique(selector[~literal]):
        own = np.flatnonzero((selector == s) & ~literal)
        if s == 0:
            values[first[own]] = words[own + 1]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s] if BITS[s] else 0):
            values[first[own] + k] = (words[own] >> np.uint64(k * BITS[s])) & mask
    return values


def unpack_blocks(words: np.ndarray, offsets: np.ndarray, n: int, low: int, high: int) -> np.ndarray:
    """Values of the blocks low to high, from their words alone."""
    if low >= high:
        return np.zeros(0, np.uint64)
    end = int(offsets[high]) if high < len(offsets) else len(words)
    return unpack(words[int(offsets[low]) : end], min(n, high * BLOCK) - low * BLOCK)


def to_file(ids: np.ndarray, doc_ids: list, starts: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], np.int64)
    head = np.array([MAGIC, VERSION, len(ids), len(words), len(offsets), len(keys)], np.uint64)
    parts = (head, words, offsets, keys, known, starts.astype(np.uint64))
    return b"".join(part.tobytes() for part in parts)


def from_file(data: bytes) -> tuple[np.ndarray, list, np.ndarray]:
    """(ids, document ids, first positions) of a file."""
    magic, version, n, n_words, n_blocks, n_docs = (int(x) for x in np.frombuffer(data, np.uint64, 6))
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a token file of this version")
    at, parts = 48, []
    for dtype, count in (
        (np.uint64, n_words), (np.uint64, n_blocks), (np.int64, n_docs), (np.uint8, n_docs), (np.uint64, n_docs),
    ):
        parts.append(np.frombuffer(data, dtype, count, at))
        at += parts[-1].nbytes
    words, offsets, keys, known, starts = parts
    ids = unpack_blocks(words, offsets, n, 0, n_blocks)
    return ids, [int(k) if ok else None for k, ok in zip(keys, known, strict=True)], starts.astype(np.int64)


class Encoder:
    """Ids of many texts at once: each distinct piece of text is encoded once.

    A pretoken always starts at a space in front of anything but white space, and behind an
    ASCII letter in front of another ASCII character; what it is depends on nothing in front
    of it. So a text's ids are those of its pieces between such places.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        letters = _byte_letters()
        special = {k: v.content for k, v in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = [s.encode() for s in special.values()]
        self.token_bytes = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(special[i].encode()) if i in special else sum(c in letters for c in token)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        data, offsets = text_bytes(column)
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        splits = np.zeros(len(data), bool)
        splits[:-1] = (data[:-1] == 0x20) & _PLAIN[data[1:]]
        splits[1:] |= _LETTER[data[:-1]] & ~_LETTER[data[1:]] & (data[1:] < 0x80)
        self._join_special(data, splits)
        last = offsets[1:-1]
        last = last[(last > 0) & (last <= len(data))] - 1
        splits[last] &= _LETTER[data[np.maximum(last - 1, 0)]]  # not by a text's last space
        splits[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(splits)
        buffers = [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        own = self._look_up(pieces.dictionary.cast(pa.large_string()).to_pylist())
        codes = own[pieces.indices.to_numpy(zero_copy_only=False)]
        first = np.cumsum(self.counts) - self.counts
        sizes = self.counts[codes]
        per_text = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=per_text[1:])
        edges = per_text[np.searchsorted(starts, offsets)]
        return self.ids[spread(first[codes], sizes)], np.diff(edges)

    def _join_special(self, data: np.ndarray, splits: np.ndarray) -> None:
        """Special tokens stay in one piece."""
        raw = data.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                splits[at + 1 : at + len(token)] = False
                at = raw.find(token, at + 1)

    def _look_up(self, pieces: list[str]) -> np.ndarray:
        """Index of each piece among the known ones, after encoding the others."""
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        new = [p for p in pieces if p not in self.known]
        # A piece without a space is a sequence of its own: what it is put behind could end in it.
        spaced = [p for p in new if p[0] == " " and p != " "]
        alone = [p for p in new if p[0] != " " or p == " "]
        if spaced:
            self._add(spaced, ["".join(spaced[i : i + 512]) for i in range(0, len(spaced), 512)])
        if alone:
            self._add(alone, alone)
        return np.fromiter((self.known[p] for p in pieces), np.int64, len(pieces))

    def _add(self, pieces: list[str], sequences: list[str]) -> None:
        ids = []
        for i in range(0, len(sequences), 64):  # an encoding holds much more than its ids
            encoded = self.tokenizer.encode_batch_fast(sequences[i : i + 64], add_special_tokens=False)
            ids.extend(np.array(e.ids, np.int32) for e in encoded)
        ids = joined(ids, np.int32)
        lengths = np.fromiter((len(p.encode()) for p in pieces), np.int64, len(pieces))
        ends = np.cumsum(self.token_bytes[ids])
        edges = np.searchsorted(ends, np.cumsum(lengths), "right")
        if len(ids) != edges[-1] or ends[-1] != lengths.sum():
            raise ValueError("the tokenizer's tokens do not cover the text")
        for k, p in enumerate(pieces, len(self.known)):
            self.known[p] = k
        self.ids = np.concatenate((self.ids, ids))
        self.counts = np.concatenate((self.counts, np.diff(np.concatenate(([0], edges)))))


#: Bytes that start no white space: ASCII but for blanks, and leads of code points without any.
_PLAIN = np.ones(256, bool)
_PLAIN[:0x21] = _PLAIN[0x7F:0xC3] = False
_PLAIN[0xE1:0xE4] = False
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def _byte_letters() -> set[str]:
    """The letters that byte-level vocabularies write bytes with."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b) for b in own} | {chr(256 + i) for i in range(256 - len(own))}


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    files, root = fs.FileSystem.from_uri(folder)
    encode, number = per_worker(("token files", tokenizer), lambda: Encoder(tokenizer)).encode, 0
    ids, keys, sizes = [], [], []

    def flush() -> pa.RecordBatch:
        nonlocal number
        starts = np.cumsum(sizes) - sizes
        name = f"{root}/part-{part:06d}-{number:06d}.s8b"
        own = f"{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(own) as out:
            out.write(to_file(joined(ids), keys, starts))
        files.move(own, name)  # a file has its name once it is whole; a repeated task's is the same
        row = [part, number, name.rsplit("/", 1)[-1], int(sum(sizes)), len(keys)]
        number += 1
        for kept in (ids, keys, sizes):
            kept.clear()
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["part", "number", "file", "n_ids", "n_docs"])

    for batch in as_batches(batches, size=CHUNK):
        own, counts = encode(batch.column("text"))
        own = np.insert(own, np.cumsum(counts), END_ID)
        ids.append(own)
        keys.extend(batch.column("doc_id").to_pylist())
        sizes.extend((counts + 1).tolist())
        if sum(map(len, ids)) >= FILE_IDS:
            yield flush()
    if keys:
        yield flush()


def write_tokens(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write the files; returns their list: part, number, file, n_ids, n_docs."""
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    ordered = (
        texts(docs, "doc_id")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    schema = "part long, number long, file string, n_ids long, n_docs long"
    listed = ordered.mapInArrow(lambda b: _write(b, folder, tokenizer), schema)
    return stored(listed)


def with_starts(listed: DataFrame) -> DataFrame:
    """The files with ``base``: ids in all files before. One row per part meets in one task."""
    parts = listed.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    return listed.withColumn("own", own).join(before, "part").withColumn("base", F.col("before") + F.col("own"))


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with files.open_input_file(f"{root}/{name}") as stream:
                ids, keys, starts = from_file(stream.read())
            raw = ids.astype("<u4")
            ends = np.append(starts[1:], len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(base + starts),
                    pa.array(ends - starts),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(listed: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the checksum of its ids."""
    # A number of its own, as a list of files is small whatever the files are.
    n = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_starts(listed).select("file", "base").repartition(n, "file")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return rows.mapInArrow(lambda b: _read(b, folder), schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder = shared_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, tokenizer, folder), folder)
