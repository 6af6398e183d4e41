"""SentencePiece encoding and decoding by suffix-array matching, for BPE vocabularies.

The distinct space-led words of a batch of texts are put in a row and their suffixes sorted,
as deep as the longest piece. Every piece of the vocabulary is searched for by bisection,
letter by letter, all pieces at once; the suffixes in its range are its occurrences, each an
edge from one place of the text to a later one. The edges are sorted by the place where they
end, and relaxed in that order: an edge reaches its end if it may follow the edge that
reached its start. For merge-ordered vocabularies "may follow" is a property of the two
pieces alone (merging the pair's text gives back the pair), and exactly one edge reaches
every place, so the path to the end of a word is the encoding that merging gives. Characters
that no piece has are edges of their own and become byte pieces.

A vocabulary is read from a SentencePiece model file: byte fallback, no normalisation, a
space put in front of each text, spaces kept. Others are refused.

Rules: a NULL text counts as empty; an empty text has no ids. U+2581 reads as a space, as in
the library. Each row is encoded, repeated ones alike; other columns are not looked at.
Decoding skips control ids, and replaces bytes that are no UTF-8 by U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import as_batches, joined, per_worker, spread, text_bytes, texts

CHUNK = 2 << 20
KNOWN_WORDS = 200_000
#: Characters of new words whose suffixes are sorted at once; one longer word is by itself.
WORD_CHARS = 1 << 17
SPACE = "▁"
#: Ids of characters without a piece start here, before they become bytes.
_UNKNOWN = 1 << 21
_SEPARATOR = 0x110000


class Vocabulary:
    """Pieces, their ranks, and what decides whether one may follow another."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if not self._merged(path):
            raise ValueError("only merge-ordered (BPE) vocabularies are known")
        n = model.get_piece_size()
        self.name = f"{path}:{n}"
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [
            i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        if not any(map(model.is_byte, range(n))) or model.encode(" a  b ", out_type=str)[:1] == ["a"]:
            raise ValueError("only vocabularies with byte pieces that keep spaces are known")
        by_text = {self.pieces[i]: i for i in normal}
        score = {i: model.get_score(i) for i in normal}
        self.bytes_ = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Merged pieces in the order in which they are made; single characters come first.
        merged = sorted((i for i in normal if len(self.pieces[i]) > 1), key=lambda i: -score[i])
        self.rank = np.zeros(n, np.int64)
        self.rank[merged] = np.arange(1, len(merged) + 1)
        self.left, self.right = np.arange(n), np.arange(n)
        reachable = []
        for i in normal:
            last = self._last_merge(self.pieces[i], by_text)
            if last is not None:
                self.left[i], self.right[i] = last
                reachable.append(i)
        keys = {}
        for i in merged:
            text = self.pieces[i]
            for cut in range(1, len(text)):
                a, b = by_text.get(text[:cut]), by_text.get(text[cut:])
                if a is not None and b is not None:
                    keys[a * n + b] = self.rank[i]
        self.pair_keys = np.array(sorted(keys), np.int64)
        self.pair_ranks = np.array([keys[k] for k in sorted(keys)], np.int64)
        # Reachable pieces as rows of code points, in order of length.
        reachable.sort(key=lambda i: len(self.pieces[i]))
        self.ids = np.array(reachable, np.int64)
        self.sizes = np.array([len(self.pieces[i]) for i in reachable], np.int64)
        self.points = np.zeros((len(reachable), int(self.sizes.max())), np.int64)
        for row, i in enumerate(reachable):
            self.points[row, : self.sizes[row]] = [ord(c) for c in self.pieces[i].replace(SPACE, " ")]
        self.length_of = np.zeros(n, np.int64)
        self.length_of[self.ids] = self.sizes
        singles = {self.pieces[i].replace(SPACE, " ") for i in reachable if len(self.pieces[i]) == 1}
        self.single_points = np.array(sorted(map(ord, singles)), np.int64)
        surface = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i in range(n):
            if model.is_control(i) or model.is_unused(i):
                surface[i] = b""
            elif model.is_unknown(i):
                surface[i] = " ⁇ ".encode()
        for b, i in enumerate(self.bytes_):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.bytes_ = np.array(self.bytes_, np.int64)

    @staticmethod
    def _merged(path: str) -> bool:
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            return sentencepiece_model_pb2.ModelProto.FromString(file.read()).trainer_spec.model_type == 2

    def _last_merge(self, text: str, by_text: dict[str, int]) -> tuple[int, int] | None:
        """The two pieces that the last merge of ``text`` joins; None if merging ends before."""
        parts = list(text)
        while len(parts) > 2:
            ranked = [(self.rank[by_text[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in by_text]
            if not ranked:
                return None
            k = min(ranked)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 1:
            return by_text[text], by_text[text]
        a, b = by_text.get(parts[0]), by_text.get(parts[1])
        return None if a is None or b is None else (a, b)

    def _joined_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.pieces) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], 1 << 40)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of a and b gives a and b.

        Undo the merges, the latest first: a piece across the border would have been made
        if it comes before the merge that is undone (or with it, if it lies to the left).
        """
        result = np.ones(len(a), bool)
        open_ = np.flatnonzero((a < _UNKNOWN) & (b < _UNKNOWN))
        a, b = a[open_], b[open_]
        limit = np.full(len(open_), 1 << 30)
        while len(open_):
            crossed = self._joined_rank(a, b) < limit
            result[open_[crossed]] = False
            left_later = self.rank[a] > self.rank[b]
            go_on = ~crossed & (left_later | (self.rank[b] > 0))
            limit = np.where(left_later, self.rank[a], self.rank[b] + 1)[go_on]
            a, b = np.where(left_later, self.right[a], a)[go_on], np.where(left_later, b, self.left[b])[go_on]
            open_ = open_[go_on]
        return result


def _suffixes(points: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the suffixes, sorted by their first ``depth`` symbols."""
    n = len(points)
    _, rank = np.unique(points, return_inverse=True)
    rank, width = rank.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        width *= 2
        if width >= depth:
            return order
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))


def _ranges(points: np.ndarray, order: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, high): the suffixes that start with the piece of each row that occurs."""
    n = len(order)
    row = np.arange(len(vocabulary.ids))
    low, high = np.zeros(len(row), np.int64), np.full(len(row), n, np.int64)
    padded = np.append(points, np.full(vocabulary.points.shape[1], -1))
    done = []
    for depth in range(vocabulary.points.shape[1]):
        column = padded[order + depth] if depth < 3 else None
        wanted = vocabulary.points[row, depth]
        bounds = []
        for upper in (False, True):
            a, b = low.copy(), high.copy()
            while (a < b).any():
                middle = (a + b) >> 1
                at = np.minimum(middle, n - 1)
                value = column[at] if column is not None else padded[order[at] + depth]
                right = (value <= wanted if upper else value < wanted) & (a < b)
                a, b = np.where(right, middle + 1, a), np.where(right | (a >= b), b, middle)
            bounds.append(a)
        low, high = bounds
        live = low < high
        ended = live & (vocabulary.sizes[row] == depth + 1)
        done.append((row[ended], low[ended], high[ended]))
        live &= ~ended
        row, low, high = row[live], low[live], high[live]
        if not len(row):
            break
    return tuple(joined([d[k] for d in done]) for k in range(3))


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, number of ids of each)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer(chr(0xFFFF).join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    ends = starts + sizes
    points[ends[:-1]] = _SEPARATOR
    order = _suffixes(points, vocabulary.points.shape[1])
    row, low, high = _ranges(points, order, vocabulary)
    begin = order[spread(low, high - low)]
    piece = np.repeat(vocabulary.ids[row], high - low)
    size = np.repeat(vocabulary.sizes[row], high - low)
    inside = np.ones(len(points), bool)
    inside[ends[:-1]] = False
    at = np.searchsorted(vocabulary.single_points, points)
    at = np.minimum(at, len(vocabulary.single_points) - 1)
    unknown = np.flatnonzero(inside & (vocabulary.single_points[at] != points))
    begin = np.concatenate((begin, unknown))
    piece = np.concatenate((piece, _UNKNOWN + points[unknown]))
    size = np.concatenate((size, np.ones(len(unknown), np.int64)))
    end = begin + size
    # By distance from the start of the word: all words advance together.
    word_start = np.repeat(starts, sizes + 1)[: len(points)]
    distance = end - word_start[begin]
    # Of 16 bits, where they do, numpy sorts by radix.
    small = distance.astype(np.uint16) if len(distance) and distance.max() < 1 << 16 else distance
    sorting = np.argsort(small, kind="stable")
    begin, piece, end = begin[sorting], piece[sorting], end[sorting]
    edges = np.flatnonzero(np.diff(distance[sorting], prepend=-1))
    edges = np.append(edges, len(begin))
    reached = np.full(len(points) + 1, -1, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        before = reached[begin[a:b]]
        first = begin[a:b] == word_start[begin[a:b]]
        ok = first | (before >= 0)
        ok[ok] = np.where(first[ok], True, vocabulary.may_follow(np.maximum(before[ok], 0), piece[a:b][ok]))
        reached[end[a:b][ok]] = piece[a:b][ok]
    length = lambda p: np.where(p >= _UNKNOWN, 1, vocabulary.length_of[np.minimum(p, len(vocabulary.pieces) - 1)])
    is_end = np.zeros(len(points) + 1, bool)
    cursor, stop = ends[sizes > 0], starts[sizes > 0]
    while len(cursor):
        is_end[cursor] = True
        token = reached[cursor]
        if (token < 0).any():
            raise AssertionError("a word without an encoding")
        cursor = cursor - length(token)
        live = cursor > stop
        cursor, stop = cursor[live], stop[live]
    places = np.flatnonzero(is_end)
    tokens = reached[places]
    counts = np.bincount(np.searchsorted(ends, places), minlength=len(words))
    if (tokens >= _UNKNOWN).any():
        tokens, counts = _with_bytes(tokens, np.repeat(np.arange(len(words)), counts), len(words), vocabulary)
    return tokens, counts


def _with_bytes(tokens: np.ndarray, word: np.ndarray, n: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece as byte pieces."""
    size = np.ones(len(tokens), np.int64)
    unknown = np.flatnonzero(tokens >= _UNKNOWN)
    raw = [chr(p - _UNKNOWN).encode() for p in tokens[unknown].tolist()]
    size[unknown] = [len(r) for r in raw]
    out = np.repeat(tokens, size)
    at = spread((np.cumsum(size) - size)[unknown], size[unknown])
    out[at] = vocabulary.bytes_[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(np.repeat(word, size), minlength=n)


class Encoder:
    """Encodes batches; remembers the words it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        column = pc.replace_substring(column, SPACE, " ")
        data, offsets = text_bytes(column)
        n, size = len(offsets) - 1, np.diff(offsets)
        filled = offsets[:-1][size > 0]
        data = np.insert(data, filled, 0x20)  # the space in front of each text
        offsets = offsets + np.concatenate(([0], np.cumsum(size > 0)))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        space = data == 0x20
        split = space.copy()
        split[1:] &= ~space[:-1]
        split[offsets[:-1][size > 0]] = True
        starts = np.flatnonzero(split)
        buffers = [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        own = self._look_up(words.dictionary.cast(pa.large_string()).to_pylist())
        codes = own[words.indices.to_numpy(zero_copy_only=False)]
        first = np.cumsum(self.counts) - self.counts
        sizes = self.counts[codes]
        before = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        return self.ids[spread(first[codes], sizes)], np.diff(before[np.searchsorted(starts, offsets)])

    def _look_up(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = [w for w in words if w not in self.known]
        if new:
            # Suffixes and edges take some hundred bytes a character.
            part = np.cumsum([len(w) for w in new]) // WORD_CHARS
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=part[-1] + 1))
            made = [encode_words(new[a:b], self.vocabulary) for a, b in zip(cuts[:-1], cuts[1:])]
            for k, w in enumerate(new, len(self.known)):
                self.known[w] = k
            self.ids = np.concatenate((self.ids, *(ids.astype(np.int32) for ids, _ in made)))
            self.counts = np.concatenate((self.counts, *(counts for _, counts in made)))
        return np.fromiter((self.known[w] for w in words), np.int64, len(words))


def decode(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> pa.Array:
    """The texts of id lists that stand in a row."""
    size = vocabulary.surface_size[ids]
    data = vocabulary.surface[spread(vocabulary.surface_start[ids], size)]
    before = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=before[1:])
    offsets = before[np.concatenate(([0], np.cumsum(counts)))]
    # The space that encoding puts in front goes.
    first = offsets[:-1][np.diff(offsets) > 0]
    first = first[data[first] == 0x20]
    keep = np.ones(len(data), bool)
    keep[first] = False
    offsets = offsets - np.searchsorted(first, offsets)
    data = data[keep]
    raw = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    try:
        return raw.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([r.decode(errors="replace") for r in raw.to_pylist()], pa.large_string())


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, key: str, check: bool) -> Iterator[pa.RecordBatch]:
    encoder = per_worker(("pieces", vocabulary.name), lambda: Encoder(vocabulary))
    for batch in as_batches(batches, size=CHUNK):
        column = batch.column("text")
        ids, counts = encoder.encode(column)
        columns, names = [batch.column(key), pa.array(counts), _lists(ids, counts)], [key, "n_tokens", "ids"]
        if check:
            text = decode(ids, counts, vocabulary)
            same = pc.equal(text, pc.replace_substring(column, SPACE, " ").cast(pa.large_string()))
            columns, names = [*columns, same], [*names, "round_trip"]
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", check: bool = False) -> DataFrame:
    """``key``, n_tokens and ids of every row; with ``check``, whether decoding gives the text back."""
    rows = texts(docs, key)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, n_tokens long, ids array<int>"
    schema += ", round_trip boolean" if check else ""
    return rows.mapInArrow(lambda b: _encode(b, vocabulary, key, check), schema)


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids").fill_null([])
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        text = decode(ids, counts, vocabulary)
        yield pa.RecordBatch.from_arrays([batch.column(key), text.cast(pa.string())], [key, "text"])


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key`` and text of every row of ids."""
    rows = encoded.select(key, "ids")
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, text string"
    return rows.mapInArrow(lambda b: _decode(b, vocabulary, key), schema)
