"""Exact removal of repeated passages by a distributed merge sort of suffixes.

A passage of ``LENGTH`` bytes that starts in a document with a smaller id is removed. Of all
suffixes only those are sorted that start at an anchor: of the ``GRAM``-byte strings in each
window of ``LENGTH`` bytes the one with the least hash, the leftmost of several. The anchor
and its place in the window follow from the window's bytes alone, so equal windows have
equal anchors, and whatever occurs twice is found among the suffixes of one anchor string.

1. The hashes of all anchors are exchanged, packed; those that more than one document has
   make a bit map of fixed size. Other anchors cannot be part of a repetition.
2. Each task sorts the suffixes at the anchors that are left, some MB at a time, each with the
   bytes in front that its windows need (nearest first), and writes them as one run for each
   shard: equal ones once, with the smallest document id; of each only the bytes behind what
   it shares with the one before. Shards are named by the anchor's hash; there is one for some
   MB of text, however many partitions Spark makes of them. Runs are exchanged by the anchor's hash and merged by a loser tree that keeps, for
   each loser, how much it shares with the winner: known prefixes are not compared again.
   Where suffixes of one anchor differ, their windows are compared by hash.
3. Back with its group, each occurrence is compared with the smallest id that has each of its
   windows. Documents from which something goes get their spans by a join.

A passage in a third of all documents is one suffix per run in the exchange.

Rules: a NULL text is empty. Equal ids are not smaller than each other. Rows without an id
neither lose bytes nor take any. Each row gets a row, repeated ones alike. Other columns are
not looked at. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import BitMap, bit_map
from .common import _BYTES, _MIX, _powers, as_batches, joined, mixed, slice_hashes, spread, stored, text_bytes, texts

LENGTH = 50
GRAM = 20
#: Bytes of text whose suffixes are sorted at once; each step needs some twenty arrays of it.
CHUNK = (1 << 20) - 1
#: Bytes of suffixes that a task sorts to one run for each shard.
RUN_BYTES = 16 << 20
#: Names of anchors that a task sorts at once.
NAMES = 2 << 20
#: Bytes of text for each shard; a shard is merged in memory.
SHARD_BYTES = 4 << 20
#: Bytes of the hash that name an anchor in step 1, without those that choose the shard.
_NAME = np.uint64(0xFFFFFFFF)


_GRAM_TAG = np.uint64(GRAM * int(_MIX[0]) % (1 << 64))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, last window, hash of the anchor) of each run of windows."""
    n = len(data)
    nothing = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if n < LENGTH:
        return nothing
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=total[1:])
    grams = mixed((total[GRAM:] - total[: n - GRAM + 1]) * down[: n - GRAM + 1] + _GRAM_TAG)
    # The least of a window by doubling; the place in the low half makes it the leftmost.
    least = (grams & ~_NAME) | np.arange(len(grams), dtype=np.uint64)
    width, window = 1, LENGTH - GRAM + 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[: width - window], least[window - width :])
    start = [np.arange(a, b - LENGTH + 1) for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b - a >= LENGTH]
    if not start:
        return nothing
    text = np.flatnonzero(np.diff(offsets) >= LENGTH)
    text = np.repeat(text, [len(s) for s in start])
    start = np.concatenate(start)
    anchor = (least[start] & _NAME).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return text[first], anchor[first], start[first], start[last], grams[anchor[first]]


def _name(grams: np.ndarray, shard_bits: int) -> np.ndarray:
    # Mixed again, as the anchors are the grams whose own top bits are least.
    return mixed(grams) >> np.uint64(32 - shard_bits)


def _split(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, first, last + 1) of sorted names."""
    shard = (values >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(shard)), strict=True):
        yield int(shard[a]), int(a), int(b)


def _anchor_names(batches: Iterator[pa.RecordBatch], shard_bits: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Names of anchors by shard: of each ``NAMES`` of them once, or twice if several documents have them."""
    held: list[np.ndarray] = []
    for batch in as_batches(batches, size=CHUNK):
        data, offsets = text_bytes(batch.column("text"))
        text, _, _, _, grams = anchors(data, offsets)
        name = _name(grams, shard_bits)
        order = np.lexsort((text, name))
        name, text = name[order], text[order]
        keep = np.ones(len(name), bool)
        keep[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
        held.append(_at_most_twice(name[keep]))
        if sum(map(len, held)) >= NAMES:
            yield _names_by_shard(held, parts)
            held = []
    if any(map(len, held)):
        yield _names_by_shard(held, parts)


def _at_most_twice(names: np.ndarray) -> np.ndarray:
    keep = np.ones(len(names), bool)
    keep[2:] = names[2:] != names[:-2]
    return names[keep]


def _names_by_shard(held: list[np.ndarray], parts: int) -> pa.RecordBatch:
    # Texts of different chunks are different, so one name of each tells of two documents.
    name = _at_most_twice(np.sort(np.concatenate(held)))
    shards = list(_split(name))
    low = (name & _NAME).astype(np.uint32)
    values = [low[a:b].tobytes() for _, a, b in shards]
    shard = np.array([s for s, _, _ in shards])
    columns = [pa.array((shard % parts).astype(np.int32)), pa.array(shard), pa.array(values, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["to", "shard", "names"])


def _by_shard(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of each key, of batches that are sorted by it."""
    held, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        edges = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip(np.append(0, edges), np.append(edges, len(keys)), strict=True):
            if held is not None and keys[a] != held:
                yield held, rows
                rows = []
            held = int(keys[a])
            rows.append(batch.slice(a, b - a))
    if held is not None:
        yield held, rows


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, rows in _by_shard(batches, "shard"):
        names = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for r in rows for x in r.column("names")])
        names.sort()
        twice = np.unique(names[1:][names[1:] == names[:-1]]).astype(np.int64) | (shard << 32)
        yield pa.RecordBatch.from_arrays([pa.array(twice)], ["name"])


def _front_coded(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(bytes shared with the one before, bytes behind, those bytes) of sorted strings."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    padded = np.zeros((len(keys), int(size.max()) + 1), np.uint8)
    flat = np.frombuffer(b"".join(keys), np.uint8)
    rows = np.repeat(np.arange(len(keys)), size)
    padded[rows, spread(np.zeros(len(keys), np.int64), size)] = flat
    same = np.zeros(len(keys), np.int64)
    differ = padded[1:] != padded[:-1]
    same[1:] = np.where(differ.any(1), differ.argmax(1), padded.shape[1])
    same[1:] = np.minimum(same[1:], np.minimum(size[1:], size[:-1]))
    ends = np.cumsum(size)
    behind = flat[spread(ends - size + same, size - same)]
    return same.astype(np.uint8), (size - same).astype(np.uint8), behind.tobytes()


def _runs(batches: Iterator[pa.RecordBatch], repeated: BitMap, shard_bits: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Per ``RUN_BYTES`` of suffixes, a group: for each shard a run (kind 1); one row (kind 0) of
    where the suffixes occur and of the texts that have them.

    A suffix is written from its anchor to the end of its last window, then the bytes in
    front of the anchor, nearest first, then the number of bytes from the anchor on.
    """
    part, number = TaskContext.get().partitionId(), 0
    group = _Group()
    for batch in as_batches(batches, size=CHUNK):
        data, offsets = text_bytes(batch.column("text"))
        text, anchor, first, last, grams = anchors(data, offsets)
        name = _name(grams, shard_bits)
        own = np.flatnonzero(repeated.of(name)) if len(name) else np.zeros(0, np.int64)
        if not len(own):
            continue
        text, anchor, first, last, name = (x[own] for x in (text, anchor, first, last, name))
        raw, back = data.tobytes(), data[::-1].tobytes()
        n = len(raw)
        keys = [
            raw[a : e + LENGTH] + back[n - a : n - f] + bytes((e + LENGTH - a,))
            for a, f, e in zip(anchor.tolist(), first.tolist(), last.tolist(), strict=True)
        ]
        used, which = np.unique(text, return_inverse=True)
        ids, text_hash = (batch.column(c).to_numpy()[used] for c in ("doc_id", "h"))
        group.add(keys, name >> np.uint64(32), which, first - offsets[text], last - first + 1, ids, text_hash)
        if group.size >= RUN_BYTES:
            yield group.rows((part << 32) | number, (part + number) % parts, parts)
            group, number = _Group(), number + 1
    if group.size:
        yield group.rows((part << 32) | number, (part + number) % parts, parts)


class _Group:
    """Suffixes of some chunks, until they are sorted."""

    def __init__(self):
        self.keys: list[bytes] = []
        self.size = self.n_texts = 0
        self.columns: list[list[np.ndarray]] = [[] for _ in range(6)]

    def add(self, keys, shard, text, place, n_windows, ids, hashes) -> None:
        self.keys += keys
        self.size += sum(map(len, keys))
        for column, x in zip(self.columns, (shard, text + self.n_texts, place, n_windows, ids, hashes), strict=True):
            column.append(x)
        self.n_texts += len(ids)

    def rows(self, name: int, home: int, parts: int) -> pa.RecordBatch:
        shard, text, place, n_windows, ids, hashes = map(np.concatenate, self.columns)
        shard = shard.astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
        out, index = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            strings = [self.keys[i] for i in order[a:b].tolist()]
            by_key = sorted(range(b - a), key=strings.__getitem__)
            order[a:b] = rows = order[a:b][by_key]
            strings = [strings[i] for i in by_key]
            new = np.ones(b - a, bool)
            new[1:] = [x != y for x, y in zip(strings, strings[1:])]
            starts = np.flatnonzero(new)
            smallest = np.minimum.reduceat(ids[text[rows]], starts)
            index.append(np.cumsum(new) - 1)
            same, size, behind = _front_coded([strings[i] for i in starts.tolist()])
            own = int(shard[rows[0]])
            run = np.array([len(starts)], np.int64).tobytes() + same.tobytes() + size.tobytes()
            out.append((own % parts, own, 1, name, own, run + smallest.tobytes() + behind))
        # Runs go by shard; occurrences to the group's place, where they wait for the answers.
        head = np.array([len(ids), len(out), len(order)], np.int64)
        where = [np.concatenate(index), text[order], place[order], n_windows[order]]
        value = b"".join(x.tobytes() for x in (head, ids, hashes, shard[order][edges[:-1]], edges[1:]))
        value += b"".join(x.astype(t).tobytes() for x, t in zip(where, OCCURRENCE, strict=True))
        out.append((home, hash_key(name), 0, name, -1, value))
        return _rows(out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, RUN_TYPES, strict=True)], RUN_NAMES)


#: Place in the run, text of the group, first window, number of windows.
OCCURRENCE = (np.int32, np.int32, np.int32, np.uint8)
#: ``to`` is the partition that a row goes to next.
RUN = "to int, key long, kind int, chunk long, shard long, value binary"
RUN_NAMES = ["to", "key", "kind", "chunk", "shard", "value"]
RUN_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def hash_key(chunk: int) -> int:
    """A negative number, so that groups and shards do not mix."""
    return -1 - chunk


def _decoded(run: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
    """(suffixes, bytes shared with the one before, smallest ids) of a run."""
    n = int(np.frombuffer(run, np.int64, 1)[0])
    same, size = (np.frombuffer(run, np.uint8, n, 8 + k * n).tolist() for k in range(2))
    smallest = np.frombuffer(run, np.int64, n, 8 + 2 * n)
    at, strings, before = 8 + 10 * n, [], b""
    for shared, behind in zip(same, size, strict=True):
        before = before[:shared] + run[at : at + behind]
        strings.append(before)
        at += behind
    return strings, same, smallest


def _shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merged(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, bytes shared with the one before) of all strings in order.

    A loser tree: each inner node keeps a run and how many bytes its string shares with the
    string that won there last. A new string that shares more with the last winner than the
    loser does is smaller, one that shares less is larger; only strings that share equally
    much are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    shares = [r[1] for r in runs]
    at = [0] * k
    loser, loser_share = [0] * k, [0] * k

    def play(node: int) -> int:
        """Build the subtree; returns its winner, shared bytes unknown (0)."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if not strings[b] or (strings[a] and strings[a][0] <= strings[b][0]):
            winner, lost = a, b
        else:
            winner, lost = b, a
        loser[node] = lost
        loser_share[node] = _shared(strings[winner][0], strings[lost][0], 0) if strings[winner] and strings[lost] else -1
        return winner

    winner, share = (play(1) if k > 1 else 0), 0
    while at[winner] < len(strings[winner]):
        yield winner, at[winner], share
        at[winner] += 1
        if at[winner] < len(strings[winner]):
            current, share = strings[winner][at[winner]], shares[winner][at[winner]]
        else:
            current, share = None, -1
        node = (winner + k) >> 1
        while node:
            other_share = loser_share[node]
            if share < other_share:
                # The loser shares more with the last winner, so it is smaller.
                winner, loser[node] = loser[node], winner
                share, loser_share[node] = other_share, share
                current = strings[winner][at[winner]]
            elif share == other_share and share >= 0:
                other = strings[loser[node]][at[loser[node]]]
                common = _shared(current, other, share)
                if current[common:] > other[common:]:
                    winner, loser[node] = loser[node], winner
                    current = other
                loser_share[node] = common
            node >>= 1


def _answers(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Runs in, by shard; for each run the smallest ids of its suffixes out. Occurrences pass."""
    for key, rows in _by_shard(batches, "key"):
        if key < 0:
            yield from rows
            continue
        names = [c for r in rows for c in r.column("chunk").to_pylist()]
        decoded = [_decoded(v.as_py()) for r in rows for v in r.column("value")]
        runs = [d[0] for d in decoded]
        group = [[0] * len(r) for r in runs]
        strings: list[bytes] = []
        size = -1
        for run, at, share in merged([d[:2] for d in decoded]):
            own = runs[run][at]
            if share != size or share != len(own):
                strings.append(own)
                size = len(own)
            group[run][at] = len(strings) - 1
        smallest = np.full(len(strings), np.iinfo(np.int64).max)
        for i, (_, _, ids) in enumerate(decoded):
            group[i] = np.array(group[i], np.int64)
            # A run has each string once.
            smallest[group[i]] = np.minimum(smallest[group[i]], ids)
        windows, of_string = _window_minima(strings, smallest)
        ends = np.fromiter(map(len, strings), np.int64, len(strings)) - LENGTH
        out = []
        for name, own in zip(names, group, strict=True):
            listed = of_string[own] >= 0
            sizes = ends[own[listed]]
            values = [
                np.array([len(own), listed.sum()], np.int64), smallest[own], np.flatnonzero(listed), sizes,
                windows[spread(of_string[own[listed]], sizes)],
            ]
            value = b"".join(v.astype(np.int64).tobytes() for v in values)
            home = ((name >> 32) + (name & 0xFFFFFFFF)) % parts
            out.append((home, hash_key(name), 1, name, key, value))
        yield _rows(out)


def _window_minima(strings: list[bytes], smallest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest ids per window, and where each string's windows start among them.

    Strings that are alone with their anchor have one smallest id for all windows: -1.
    """
    at = np.full(len(strings), -1, np.int64)
    same = [False] + [a[:GRAM] == b[:GRAM] for a, b in zip(strings, strings[1:])]
    same = np.array(same + [False])
    several = np.flatnonzero(same[:-1] | same[1:])
    if not len(several):
        return np.zeros(0, np.int64), at
    natural = []
    for i in several:
        s = strings[i]
        behind = s[-1]
        natural.append(s[behind:-1][::-1] + s[:behind])
    sizes = np.fromiter(map(len, natural), np.int64, len(natural))
    counts = sizes - LENGTH + 1
    data = np.frombuffer(b"".join(natural), np.uint8)
    first = spread(np.cumsum(sizes) - sizes, counts)
    _, index = np.unique(slice_hashes(data, first, first + LENGTH), return_inverse=True)
    least = np.full(int(index.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, index, np.repeat(smallest[several], counts))
    at[several] = np.cumsum(counts) - counts
    return least[index], at


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of a chunk that loses bytes: the spans, as pairs of byte positions."""
    for _, rows in _by_shard(batches, "key"):
        ids, hashes, starts, ends = [], [], [], []
        answers: dict[int, bytes] = {}
        for r in rows:
            for kind, shard, value in zip(r.column("kind").to_pylist(), r.column("shard").to_pylist(), r.column("value"), strict=True):
                if kind:
                    answers[shard] = value.as_py()
                else:
                    held = value.as_py()
        n_texts, n_shards, n_all = np.frombuffer(held, np.int64, 3).tolist()
        own_ids, own_hashes = np.frombuffer(held, np.int64, 2 * n_texts, 24).reshape(2, -1)
        shards, edges = np.frombuffer(held, np.int64, 2 * n_shards, 24 + 16 * n_texts).reshape(2, -1).tolist()
        at, occurrences = 24 + 16 * n_texts + 16 * n_shards, []
        for t in OCCURRENCE:
            occurrences.append(np.frombuffer(held, t, n_all, at))
            at += occurrences[-1].nbytes
        for shard, low, high in zip(shards, [0, *edges], edges):
            index, text, place, n_windows = (x[low:high].astype(np.int64) for x in occurrences)
            doc_id, h = own_ids[text], own_hashes[text]
            answer = np.frombuffer(answers[shard], np.int64)
            n, n_listed = int(answer[0]), int(answer[1])
            smallest = answer[2 : 2 + n]
            listed = answer[2 + n : 2 + n + n_listed]
            sizes = answer[2 + n + n_listed : 2 + n + 2 * n_listed]
            windows = answer[2 + n + 2 * n_listed :]
            where = np.full(n, -1, np.int64)
            where[listed] = np.cumsum(sizes) - sizes
            at = where[index]
            whole = (at < 0) & (smallest[index] < doc_id)
            parts = [(doc_id[whole], h[whole], place[whole], place[whole] + n_windows[whole] - 1 + LENGTH)]
            some = np.flatnonzero(at >= 0)
            count = n_windows[some]
            least = windows[spread(at[some], count)]
            owner = np.repeat(some, count)
            hit = least < doc_id[owner]
            begin = (np.repeat(place[some], count) + spread(np.zeros(len(some), np.int64), count))[hit]
            parts.append((doc_id[owner[hit]], h[owner[hit]], begin, begin + LENGTH))
            for own in parts:
                for column, x in zip((ids, hashes, starts, ends), own, strict=True):
                    column.append(x)
        doc_id, h, start, end = (joined(c) for c in (ids, hashes, starts, ends))
        if not len(doc_id):
            continue
        order = np.lexsort((start, h, doc_id))
        doc_id, h, start, end = (x[order] for x in (doc_id, h, start, end))
        new_doc = np.ones(len(doc_id), bool)
        new_doc[1:] = (doc_id[1:] != doc_id[:-1]) | (h[1:] != h[:-1])
        edges = np.append(np.flatnonzero(new_doc), len(doc_id))
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            reach = np.maximum.accumulate(end[a:b])
            new = np.ones(b - a, bool)
            new[1:] = start[a:b][1:] > reach[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], b - a) - 1
            out.append(np.stack((start[a:b][first], reach[last])).tobytes())
        columns = [pa.array(doc_id[new_doc]), pa.array(h[new_doc]), pa.array(out, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "spans"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out."""
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            raw = text.as_buffer().to_pybytes()
            pairs = np.frombuffer(spans.as_buffer(), np.int64).reshape(2, -1).T.tolist() if spans.is_valid else []
            kept, at = [], 0
            for a, b in pairs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            whole = b"".join(kept)
            rows.append((len(raw), len(raw) - len(whole), len(pairs), hashlib.sha256(whole).hexdigest()))
        columns = [batch.column("doc_id"), *[pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]]
        yield pa.RecordBatch.from_arrays(columns, RESULT_NAMES)


RESULT_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, and spans of the documents that lose bytes.

    ``docs``: doc_id (long), text, h (its hash).
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Even shards of some MB each: their number follows the texts, not the partitions.
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard_bits = min(30, max(4, (n_bytes // SHARD_BYTES).bit_length()))
    names = docs.select("text").mapInArrow(lambda b: _anchor_names(b, shard_bits, n), "to int, shard long, names binary")
    sorted_ = names.repartitionById(n, F.col("to")).drop("to").sortWithinPartitions("shard")
    repeated = bit_map(sorted_.mapInArrow(_repeated, "name long"))
    runs = docs.mapInArrow(lambda b: _runs(b, repeated, shard_bits, n), RUN)
    by_shard = runs.repartitionById(n, F.col("to")).sortWithinPartitions("key")
    answered = by_shard.mapInArrow(lambda b: _answers(b, n), RUN)
    by_group = answered.repartitionById(n, F.col("to")).sortWithinPartitions("key")
    return by_group.mapInArrow(_spans, "doc_id long, h long, spans binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = texts(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("h", F.xxhash64("text"))
    found = stored(spans_of(docs.where("doc_id IS NOT NULL")))
    spans = found.groupBy("doc_id", "h").agg(F.first("spans").alias("spans"))
    touched = bit_map(found.select(F.col("doc_id")))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            hit = touched.of(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([ids, batch.column("text"), batch.column("h"), pa.array(hit)], ["doc_id", "text", "h", "hit"])

    marked = docs.mapInArrow(mark, "doc_id long, text string, h long, hit boolean")
    # Only texts that may lose something are exchanged.
    whole = marked.where("NOT hit").select("doc_id", "text", F.lit(None).cast("binary").alias("spans"))
    cut = marked.where("hit").join(spans, ["doc_id", "h"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return whole.mapInArrow(_removed, schema).unionByName(cut.mapInArrow(_removed, schema))
