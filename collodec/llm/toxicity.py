"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

Words are compared by the gapped subsequences of four to six letters that they share (the
word's edges count as letters), each counted less for every letter it skips, so an insult
with letters put in or left out stays close to itself. Marks inside a word are skipped, and
runs of single letters are also read as one word. A sentence is judged by its words, a
document by its worst word and by the share of its words that the machine objects to.

Training takes at most ``MAX_TRAINING`` labelled documents, chosen by a hash of their ids.
Their sentences have the label of the document; which word carries it is found as usual for
labelled bags. Every run of ``WINDOW`` letters of a word is tested: it is evidence if it stands
in more toxic documents than chance allows, by the exact binomial tail, with at most
``FALSE_SHARE`` of all evidence false. Words that hold evidence, and are in more toxic
documents than clean ones, are positive: so the many forms of one insult count together, and a
language with few toxic documents is learned too. Words of clean sentences are negative. In ``TURNS`` turns the clean words that the
machine likes best join the negatives, and words of toxic sentences alone that it objects to
join the positives. Landmarks are the surest words of either kind. The machine is linear in
K_mm^(-1/2) k(landmarks, word), which adds up to one weight per subsequence: scoring looks
weights up and meets no landmark. A logistic fit to the training documents makes the score.

Rules: a NULL or empty text has no word and gets the lowest score. Labels are joined by
doc_id, the larger one of repeated labels; NULL labels and ids teach nothing. Without labels
of both kinds every score is 1 if there are toxic ones, else 0. Each row is scored, repeated
ones alike. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, runs_of, spread, stored, text_bytes, texts

MAX_TRAINING = 30_000
MAX_WORDS = 5_000  # of each kind, per turn
LANDMARKS = 512
TURNS = 4
DECAY = 0.5
#: Letters skipped at most, by length of the subsequence.
SKIPPED = {4: 1, 5: 2, 6: 2}
TABLE = 1 << 20  # subsequences are hashed to so many weights
#: What the driver works on at once: letters of words, and rows of the machine.
BLOCK_LETTERS, BLOCK_ROWS = 4096, 2048
WINDOW = 5
FALSE_SHARE = 0.01
THRESHOLD = 0.7

_EDGE = 0


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each code point below U+3000, whether it is white space)."""
    symbols, blanks = np.zeros(0x3000, np.uint8), np.zeros(0x3000, bool)
    for point in range(0x3000):
        low = chr(point).lower()
        blanks[point] = chr(point).isspace()
        if len(low) == 1 and low.isalpha():
            symbols[point] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 13
    return symbols, blanks


_SYMBOLS, _BLANKS = _tables()


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words as symbol strings, text index of each), runs of single letters also as one."""
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=at[1:])
    small = np.minimum(points, 0x2FFF)
    symbol = np.where(points < 0x3000, _SYMBOLS[small], 27 + points % 13).astype(np.uint8)
    starts, ends, doc = runs_of(~(_BLANKS[small] & (points < 0x3000)), at[offsets])
    before = np.zeros(len(points) + 1, np.int64)
    np.cumsum(symbol > 0, out=before[1:])
    low, high = before[starts], before[ends]
    keep = high > low
    low, high, doc = low[keep], high[keep], doc[keep]
    edges = np.searchsorted(doc, np.arange(len(column) + 1))
    first, last, _ = runs_of(high - low == 1, edges)
    long = last - first >= 3
    spelled_low, spelled_high = low[first[long]], high[last[long] - 1]
    sizes = np.concatenate((high - low, spelled_high - spelled_low))
    letters = symbol[symbol > 0][spread(np.concatenate((low, spelled_low)), sizes)]
    string_offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=string_offsets[1:])
    buffers = [None, pa.py_buffer(string_offsets), pa.py_buffer(letters.tobytes())]
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)
    return words, np.concatenate((doc, doc[first[long]]))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all words with their edges, first symbol of each word, symbols left)."""
    data, offsets = text_bytes(words)
    sizes = np.diff(offsets) + 2
    ends = np.cumsum(sizes)
    symbols = np.full(int(ends[-1]) if len(ends) else 0, _EDGE, np.uint32)
    symbols[spread(ends - sizes + 1, sizes - 2)] = data
    return symbols, ends - sizes, np.repeat(ends, sizes) - np.arange(len(symbols))


def _subsequences(symbols: np.ndarray) -> Iterator[tuple[float, int, np.ndarray]]:
    """(weight, reach, hash of the subsequence from each position), one per pattern of skips.

    A hash counts where more than ``reach`` symbols are left in its word.
    """
    longest, most = max(SKIPPED), max(SKIPPED.values())

    def walk(code: np.ndarray, length: int, reach: int) -> Iterator:
        skipped = reach - length + 1
        if skipped <= SKIPPED.get(length, -1):
            mixed = code ^ np.uint32(length * 0x3C6EF372 & 0xFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield DECAY**skipped, reach, (mixed ^ (mixed >> np.uint32(13))) & np.uint32(TABLE - 1)
        for step in range(1, most - skipped + 2) if length < longest else ():
            following = np.zeros_like(symbols)
            following[: len(symbols) - reach - step] = symbols[reach + step :]
            yield from walk(code * np.uint32(0x9E3779B1) + following, length + 1, reach + step)

    yield from walk(symbols.copy(), 1, 0)


def _norms(words: pa.Array) -> np.ndarray:
    """Root of the sum of squared weights of a word's subsequences, by its length."""
    sizes = np.diff(text_bytes(words)[1]) + 2
    total = np.zeros(len(sizes))
    for weight, reach, _ in _subsequences(np.zeros(1, np.uint32)):
        total += np.maximum(sizes - reach, 0) * weight**2
    return np.sqrt(np.maximum(total, 1e-9))


def margins(words: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word."""
    if not len(words):
        return np.zeros(0)
    symbols, first, left = _letters(words)
    total = np.zeros(len(symbols), np.float32)
    for weight, reach, code in _subsequences(symbols):
        total += np.where(left > reach, weights[code] * np.float32(weight), np.float32(0))
    return np.add.reduceat(total, first) / _norms(words) + bias


@dataclass
class Model:
    codes: np.ndarray  # subsequences with a weight
    values: np.ndarray
    bias: float
    logistic: np.ndarray  # of the standardized measures of a document, and a constant
    center: np.ndarray
    scale: np.ndarray

    def weights(self) -> np.ndarray:
        table = np.zeros(TABLE, np.float32)
        table[self.codes] = self.values
        return table

    def score(self, measures: np.ndarray) -> np.ndarray:
        x = (measures - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.logistic[:-1] + self.logistic[-1], -35, 35)))


NOTHING = -3.0  # the worst word of a text without any
MEASURES = 4


def _measure(batch: pa.RecordBatch, model: Model, weights: np.ndarray) -> np.ndarray:
    """Per text: worst margin, log share of objections, log of words and of objections."""
    n = len(batch)
    words, doc = words_of(batch.column("text"))
    encoded = words.dictionary_encode()
    margin = margins(encoded.dictionary, weights, model.bias)
    margin = margin[encoded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0)
    worst = np.full(n, NOTHING)
    np.maximum.at(worst, doc, margin)
    count = np.bincount(doc, minlength=n)
    objections = np.bincount(doc, np.maximum(margin, 0), minlength=n)
    return np.stack((worst, np.log((objections + 0.02) / (count + 10)), np.log1p(count), np.log1p(objections)), 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per distinct word of a batch: toxic and clean documents that it is in."""
    for batch in as_batches(batches):
        words, doc = words_of(batch.column("text"))
        encoded = words.dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique(codes * (len(batch) + 1) + doc)
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        of_word = pairs // (len(batch) + 1)
        toxic = label[pairs % (len(batch) + 1)]
        n = len(encoded.dictionary)
        counts = [np.bincount(of_word, toxic == y, minlength=n).astype(np.int64) for y in (1, 0)]
        columns = [encoded.dictionary.cast(pa.binary()), *map(pa.array, counts)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "toxic", "clean"])


def _windows(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of letters, index of its word); shorter words are one run."""
    symbols, first, left = _letters(words)
    sizes = np.diff(np.append(first, len(symbols)))
    code = np.zeros(len(symbols), np.uint32)
    for k in range(WINDOW):
        following = np.zeros(len(symbols), np.uint32)
        following[: len(symbols) - k] = symbols[k:]
        code = code * np.uint32(0x9E3779B1) + np.where(left > k, following + 1, 0).astype(np.uint32)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    starts = np.zeros(len(symbols), bool)
    starts[spread(first, np.maximum(sizes - WINDOW + 1, 1))] = True
    owner = np.repeat(np.arange(len(words)), sizes)
    return (code ^ (code >> np.uint32(13)))[starts].astype(np.int64) & (TABLE - 1), owner[starts]


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of letters: toxic and clean documents of a task that it is in."""
    total = np.zeros((2, TABLE), np.int64)
    for batch in as_batches(batches):
        words, doc = words_of(batch.column("text"))
        encoded = words.dictionary_encode()
        code, owner = _windows(encoded.dictionary)
        sizes = np.bincount(owner, minlength=len(encoded.dictionary))
        word = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        runs = code[spread((np.cumsum(sizes) - sizes)[word], sizes[word])]
        pairs = np.unique(np.repeat(doc, sizes[word]) * TABLE + runs)
        label = batch.column("label").to_numpy(zero_copy_only=False)[pairs // TABLE]
        for y in (0, 1):
            total[y] += np.bincount(pairs[label == y] % TABLE, minlength=TABLE)
    seen = np.flatnonzero(total.sum(0))
    columns = [pa.array(seen), pa.array(total[1][seen]), pa.array(total[0][seen])]
    yield pa.RecordBatch.from_arrays(columns, ["code", "toxic", "clean"])


def _log_tails(toxic: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """ln of the chance of at least ``toxic`` of n, each with the given chance."""
    top = int(n.max(initial=0))
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, top + 1)))))
    pairs, back = np.unique(n * (top + 1) + toxic, return_inverse=True)
    out = np.empty(len(pairs))
    for i, pair in enumerate(pairs.tolist()):
        size, k = divmod(pair, top + 1)
        j = np.arange(k, size + 1)
        terms = log_factorial[size] - log_factorial[j] - log_factorial[size - j] + j * np.log(share) + (size - j) * np.log1p(-share)
        out[i] = terms.max() + np.log(np.exp(terms - terms.max()).sum())
    return out[back]


def evidence(rows: DataFrame, share: float) -> np.ndarray:
    """Whether each run of letters is evidence. At most ``TABLE`` counts come to the driver."""
    counted = rows.mapInArrow(_count_windows, "code long, toxic long, clean long")
    found = counted.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    code, toxic, clean = (found.column(c).to_numpy() for c in ("code", "toxic", "clean"))
    over = toxic > share * (toxic + clean)
    tails = np.zeros(len(code))
    tails[over] = _log_tails(toxic[over], (toxic + clean)[over], share)
    order = np.argsort(tails, kind="stable")
    allowed = np.log(FALSE_SHARE * np.arange(1, len(code) + 1) / len(code))
    passed = np.flatnonzero(tails[order] <= allowed)
    mask = np.zeros(TABLE, bool)
    mask[code[order[: passed[-1] + 1 if len(passed) else 0]]] = True
    return mask


def _with_evidence(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    mask = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    for batch in batches:
        code, owner = _windows(batch.column("word").cast(pa.large_binary()))
        held = np.bincount(owner, mask[code], minlength=batch.num_rows) > 0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held)], [*batch.schema.names, "held"])


def _profile(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, summed weight) of all words, each pair once, in order of both."""
    symbols, first, left = _letters(words)
    owner = np.repeat(np.arange(len(words)), np.diff(np.append(first, len(symbols))))
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
    for weight, reach, code in _subsequences(symbols):
        own = left > reach
        found, times = np.unique(owner[own] * TABLE + code[own], return_counts=True)
        keys.append(found)
        weights.append(weight * times)
    pairs, back = np.unique(np.concatenate(keys), return_inverse=True)
    return pairs // TABLE, pairs % TABLE, np.bincount(back, np.concatenate(weights), minlength=len(pairs))


def _feature_blocks(words: pa.Array, landmarks: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first word, last + 1, kernel values with the landmarks), some words at a time."""
    owners, codes, weights = _profile(landmarks)
    order = np.argsort(codes, kind="stable")
    owners, codes, weights = owners[order], codes[order], weights[order]
    norms = _norms(landmarks)
    ends = np.cumsum(np.diff(text_bytes(words)[1]) + 2)
    start = 0
    while start < len(words):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK_LETTERS, "right")))
        part = words.slice(start, stop - start)
        owner, code, weight = _profile(part)
        low, high = np.searchsorted(codes, code), np.searchsorted(codes, code, "right")
        hits = spread(low, high - low)
        cells = np.repeat(owner, high - low) * len(landmarks) + owners[hits]
        kernel = np.bincount(cells, np.repeat(weight, high - low) * weights[hits], minlength=len(part) * len(landmarks))
        yield start, stop, kernel.reshape(len(part), -1) / _norms(part)[:, None] / norms[None, :]
        start = stop


def _features(words: pa.Array, landmarks: pa.Array, root: np.ndarray | None = None) -> np.ndarray:
    """Kernel values of words and landmarks, times ``root``."""
    out = np.zeros((len(words), len(landmarks) if root is None else root.shape[1]))
    for start, stop, kernel in _feature_blocks(words, landmarks):
        out[start:stop] = kernel if root is None else kernel @ root
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, regular: float = 1e-4) -> tuple[np.ndarray, float]:
    """Primal Newton steps for the squared hinge loss; the last weight is the bias."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.full(len(w), regular)
    ridge[-1] = 1e-6
    for _ in range(25):
        gram, right = np.diag(ridge), np.zeros(len(w))
        for start in range(0, len(x), BLOCK_ROWS):
            part = slice(start, start + BLOCK_ROWS)
            own = np.hstack((x[part], np.ones((len(x[part]), 1))))
            inside = y[part] * (own @ w) < 1
            own, target = own[inside], y[part][inside]
            scaled = own * weight[part][inside][:, None]
            gram += scaled.T @ own
            right += scaled.T @ target
        new = np.linalg.solve(gram, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``x`` is constant."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - y) + 1e-3 * w)
    return w


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> DataFrame:
    """text and label of at most ``limit`` labelled documents; their ids may be broadcast.

    Of documents of one label that share both the least and the greatest hash of their runs of
    five words, which copies do and near copies mostly, one stays: what is said once is
    counted once.
    """
    own = labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
    own = own.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = texts(docs, "doc_id").join(F.broadcast(chosen), "doc_id").select("text", "label")
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 5))
    )
    hashed = rows.withColumn("words", F.split(F.lower("text"), r"\s+")).withColumn("runs", runs)
    ends = hashed.select("label", "text", F.array_min("runs").alias("least"), F.array_max("runs").alias("greatest"))
    return ends.groupBy("label", "least", "greatest").agg(F.min("text").alias("text")).select("text", "label")


def _machine(words: pa.Array, positive: np.ndarray, sure: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """(a weight for every subsequence, bias). ``sure``: the landmarks."""
    landmarks = words.take(pa.array(sure))
    values, vectors = np.linalg.eigh(_features(landmarks, landmarks))
    good = values > 1e-4 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    y = np.where(positive, 1.0, -1.0)
    for sign, total in ((1, 1.0), (-1, 5.0)):
        weight = np.where(y == sign, weight * total / max(1e-9, weight[y == sign].sum()), weight)
    w, bias = _svm(_features(words, landmarks, root), y, weight)
    alpha = root @ w / _norms(landmarks)
    symbols, first, left = _letters(landmarks)
    owner = np.repeat(np.arange(len(landmarks)), np.diff(np.append(first, len(symbols))))
    table = np.zeros(TABLE)
    for share, reach, code in _subsequences(symbols):
        np.add.at(table, code[left > reach], share * alpha[owner[left > reach]])
    return table.astype(np.float32), bias


def _like(batches: Iterator[pa.RecordBatch], weights: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        margin = margins(batch.column("word").cast(pa.large_binary()), weights, bias)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], [*batch.schema.names, "margin"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> Model:
    """``labels``: doc_id and label (0 or 1)."""
    rows = stored(training_rows(docs, labels, limit))
    schema = "word binary, toxic long, clean long"
    counted = rows.mapInArrow(_count_words, schema)
    counted = counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    nothing = np.zeros(0, np.int64), np.zeros(0, np.float32)
    if len(n) < 2:
        constant = np.append(np.zeros(MEASURES), 35.0 if 1 in n else -35.0)
        return Model(*nothing, 0.0, constant, np.zeros(MEASURES), np.ones(MEASURES))
    share = n[1] / (n[0] + n[1])
    seen = F.col("toxic") + F.col("clean")
    z = (F.col("toxic") - seen * share) / F.sqrt(seen * share * (1 - share))
    bits = np.packbits(evidence(rows, share)).tobytes()
    marked = counted.withColumn("z", z).mapInArrow(
        lambda b: _with_evidence(b, bits), f"{schema}, z double, held boolean"
    )
    counted = stored(marked.withColumn("sure", F.col("held") & (F.col("toxic") > F.col("clean"))).drop("held"))
    known: dict[bytes, tuple[int, int, float, bool]] = {}

    def learn(part: DataFrame, positive: bool) -> list[bytes]:
        new = [(bytes(r["word"]), r) for r in part.collect()]
        for word, r in new:
            known[word] = (r["toxic"], r["clean"], r["z"], positive or known.get(word, (0, 0, 0, False))[3])
        return [word for word, _ in new]

    sure = F.col("sure")
    learn(counted.where(sure).orderBy(F.desc("z"), "word").limit(MAX_WORDS), True)
    if not known:  # few documents: the likeliest words
        learn(counted.where("clean = 0").orderBy(F.desc("z"), "word").limit(5), True)
    negative = counted.where((F.col("clean") > 0) & ~sure)
    learn(negative.orderBy(F.desc("clean"), "word").limit(MAX_WORDS), False)
    learn(negative.orderBy(F.xxhash64("word"), "word").limit(MAX_WORDS), False)
    hard: list[bytes] = []
    for turn in range(TURNS):
        names = sorted(known)
        words = pa.array(names, pa.large_binary())
        toxic, clean, zs, positive = (np.array([known[w][i] for w in names]) for i in range(4))
        place = {w: i for i, w in enumerate(names)}
        marks = [i for i in np.argsort(-zs, kind="stable") if positive[i]][: LANDMARKS // 2]
        others = [place[w] for w in hard[: LANDMARKS // 4]]
        others += [i for i in np.argsort(-clean, kind="stable") if not positive[i]]
        marks += list(dict.fromkeys(others))[: LANDMARKS - len(marks)]
        weight = np.where(positive, toxic, np.sqrt(clean)) ** 0.7
        table, bias = _machine(words, positive, np.array(marks), weight)
        if turn == TURNS - 1:
            break
        kinds = f"{schema}, z double, sure boolean, margin double"
        liked = counted.mapInArrow(lambda b, t=table, c=bias: _like(b, t, c), kinds)
        hard = learn(
            liked.where((F.col("clean") > 0) & ~sure & (F.col("margin") > -0.5)).orderBy(F.desc("margin"), "word").limit(MAX_WORDS),
            False,
        )
        learn(
            liked.where("clean = 0 AND z > 2.5 AND margin > 0.3").orderBy(F.desc("z"), "word").limit(MAX_WORDS), True
        )
    codes = np.flatnonzero(table)
    model = Model(codes, table[codes], bias, np.zeros(MEASURES + 1), np.zeros(MEASURES), np.ones(MEASURES))
    measured = rows.mapInArrow(lambda b: _measured(b, model), "label int, measures array<double>").collect()
    x = np.array([r["measures"] for r in measured])
    y = np.array([r["label"] for r in measured], float)
    model.center, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.hstack(((x - model.center) / model.scale, np.ones((len(x), 1))))
    model.logistic = _logistic(x, y)
    return model


def _measured(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    weights = model.weights()
    for batch in as_batches(batches):
        measures = pa.array(list(_measure(batch, model, weights)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), measures], ["label", "measures"])


def _score(batches: Iterator[pa.RecordBatch], model: Model, key: str) -> Iterator[pa.RecordBatch]:
    weights = model.weights()
    for batch in as_batches(batches):
        value = pa.array(model.score(_measure(batch, model, weights)))
        yield pa.RecordBatch.from_arrays([batch.column(key), value], [key, "score"])


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key`` and score of every row of ``docs``."""
    rows = texts(docs, key)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lambda b: _score(b, model, key), f"`{key}` {kind}, score double")


def fold(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def learned_labels(labels: DataFrame) -> DataFrame:
    return labels.where(fold(3) != 1).select("doc_id", F.col("toxic").cast("int").alias("label"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    scored = score(docs, fit(docs, learned_labels(labels)))
    return scored.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, as they are; learned from ``labelled``."""
    model = fit(labelled, learned_labels(labels))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return score(packed, model, "row").where(F.col("score") < THRESHOLD).select("row.*")
