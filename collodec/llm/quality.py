"""Quality by a regularised quadratic discriminant over transformed document statistics.

Each text is reduced to ``MEASURES`` statistics: sizes, shares of kinds of characters, how
often words, word pairs and lines repeat, how even the words' frequencies are. Shares are
taken through log((count + a) / (total + b)), sizes through log. Per class Spark sums the
vectors and their products over all labelled rows (no sample: the sums are one row per
class), the driver shrinks each covariance towards the pooled one and that towards its
diagonal, and factors it once (Cholesky). A document's score is the sigmoid of the
difference of the log densities, each from a triangular solve with the cached factor, after
slope and intercept were fitted to the labelled rows' differences in bins.

Rules: a NULL text counts as empty, and is scored by its statistics. Labels are joined by
doc_id, the larger one of repeated labels; NULL labels and ids teach nothing. Without labels
of both kinds every score is 1 if there are good ones, else 0. Each row is scored, repeated
ones alike. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, mixed, runs_of, slice_hashes, stored, text_bytes, texts

MEASURES = 18
SHRINK_TO_POOLED = 0.05
SHRINK_TO_DIAGONAL = 0.02
THRESHOLD = 0.3
BINS = 400

# Kinds of bytes.
_KINDS = np.zeros((256,), np.uint8)
_KINDS[[*range(0x30, 0x3A)]] = 1  # digits
_KINDS[[*range(0x41, 0x5B)]] = 2  # capitals
_KINDS[[*range(0x61, 0x7B)]] = 3  # small letters
_KINDS[0x80:0xC0] = 4  # later bytes of a code point
_KINDS[0xC0:] = 5  # first bytes of one
_KINDS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 6
_KINDS[0x0A] = 7
_KINDS[[ord(c) for c in ".,;:'\"-()?"]] = 8  # marks of prose
_KINDS[[ord(c) for c in "!"]] = 9
_KINDS[[ord(c) for c in "|"]] = 10
_KINDS[[*range(0x21, 0x7F)]] = np.where(_KINDS[0x21:0x7F] == 0, 11, _KINDS[0x21:0x7F])  # symbols
_BLANK = np.isin(_KINDS, (6, 7))


def _counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: distinct values, the most frequent one's count, sum of count * log count."""
    if not len(owner):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    new = np.concatenate(([True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(o)))
    most = np.zeros(n)
    np.maximum.at(most, o[first], size)
    return np.bincount(o[first], minlength=n), most, np.bincount(o[first], size * np.log(size), minlength=n)


def measures(column: pa.Array) -> np.ndarray:
    """The transformed statistics, one row per text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    kind = _KINDS[data]
    by_kind = np.stack([_counts(kind == k, offsets) for k in range(12)]).astype(float)
    size = np.diff(offsets) - by_kind[4]  # code points
    letters = by_kind[2] + by_kind[3] + by_kind[5]
    starts, ends, doc = runs_of(~_BLANK[data], offsets)
    words = np.bincount(doc, minlength=n).astype(float)
    hashes = slice_hashes(data, starts, ends)
    distinct, most, spread_ = _distinct(doc, hashes, n)
    same = doc[1:] == doc[:-1]
    pair = mixed(hashes[:-1] + mixed(hashes[1:]))[same] if len(hashes) else hashes
    pairs = np.bincount(doc[1:][same], minlength=n)
    distinct_pairs, _, _ = _distinct(doc[1:][same], pair, n)
    line_start, line_end, line_doc = runs_of(data != 0x0A, offsets)
    lines = np.bincount(line_doc, minlength=n)
    distinct_lines, _, _ = _distinct(line_doc, slice_hashes(data, line_start, line_end), n)
    long_words = np.bincount(doc, (ends - starts) > 14, minlength=n)
    short_words = np.bincount(doc, (ends - starts) < 3, minlength=n)
    log_share = lambda part, whole: np.log((part + 0.5) / (whole + 10))
    columns = [
        np.log1p(size), np.log1p(words), np.log((letters + 1) / (words + 1)),
        log_share(by_kind[1], size), log_share(by_kind[2], letters), log_share(by_kind[8], words),
        log_share(by_kind[9], words), log_share(by_kind[10], words), log_share(by_kind[11], words),
        log_share(by_kind[7], words), log_share(by_kind[6], size),
        log_share(words - distinct, words), log_share(pairs - distinct_pairs, pairs),
        log_share(lines - distinct_lines, lines), log_share(most, words),
        np.log1p(words) - spread_ / np.maximum(words, 1),
        log_share(long_words, words), log_share(short_words, words),
    ]
    return np.stack(columns, 1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in as_batches(batches):
        values = pa.array(measures(batch.column("text")).ravel())
        rows = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, MEASURES, dtype=np.int32), values)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every row; the only pass over the texts."""
    rows = texts(docs, "doc_id")
    return rows.mapInArrow(_measure, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    centers: list[np.ndarray]
    factors: list[np.ndarray]  # Cholesky factors of the two covariances
    slope: float = 1.0
    intercept: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        densities = []
        for center, factor in zip(self.centers, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - center).T)
            densities.append(-0.5 * (z * z).sum(0) - np.log(np.diag(factor)).sum())
        return np.clip(densities[1] - densities[0], -200, 200)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.intercept, -35, 35)))


@dataclass
class Constant:
    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class and batch: rows, sums, sums of products, as one array."""
    for batch in batches:
        x = np.asarray(batch.column("x").flatten()).reshape(-1, MEASURES)
        y = batch.column("label").to_numpy(zero_copy_only=False)
        for label in np.unique(y):
            own = x[y == label]
            total = np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
            n = len(total)
            columns = [pa.array(np.full(n, label, np.int32)), pa.array(np.arange(n)), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, ["label", "at", "total"])


def fit(rows: DataFrame, labels: DataFrame) -> Discriminant | Constant:
    """``rows``: doc_id and x; ``labels``: doc_id and label (0 or 1)."""
    own = labels.where("doc_id IS NOT NULL AND label IN (0, 1)")
    own = own.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    train = rows.join(own, "doc_id").select("x", "label")
    sums = train.mapInArrow(_sums, "label int, at long, total double").groupBy("label", "at").agg(F.sum("total").alias("total"))
    found: dict[int, np.ndarray] = {}
    for r in sums.collect():  # two classes of a fixed number of sums
        found.setdefault(r["label"], np.zeros(1 + MEASURES + MEASURES**2))[r["at"]] = r["total"]
    if len(found) < 2:
        return Constant(float(1 in found))
    centers, covariances, sizes = [], [], []
    for label in (0, 1):
        n, total, products = found[label][0], found[label][1 : MEASURES + 1], found[label][MEASURES + 1 :]
        center = total / n
        covariances.append(products.reshape(MEASURES, MEASURES) / n - np.outer(center, center))
        centers.append(center)
        sizes.append(n)
    pooled = sum(n * c for n, c in zip(sizes, covariances, strict=True)) / sum(sizes)
    factors = []
    for n, covariance in zip(sizes, covariances, strict=True):
        # The fewer rows, the more of the pooled covariance.
        share = SHRINK_TO_POOLED + (1 - SHRINK_TO_POOLED) * MEASURES / (MEASURES + n)
        mix = (1 - share) * covariance + share * pooled
        mix = (1 - SHRINK_TO_DIAGONAL) * mix + SHRINK_TO_DIAGONAL * np.diag(np.diag(mix))
        factors.append(np.linalg.cholesky(mix + 1e-6 * np.eye(MEASURES)))
    model = Discriminant(centers, factors)

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, MEASURES)
            squashed = np.arcsinh(model.difference(x))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(squashed)], ["label", "d"])

    binned = train.mapInArrow(differences, "label int, d double")
    bins = binned.groupBy("label", F.round(F.col("d") * (BINS / 12)).alias("bin")).agg(F.count("d").alias("n"), F.avg("d").alias("d"))
    rows_ = bins.collect()  # at most as many as bins and classes
    y, n, d = (np.array([r[k] for r in rows_], float) for k in ("label", "n", "d"))
    model.slope, model.intercept = _calibrate(np.sinh(d), y, n)
    return model


def _calibrate(d: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the sigmoid, by damped Newton steps."""
    scale = max(1.0, float(np.sqrt(np.average(d * d, weights=n))))
    x = np.stack((d / scale, np.ones_like(d)), 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (n * (p - y)) + 1e-3 * w)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def _score(batches: Iterator[pa.RecordBatch], model: Discriminant | Constant) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.asarray(batch.column("x").flatten()).reshape(-1, MEASURES)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = stored(measured(docs))
    known = labels.where(fold != 0).select("doc_id", F.col("quality").alias("label"))
    model = fit(rows, known)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(lambda b: _score(b, model), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
