"""Bottom-k fingerprints of documents, in DataFrame functions only.

A text's set holds its distinct runs of five words (lower case, cut at blanks), one of all
its words if it has fewer. Its fingerprint is the ``K`` smallest 48-bit hashes of the set:
a uniform sample without replacement, so two fingerprints estimate how far their sets agree,
and the K-th hash tells how many there are. The smallest K of several fingerprints together
are the fingerprint of the union: parts of a text or of a corpus merge.

Rules: NULL counts as the empty text, whose fingerprint is empty; two empty ones agree
wholly, an empty and another not at all. Sets of fewer than K members are whole in their
fingerprints, and all estimates exact. Repeated rows are documents of their own; equal ids
stand in the order of their texts' hashes, NULL ids behind all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
_SPACE = 1 << 48


def shingle_hashes(text: Column) -> Column:
    """Sorted distinct hashes of a text's word runs."""
    words = F.filter(F.split(F.lower(text), "[ \t-\r]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WORDS)
        each = F.transform(at, lambda i: F.xxhash64(*[h[i + k] for k in range(WORDS)]))
        return F.when(F.size(h) >= WORDS, each).when(F.size(h) > 0, F.array(F.xxhash64(h)))

    # One element, so that the words are hashed once and not once per use.
    every = F.transform(F.array(hashes), lambda h: F.coalesce(runs(h), F.array().cast("array<bigint>")))[0]
    return F.array_sort(F.array_distinct(F.transform(every, lambda x: x.bitwiseAND(F.lit(_SPACE - 1)))))


def sketch(text: Column, k: int = K) -> Column:
    return F.slice(shingle_hashes(F.coalesce(text, F.lit(""))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of the union of two sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_groups(rows: DataFrame, group: str, column: str, k: int = K) -> DataFrame:
    """One fingerprint per group. Each task keeps the k smallest of a group before the exchange."""
    each = rows.select(group, F.explode(column).alias("_h")).distinct()
    ranked = each.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_h")))
    return ranked.where(F.col("_r") <= k).groupBy(group).agg(F.array_sort(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of intersection over union, 0 to 1."""

    def share(u: Column, both: Column) -> Column:
        return F.size(F.array_intersect(u, both)) / F.size(u)

    union = merge(a, b, k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(share(union, F.array_intersect(a, b)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimate of the set's size; exact below k."""
    last = F.element_at(a, k).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * (_SPACE / (last + 1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's set that is in b's."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def _bucket(docs: DataFrame, n: int) -> Column:
    """A number that ascends with doc_id: ranges of about equally many documents.

    The ranges are quantiles, cut evenly once more where many are asked for. Their number
    follows the session's shuffle partitions, not the rows.
    """
    n_quantiles = min(n, 256)
    shares = [i / n_quantiles for i in range(n_quantiles + 1)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10000)).first()[0]
    bounds = sorted(set(bounds or []))
    if len(bounds) < 2:
        return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("bigint")
    finer = max(1, n // n_quantiles)

    def between(low: int, high: int) -> Column:
        if high - low > 1:
            middle = (low + high) // 2
            return F.when(F.col("doc_id") < bounds[middle], between(low, middle)).otherwise(between(middle, high))
        width = max(1, bounds[high] - bounds[low])
        part = F.floor((F.col("doc_id") - bounds[low]) * F.lit(float(finer)) / width)
        return F.lit(low * finer) + F.least(F.greatest(part, F.lit(0)), F.lit(finer - 1))

    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(between(0, len(bounds) - 1)).cast("bigint")


def with_next(docs: DataFrame) -> DataFrame:
    """Each document with the text and fingerprint of the next one in descending doc_id.

    Documents go to ranges of doc_id; the first document of a range also goes, as a guest,
    to the end of the range that comes before, so no range has to know another.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select(_bucket(docs, max(64, 4 * partitions)).alias("bucket"), "doc_id", F.xxhash64("text").alias("h"), "text")
    # NULL ids come last: the smallest bucket.
    first = F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "h"))
    heads = rows.groupBy("bucket").agg(first.alias("head"))
    order = Window.orderBy(F.desc("bucket"))  # one row per range, as many as partitions at most four times
    lowest = F.min("bucket").over(Window.partitionBy())
    heads = heads.select("bucket", "head.*", F.coalesce(F.lag("bucket").over(order), lowest).alias("to"))
    heads = heads.withColumnsRenamed({"bucket": "head_bucket", "id": "head_id", "h": "head_h"})
    own = F.coalesce("doc_id", F.lit(-(1 << 63)))
    guests = rows.join(
        F.broadcast(heads),
        (F.col("bucket") == F.col("head_bucket")) & (own == F.col("head_id")) & (F.col("h") == F.col("head_h")),
    ).select(F.col("to").alias("bucket"), "doc_id", "h", "text", F.lit(True).alias("guest"))
    placed = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition(partitions, "bucket")
    sketched = placed.withColumn("sketch", sketch(F.col("text")))
    following = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("h"))
    both = sketched.withColumn("next", F.lead(F.struct("text", "sketch")).over(following))
    return both.where(~F.col("guest")).select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The contract's columns, and the estimated number of distinct word runs."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(docs).select("*", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("n_shingles"),
    )
