"""Jaccard self-join of word 5-grams by token-combination prefixes.

Documents of equal sets are one node, named by a hash of the set. Tokens (5-gram hashes)
are ordered rare ones first, and by hash within. What matters is how a set's prefix is
indexed: two sets that are similar enough miss at most so many tokens of each other's
prefix. Rare tokens are indexed singly. Frequent ones are dealt to sub-classes, whose number
follows the size of the set, and indexed as pairs of one sub-class; the prefix is extended
until missing tokens alone cannot explain that no rare token and no pair is shared. So
every similar pair has a key in common, while a passage that thousands of documents share
makes no key by itself.

Whether a token is frequent only has to be the same everywhere: it is looked up in a bit
map of fixed size, made of the tokens that are frequent within the parts of the corpus. More
frequent tokens than the map can tell apart make more tokens count as frequent, never a
wrong result.

Keys are exchanged as rows and read as a sorted stream: a hot key needs no memory. In two
rounds each node of a key is compared with one node of the key, first with the one that
shares most keys, then with others; what is similar is joined to components. Then only pairs
of different components are left, and those are compared that share enough of their
prefixes. Nodes known to be connected are not paired, so copies and near copies, however
many, cost one comparison each and key.

Similarity is verified on the whole sets of hashes. The union of the links is all that is
kept of them: components, not pairs.

Rules: words are cut at blanks after lower-casing A-Z. Fewer than five words are one token.
A text without words (or NULL) has an empty set, links with nothing, not even its like, and
is its own component. Repeated rows are documents of their own, in one component. NULL ids
take part; a component of NULL ids alone has the id NULL. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import BitMap, bit_map
from .common import as_batches, joined, mixed, runs_of, slice_hashes, stored, text_bytes, texts
from .components import components

WORDS = 5
PERCENT = 80
#: Times that a token occurs in a part of the corpus to be told of, and in all told of to be frequent.
LOCAL, FREQUENT = 2, 10
#: Tokens per part for counting.
PART_TOKENS = 4_000_000
#: Tokens of a set per sub-class of frequent tokens, about.
PER_CLASS = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_ODD = mixed(np.arange(101, 101 + WORDS, dtype=np.uint64)) | np.uint64(1)


def token_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct 5-gram hashes of each text."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    starts, ends, doc = runs_of(_WORD[data], offsets)
    words = slice_hashes(data, starts, ends)
    edges = np.searchsorted(doc, np.arange(len(column) + 1))
    n = max(0, len(words) - WORDS + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(WORDS):
        grams += words[k : k + n] * _ODD[k]
    grams = mixed(grams)
    sets = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if high - low >= WORDS:
            sets.append(np.unique(grams[low : high - WORDS + 1]))
        elif high > low:
            own = (words[low:high] * _ODD[: high - low]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([own + np.uint64(high - low)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of the set, as a signed number."""
    total = mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def least_overlap(n: np.ndarray | int):
    """Tokens of a set of n that a similar set has at least."""
    return (PERCENT * n + 99) // 100


def least_shared(n):
    """Tokens that two similar sets share at least, by the sum of their sizes."""
    return (PERCENT * n + 99 + PERCENT) // (100 + PERCENT)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: documents with their nodes, and tokens frequent in this part."""
    tokens: list[np.ndarray] = []
    seen: set[int] = set()
    held = 0

    def frequent() -> pa.RecordBatch:
        values, counts = np.unique(joined(tokens, np.uint64), return_counts=True)
        often = counts >= LOCAL
        values, counts = values[often], counts[often]
        nothing = pa.nulls(len(values), pa.int64())
        columns = [nothing, nothing, nothing, pa.array(counts), pa.array(values.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "node", "n", "token"])

    for batch in as_batches(batches):
        sets = token_sets(batch.column("text"))
        nodes = [node_of(s) if len(s) else None for s in sets]
        sizes = np.array([len(s) for s in sets], np.int64)
        ids = batch.column("doc_id").cast(pa.int64())
        columns = [ids, batch.column("h"), pa.array(nodes, pa.int64()), pa.array(sizes), pa.nulls(len(sets), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "node", "n", "token"])
        for node, own in zip(nodes, sets, strict=True):
            if node is not None and node not in seen:
                seen.add(node)
                tokens.append(own)
                held += len(own)
        if held >= PART_TOKENS:
            yield frequent()
            tokens, held = [], 0
            seen.clear()
    if tokens:
        yield frequent()


def keys_of(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of single tokens, keys of pairs) that index a sorted set."""
    n = len(tokens)
    may_miss = n - least_overlap(n)
    rare, often = tokens[~frequent], tokens[frequent]
    singles = rare[: may_miss + 1]
    if len(rare) > may_miss:
        return singles, np.zeros(0, np.uint64)
    pairs = []
    level = n.bit_length() - 1
    for own in (level, level + 1):
        if own > level and 100 * n < PERCENT << own:
            break  # no set of the next size class is similar to one as small as this
        n_classes = max(1, (1 << own) // PER_CLASS)
        group = (mixed(often + np.uint64(own)) % np.uint64(n_classes)).astype(np.int64)
        first = np.zeros(len(often), bool)
        first[np.unique(group, return_index=True)[1]] = True
        enough = np.searchsorted(len(rare) + np.cumsum(~first), may_miss + 1) + 1
        used, group = often[:enough], group[:enough]
        order = np.argsort(group, kind="stable")
        used, group = used[order], group[order]
        for gap in range(1, len(used)):
            same = group[gap:] == group[:-gap]
            if not same.any():
                break
            pairs.append(mixed(used[:-gap][same] + mixed(used[gap:][same] + np.uint64(own))))
    return singles, joined(pairs, np.uint64)


def _postings(batches: Iterator[pa.RecordBatch], frequent: BitMap) -> Iterator[pa.RecordBatch]:
    """key, node and its sizes; each node of a batch once.

    The lowest bit of a key says that it is a single token; the sizes are tokens of the set
    and, in the low half, those among its keys.
    """
    for batch in as_batches(batches):
        sets = token_sets(batch.column("text"))
        nodes = np.array([node_of(s) if len(s) else 0 for s in sets], np.int64)
        _, once = np.unique(nodes, return_index=True)
        once = [i for i in once if len(sets[i])]
        if not once:
            continue
        flags = frequent.of(np.concatenate([sets[i] for i in once]))
        keys, counts, sizes, at = [], [], [], 0
        for i in once:
            singles, pairs = keys_of(sets[i], flags[at : at + len(sets[i])])
            at += len(sets[i])
            keys += [singles | np.uint64(1), pairs & ~np.uint64(1)]
            counts.append(len(singles) + len(pairs))
            sizes.append((len(sets[i]) << 32) | len(singles))
        columns = [
            pa.array(joined(keys, np.uint64).view(np.int64)),
            pa.array(np.repeat(nodes[once], counts)),
            pa.array(np.repeat(np.array(sizes, np.int64), counts)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "node", "sizes"])


POSTING = "key long, node long, sizes long"


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node: each node once, of keys that have several."""
    names = ["key", "node", "sizes"]
    held: tuple | None = None  # the last row of another node, and whether it was given out
    given = False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            columns = [np.insert(c, 0, h) for c, h in zip(columns, held, strict=True)]
        key, node = columns[:2]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        columns = [c[new] for c in columns]
        key = columns[0]
        same = key[1:] == key[:-1]
        keep = np.zeros(len(key), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if held is not None and given:
            keep[0] = False
        last_given = bool(keep[-1]) or (len(key) == 1 and held is not None and given)
        held, given = tuple(c[-1] for c in columns), last_given
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: the key's first node with each that may be similar and is not
    known to be connected with it.

    Shared tokens that are not among the single tokens of both lie behind those of one of the
    two (of both, if both have all their rare tokens among them). A token that no other node
    has as a key may still be shared: it can stand behind the other's single tokens.
    """
    held: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("key", "node", "n", "singles", "shared", "component")]
        if held is not None:
            columns = [np.insert(c, 0, h) for c, h in zip(columns, held, strict=True)]
        key, node, n, singles, shared, component = columns
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        first = np.repeat(start, np.diff(np.append(start, len(key))))
        least = np.maximum(least_shared(n + n[first]), least_overlap(np.maximum(n, n[first])))
        behind, whole = n - singles, singles <= n - least_overlap(n)
        rest = np.where(whole & whole[first], np.minimum(behind, behind[first]), np.maximum(behind, behind[first]))
        most = np.minimum(np.minimum(shared, shared[first]) + rest, np.minimum(n, n[first]))
        out = (component != component[first]) & (most >= least)
        held = tuple(c[start[-1]] for c in columns)
        if out.any():
            a, b = np.minimum(node, node[first])[out], np.maximum(node, node[first])[out]
            once = np.unique(np.stack((a, b), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(once[:, 0]), pa.array(once[:, 1])], ["a", "b"])


def _candidate_sets(batches: Iterator[pa.RecordBatch], wanted: BitMap) -> Iterator[pa.RecordBatch]:
    for batch in as_batches(batches):
        found: dict[int, bytes] = {}
        for tokens in token_sets(batch.column("text")):
            node = node_of(tokens) if len(tokens) else None
            if node is not None and node not in found and np.int64(node).view(np.uint64) in wanted:
                found[node] = tokens.tobytes()
        if found:
            columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "tokens"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = (np.frombuffer(t.as_buffer(), np.uint64) for t in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar. Only their sets are exchanged."""
    pairs = stored(pairs.select("a", "b").distinct())
    nodes = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    wanted = bit_map(nodes)
    rows = texts(docs).mapInArrow(lambda b: _candidate_sets(b, wanted), "node long, tokens binary")
    sets = rows.groupBy("node").agg(F.first("tokens").alias("tokens"))
    x = pairs.join(sets.withColumnsRenamed({"node": "b", "tokens": "y"}), "b")
    both = x.join(sets.withColumnsRenamed({"node": "a", "tokens": "x"}), "a").select("a", "b", "x", "y")
    return stored(both.mapInArrow(_verified, "a long, b long"))


def links(docs: DataFrame, frequent: BitMap) -> DataFrame:
    """Links (a, b) between nodes that connect all similar nodes."""
    spark = docs.sparkSession
    postings = texts(docs).mapInArrow(lambda b: _postings(b, frequent), POSTING)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = postings.repartition(n, "key").sortWithinPartitions("key", "node")
    keys = stored(sorted_.mapInArrow(_shared_keys, POSTING))
    # Who shares most keys is the likeliest to be what the others are copies of.
    n_tokens, n_single = F.shiftright("sizes", 32), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1))
    shared = F.sum(F.col("key").bitwiseAND(F.lit(1)))
    support = keys.groupBy("node", "sizes").agg(F.count("key").alias("support"), shared.alias("shared"))
    support = support.select("node", "support", "shared", n_tokens.alias("n"), n_single.alias("singles"))
    open_ = stored(keys.drop("sizes").join(support, "node").withColumn("component", F.col("node")))
    found: DataFrame | None = None
    for order in (F.desc("support"), F.xxhash64("node")):
        by_key = open_.repartition(n, "key").sortWithinPartitions("key", order, "node")
        pairs = by_key.select("key", "node", "n", "singles", "shared", "component").mapInArrow(_stars, "a long, b long")
        more = verify(docs, pairs)
        found = more if found is None else found.unionByName(more)
        labels = components(found)
        # What is left: nodes of one key in different components.
        labelled = open_.drop("component").join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        spans = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_ = stored(labelled.join(spans.where("low < high").select("key"), "key"))
    more = verify(docs, _crossing(open_))
    return components(found.unionByName(more)).select(F.col("node").alias("a"), F.col("component").alias("b"))


def _crossing(open_: DataFrame) -> DataFrame:
    """Pairs of nodes that share keys and are not connected, so far as they may be similar."""
    names = ("node", "n", "shared", "singles", "component")
    one, two = (open_.select("key", *[F.col(c).alias(f"{c}_{s}") for c in names]) for s in "ab")
    both = F.col("n_a") + F.col("n_b")
    least = F.greatest(
        F.ceil(F.lit(PERCENT) * both / (100 + PERCENT)), F.ceil(F.lit(PERCENT) * F.greatest("n_a", "n_b") / 100)
    )
    # As in _stars.
    behind = [F.col(f"n_{x}") - F.col(f"singles_{x}") for x in "ab"]
    whole = [F.col(f"singles_{x}") <= F.col(f"n_{x}") - F.ceil(F.lit(PERCENT) * F.col(f"n_{x}") / 100) for x in "ab"]
    rest = F.when(whole[0] & whole[1], F.least(*behind)).otherwise(F.greatest(*behind))
    met = one.join(two, "key").where(
        (F.col("component_a") != F.col("component_b")) & (F.col("node_a") < F.col("node_b"))
        & (F.least("n_a", "n_b") >= least) & (F.least("shared_a", "shared_b") + rest >= least)
    )
    shared = met.groupBy("node_a", "node_b", "n_a", "n_b", "singles_a", "singles_b").agg(
        F.sum(F.col("key").bitwiseAND(F.lit(1))).alias("shared")
    )
    return shared.where(F.col("shared") + rest >= least).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, h (hash of the text), n_shingles, component, component_id."""
    rows = texts(docs, "doc_id").withColumn("h", F.xxhash64("text"))
    told = stored(rows.mapInArrow(_nodes, "doc_id long, h long, node long, n long, token long"))
    often = told.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
    frequent = bit_map(often.where(F.col("n") > FREQUENT).select("token"))
    own = told.where("token IS NULL").select("doc_id", "h", "node", F.col("n").alias("n_shingles"))
    labels = links(docs, frequent).select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = own.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    names = nodes.join(least, "component").select("node", "component", "component_id")
    return own.join(names, "node", "left")


def join_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return _classes(docs).select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest id, NULL last, as it is.

    Documents without words all stay. Of equal ids the one with the smaller hash of its text
    stays, of repeated rows one.
    """
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("h"))
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "h", name.alias("name"))
    chosen = _classes(docs).where("n_shingles > 0").groupBy("component").agg(F.min(first).alias("first"))
    chosen = chosen.select(F.col("first.name").alias("name"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    has_words = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    named = packed.where(has_words).withColumn("h", F.xxhash64("text")).select("row", name.alias("name"))
    kept = named.join(chosen, "name", "left_semi").dropDuplicates(["name"])
    return kept.select("row.*").unionByName(packed.where(~has_words).select("row.*"))
