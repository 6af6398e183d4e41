"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every text is a blob, named by the SHA-256 of its bytes. The ledger lists
which rule versions have been run over which blob, and what each found. A scan takes from
the history the blobs for which a rule version is missing, one copy of each, runs only the
missing rules over them, appends the findings, and joins the findings of the rule versions
it was asked for back to every version of every path. A second scan of the same history
reads no text but for its hash.

Copies of a blob are put together before the exchange and after it. Findings go back by a
join in which a blob with more versions than a partition's fair share is split: its versions
are dealt out by their keys, and its findings are repeated for each part. Only the names of
such blobs are collected, fewer than there are partitions.

Rules: a NULL text is the empty blob, which has no findings. Each row of the history gets a
row of the result, also repeated ones and such with NULL keys. Columns of other names are
ignored. An empty history gives an empty result and adds nothing to the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import SPLIT, assign_split, hot_keys, repeat_hot, shuffle_parts
from .common import shared_folder, stored, texts

# Fixed patterns: kind, version, pattern, group whose length counts, least length of it,
# and a text (in lower case) without which the pattern cannot match.
RULES = (
    ("assign", 1, r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
     2, 12, (b"passw", b"secret", b"token", b"api")),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 18, (b"akia",)),
    ("hex", 1, r"[0-9a-f]{16,}", 0, 16, ()),
    ("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
     0, 1, (b"private key",)),
    ("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, (b"eyj",)),
    ("url", 2, r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]*+:[^\s/@]{3,}+@", 0, 1, (b"://",)),
)
BASE = ("assign", "access", "hex")
KINDS = [r[0] for r in RULES]
FINDING = "array<struct<kind: string, start: long, end: long>>"
#: In the ledger each finding has its rule's id. Where it has none, it is that of its kind among the row's rules.
LEDGER_FINDING = "array<struct<kind: string, start: long, end: long, rule: string>>"
LEDGER = f"blob binary, rules array<string>, findings {LEDGER_FINDING}"


def rule_id(rule: tuple) -> str:
    return f"{rule[0]}@{rule[1]}"


def find(text: str, rules: tuple = RULES, compiled: dict | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings, by start and then by the rules' order."""
    return [(rules[order][0], start, end) for start, order, end in _found(text, rules, compiled)]


def _found(text: str, rules: tuple, compiled: dict | None) -> list[tuple[int, int, int]]:
    """(start, place of the rule, end) of all findings, sorted."""
    lowered, found = text.encode("utf-8", "surrogatepass").lower(), []
    for order, (_, _, pattern, group, least, needed) in enumerate(rules):
        if needed and not any(word in lowered for word in needed):
            continue
        matcher = compiled[pattern] if compiled else re.compile(pattern)
        for m in matcher.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, m.end()))
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple) -> Iterator[pa.RecordBatch]:
    compiled = {r[2]: re.compile(r[2]) for r in rules}
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("rule", pa.string())])
    )
    by_id = {rule_id(r): r for r in rules}
    for batch in batches:
        found = []
        missing = batch.column("rules").to_pylist()
        for text, own in zip(batch.column("text"), missing, strict=True):
            todo = rules if len(own) == len(rules) else tuple(by_id[r] for r in own)
            found.append(
                [
                    {"kind": todo[k][0], "start": a, "end": b, "rule": rule_id(todo[k])}
                    for a, k, b in _found(text.as_py(), todo, compiled)
                ]
            )
        columns = [batch.column("blob"), batch.column("rules"), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["blob", "rules", "findings"])


def _exists(spark, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def scan(history: DataFrame, ledger: str, *keys: str, rules: tuple = RULES) -> DataFrame:
    """Scan what the ledger lacks; returns ``keys``, ``blob`` and ``findings`` per version.

    ``ledger`` is a folder, made by the first scan. Its rows are blob, rules (those run) and
    findings; a blob has one row per scan that found rules missing. Two scans at once may both
    add a blob: equal findings of one rule count once.
    """
    spark = history.sparkSession
    wanted = [rule_id(r) for r in rules]
    versions = texts(history, *keys).withColumn("blob", F.unhex(F.sha2("text", 256)))
    todo = F.array(*map(F.lit, wanted))
    if _exists(spark, ledger):
        seen = spark.read.parquet(ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        # The seen blobs are found by name alone; only texts of blobs with missing rules go on.
        versions_todo = versions.join(seen, "blob", "left").withColumn(
            "rules", F.array_except(todo, F.coalesce("seen", F.array().cast("array<string>")))
        ).where(F.size("rules") > 0)
    else:
        versions_todo = versions.withColumn("rules", todo)
    # The lists of one blob are equal; one copy of its text is kept on both sides of the exchange.
    unseen = versions_todo.groupBy("blob").agg(F.first("text").alias("text"), F.first("rules").alias("rules"))
    scanned = unseen.mapInArrow(
        lambda batches: _scan(batches, rules), LEDGER
    )
    scanned.write.mode("append").parquet(ledger)
    def is_wanted(f):
        own = F.filter("rules", lambda r: F.substring_index(r, "@", 1) == f.kind)
        return F.coalesce(f.rule, F.get(own, F.lit(0))).isin(wanted)

    def place(f):
        return F.struct(f.kind.alias("kind"), f.start.alias("start"), f.end.alias("end"))

    known = (
        spark.read.schema(LEDGER).parquet(ledger)
        .select("blob", F.filter("findings", is_wanted).alias("findings"))
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
        .select("blob", F.array_sort(F.transform("findings", place)).alias("findings"))
    )
    named = stored(versions.select(*keys, "blob"))
    hot = hot_keys(named, ["blob"], shuffle_parts(named))
    dealt = assign_split(named, hot, ["blob"], keys or ["blob"])
    return dealt.join(repeat_hot(known, hot, ["blob"]), ["blob", SPLIT], "left").select(
        *keys, "blob", F.coalesce("findings", F.array().cast(FINDING)).alias("findings")
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    def lines(findings):
        ordered = F.array_sort(
            F.transform(
                findings,
                lambda f: F.struct(
                    f.start.alias("start"),
                    F.array_position(F.array(*map(F.lit, KINDS)), f.kind).alias("place"),
                    F.concat_ws(":", f.kind, f.start, f.end).alias("line"),
                ),
            )
        )
        return F.array_join(F.transform(ordered, lambda f: f.line), ",")

    base = F.filter("findings", lambda f: f.kind.isin(*BASE))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(lines(base), 256).alias("base_sha256"), lines(F.col("findings")).alias("spans")
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    return digest(scan(docs, shared_folder(docs.sparkSession), "doc_id"))
