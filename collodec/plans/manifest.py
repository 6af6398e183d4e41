"""What a stage was made from: written beside its tables when they are whole.

A manifest names the stage's inputs (files with their sizes and times, or the content of a
small table), its options, and the manifests of the stages before it by their ids. It lies in
the folder of the stage's last table, where readers pass over it, and goes with that table.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .materialize import _file_system, exists

NAME = "_manifest.json"


def listing(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of all files below a path."""
    files, where = _file_system(spark, path)
    digest = hashlib.sha256()
    rows = []
    if files.exists(where):
        found = files.listFiles(where, True)
        while found.hasNext():
            status = found.next()
            rows.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    for row in sorted(rows):
        digest.update(row.encode() + b"\n")
    return digest.hexdigest()


def content(df: DataFrame) -> str:
    """A digest of a table's rows in any order, repeated ones counted."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # Two sums, of hashes cut in half: none can overflow below 2**31 rows.
    low, high = (F.sum(F.shiftrightunsigned(row, 32) if up else row.bitwiseAND((1 << 32) - 1)) for up in (0, 1))
    return " ".join(str(x) for x in df.agg(F.count(F.lit(1)), low, high).first())


def expected(stage: str, inputs: dict[str, str], options: dict[str, object], upstream: Sequence[str]) -> dict:
    return {"stage": stage, "inputs": inputs, "options": options, "upstream": list(upstream)}


def write(spark: SparkSession, folder: str, manifest: dict) -> str:
    """Write under another name, then rename; the manifest's id."""
    own = uuid.uuid4().hex
    files, where = _file_system(spark, f"{folder}/{NAME}")
    _, draft = _file_system(spark, f"{folder}/_{own}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps(manifest | {"id": own}, indent=1, sort_keys=True).encode()))
    finally:
        out.close()
    files.delete(where, False)
    if not files.rename(draft, where):
        raise OSError(f"{folder}/{NAME} cannot be written")
    return own


def read(spark: SparkSession, folder: str) -> dict | None:
    if not exists(spark, f"{folder}/{NAME}"):
        return None
    files, where = _file_system(spark, f"{folder}/{NAME}")
    stream = files.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def read_id(spark: SparkSession, folder: str) -> str | None:
    found = read(spark, folder)
    return found and found["id"]


def matches(spark: SparkSession, folder: str, wanted: dict) -> bool:
    """Whether the folder's manifest says what is wanted, whatever its id."""
    found = read(spark, folder)
    return found is not None and {k: v for k, v in found.items() if k != "id"} == wanted
