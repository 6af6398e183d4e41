"""Reading by name and by form, with nothing passed over in silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NULL_MARK

PARSE_MODES = ("FAILFAST", "DROPMALFORMED")


def check_mode(mode: str) -> None:
    if mode not in PARSE_MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {PARSE_MODES}")


def read_named(
    spark: SparkSession, path: str, schema: T.StructType | str, mode: str | None = None
) -> DataFrame:
    """The columns of ``schema`` from parquet files, by name, cast to its types.

    A file without one of them fails. With a mode, NULLs are judged as in text: FAILFAST
    fails the job on one, DROPMALFORMED drops the row.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    found = spark.read.parquet(path)
    columns = []
    for f in schema:
        column = found[f"`{f.name}`"]
        column = column if found.schema[f.name].dataType == f.dataType else column.cast(f.dataType)
        if mode == "FAILFAST":
            column = F.coalesce(column, F.raise_error(F.lit(f"missing value of {f.name}")))
        columns.append(column.alias(f.name))
    rows = found.select(*columns)
    return rows.dropna() if mode == "DROPMALFORMED" else rows


def number(field: Column, kind: str) -> Column:
    """A field of a text line; the mark of a missing number is NULL."""
    return F.nullif(field, F.lit(NULL_MARK)).cast(kind)


def exactly(fields: Column, n: int, line: Column) -> Column:
    """The fields if there are n of them; the job fails on another number."""
    wrong = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast("array<string>")
    return F.when(F.size(fields) == n, fields).otherwise(wrong)
