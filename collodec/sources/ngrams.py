"""N-gram corpora: where they are and how their lines read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_rule
from .sequence import read_sequence
from .strict import PARSE_MODES, check_mode, read_named

NGRAM_SCHEMA = T.StructType(
    [
        T.StructField("ngram", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("occurrences", T.LongType()),
    ]
)

FORMATS = ("parquet", "text", "sequence", "sequence-hadoop")

# The folder of each language's collection in the public book n-gram release.
COLLECTIONS = {"eng": "eng-us-all", "heb": "heb-all"}


@dataclass(frozen=True)
class Corpus:
    language: str
    unigrams: str
    bigrams: str


def corpus(
    language: str,
    root: str | None = None,
    unigrams: str | None = None,
    bigrams: str | None = None,
) -> Corpus:
    """The 1-gram and 2-gram paths of a language, below ``root`` unless given singly."""
    clean_rule(language)
    if root is None and (unigrams is None or bigrams is None):
        raise ValueError("give either root or both unigrams and bigrams")
    base = f"{root}/{COLLECTIONS[language]}"
    return Corpus(
        language,
        unigrams or f"{base}/1gram/data",
        bigrams or f"{base}/2gram/data",
    )


def _typed_fields(mode: str) -> list[Column]:
    """The columns of NGRAM_SCHEMA from ``_fields``; a bad one is NULL or fails the job."""
    columns = []
    for i, f in enumerate(NGRAM_SCHEMA):
        value = F.get("_fields", F.lit(i)).try_cast(f.dataType)
        if mode == "FAILFAST":
            line = F.concat_ws("\t", "_fields")
            value = F.coalesce(value, F.raise_error(F.concat(F.lit("malformed line: "), line)))
        columns.append(value.alias(f.name))
    return columns


def parse_ngram_line(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """A one-column DataFrame of ``ngram<TAB>year<TAB>occurrences[<TAB>...]`` -> typed rows.

    FAILFAST fails the job on a missing field or a bad number, DROPMALFORMED drops the
    line. Both judge every line, also one whose words a later filter would drop.

    The fields come out of a generator, because filters are not pushed below one: below a
    plain projection each use of ``ngram`` in a filter would split the line once more.
    """
    check_mode(mode)
    (line,) = lines.columns
    split = lines.select(F.split(line, "\t").alias("_fields"))
    rows = split.select(F.inline(F.array(F.struct(*_typed_fields(mode)))))
    return rows.dropna() if mode == "DROPMALFORMED" else rows


def read_ngrams(
    spark: SparkSession, path: str, fmt: str = "parquet", mode: str = "FAILFAST"
) -> DataFrame:
    """Read n-gram rows.

    ``parquet`` has the three columns of NGRAM_SCHEMA, found by name; ``text`` and
    ``sequence`` hold tab-separated lines, in a sequence file as the Text values. In all of
    them ``mode`` says what becomes of a row with a field missing. Sequence files are parsed
    in Arrow batches; ``sequence-hadoop`` is for compressed ones, through Hadoop's reader and
    Python workers row by row. ``convert_ngrams`` writes such a corpus to parquet once.
    """
    check_mode(mode)
    if fmt == "parquet":
        return read_named(spark, path, NGRAM_SCHEMA, mode)
    if fmt == "text":
        return parse_ngram_line(spark.read.text(path), mode)
    if fmt == "sequence":
        return parse_ngram_line(read_sequence(spark, path), mode)
    if fmt == "sequence-hadoop":
        records = spark.sparkContext.sequenceFile(
            path, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text"
        )
        lines = spark.createDataFrame(records.values(), "string", verifySchema=False)
        return parse_ngram_line(lines, mode)
    raise ValueError(f"unknown format {fmt!r}; known: {FORMATS}")


def convert_ngrams(
    spark: SparkSession, source: str, target: str, fmt: str = "sequence", mode: str = "FAILFAST"
) -> None:
    """One pass over a corpus of any format to the parquet form."""
    read_ngrams(spark, source, fmt, mode).write.parquet(target)


QUARANTINE_SCHEMA = "ngram string, year int, occurrences bigint, reason string, line string, file string"


def quarantine_ngrams(spark: SparkSession, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Text n-grams parsed in one pass: (rows, rejected lines with the reason and their file).

    Both are written below ``target``, a folder for each. Reasons, the first that holds:
    ``fields`` (fewer than three), ``year`` and ``occurrences`` (no number that fits).
    """
    text = spark.read.text(source)
    fields = text.select("value", F.split("value", "\t").alias("f"), F.col("_metadata.file_path").alias("file"))
    ngram, year, occurrences = (F.get("f", F.lit(i)).try_cast(c.dataType) for i, c in enumerate(NGRAM_SCHEMA))
    reason = (
        F.when(F.size("f") < len(NGRAM_SCHEMA), "fields").when(year.isNull(), "year").when(occurrences.isNull(), "occurrences")
    )
    judged = fields.select(ngram.alias("ngram"), year.alias("year"), occurrences.alias("occurrences"), reason.alias("reason"), "value", "file")
    bad = F.col("reason").isNotNull()
    parted = judged.select(
        *[F.when(~bad, F.col(c.name)).alias(c.name) for c in NGRAM_SCHEMA],
        "reason",
        F.when(bad, F.col("value")).alias("line"),
        F.when(bad, F.col("file")).alias("file"),
        bad.alias("rejected"),
    )
    parted.write.partitionBy("rejected").parquet(target)
    both = spark.read.schema(QUARANTINE_SCHEMA + ", rejected boolean").parquet(target)
    rows = both.where(~F.col("rejected")).select(*[c.name for c in NGRAM_SCHEMA])
    return rows, both.where("rejected").select("reason", "line", "file")
