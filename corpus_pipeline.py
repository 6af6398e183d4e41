"""The corpus pipeline: documents through five of the operators, one table after the other.

Every stage works on all that the one before kept. The first three drop documents and keep
the others as they are, the fourth rewrites texts, the last returns the ids to train on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collodec.llm import decontaminate, jaccard_join, pieces, pii, toxicity
from collodec.llm.common import stored, table
from collodec.llm.queries import tokenizer_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the toxicity machine, trained on ``labels``."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the contamination rule allows."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced within its format; the number of characters follows the text."""
    changed = pii.pseudonymize(docs)
    n_chars = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", n_chars)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back."""
    vocabulary = pieces.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return pieces.encode_documents(docs, vocabulary, check=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("PII", with_pseudonyms),
    ("SentencePiece encoding and decoding", encoded),
]

#: A trained machine and a subword vocabulary are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each table written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
