"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontaminate, fingerprint, jaccard_join, lexical, pieces, pii, quality, secrets, suffix_dedup, tokenfile, toxicity, transducer
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id"
    )
    return decontaminate.digest(found)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return pieces.encode_documents(table(spark, sf_dir, "documents"), vocabulary, check=True)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = transducer.Vocabulary(tokenizer_path("word_bpe_49k.json"))
    return transducer.digest(transducer.encode_documents(table(spark, sf_dir, "documents"), vocabulary, decoded=True))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_decontaminate, op3_secret_scan, op4_sentencepiece, op5_quality, op6_token_files, op7_jaccard_join, op8_fingerprint, op9_suffix_dedup, op10_toxicity, op11_lexical_search, op12_bpe, op13_conversation_repair)}
ORACLE_SQL: dict[str, str] = {"op11_lexical_search": lexical.SQL}
