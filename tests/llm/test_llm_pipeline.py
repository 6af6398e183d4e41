"""The stages one after the other against plain versions, on the smallest tables."""

import brute
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as contract
import corpus_pipeline
from collodec.llm import decontaminate, pii, toxicity
from collodec.llm.common import stored, table
from collodec.llm.queries import QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    registered = contract.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    bench = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    labels = table(spark, SF_DIR, "labels")
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    before = [(r.doc_id, r.text) for r in docs.collect()]

    def after(name):
        nonlocal docs
        docs = stored(stages[name](spark, docs, SF_DIR))
        return sorted((r.doc_id, r.text) for r in docs.collect())

    kept = [r for r in before if scores[r[0]] < toxicity.THRESHOLD]
    assert after(names[0]) == sorted(kept) and docs.columns == columns
    groups = brute.components(*zip(*kept))
    kept = [r for r, (n, c) in zip(kept, groups) if n == 0 or r[0] == c]
    assert after(names[1]) == sorted(kept) and docs.columns == columns
    hits = decontaminate.brute_force([t for _, t in kept], bench)
    kept = [r for r, (n, h, _) in zip(kept, hits) if not (h and 20 * h >= n)]
    assert after(names[2]) == sorted(kept) and docs.columns == columns
    changed = dict(after(names[3]))
    assert docs.columns == columns and changed.keys() == dict(kept).keys()
    assert docs.where("n_chars != length(text)").count() == 0
    expected = {r.doc_id: r.text for r in spark.createDataFrame(kept, "doc_id long, text string").transform(pii.pseudonymize).collect()}
    assert changed == expected and changed != dict(kept)
    library = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    last = stages[names[4]](spark, docs, SF_DIR).collect()
    assert {r.doc_id: list(r.ids) for r in last} == {i: library.encode(t) for i, t in changed.items()}
    assert all(r.round_trip for r in last)


@pytest.mark.parametrize("at", range(5))
def test_stages_of_odd_tables(spark, at):
    schema = table(spark, SF_DIR, "documents").schema
    stage = corpus_pipeline.STAGES[at][1]
    assert stage(spark, spark.createDataFrame([], schema), SF_DIR).count() == 0
    rows = [(None, None, None, None, None), (5, None, "en", "s", None), (5, "", None, None, 0), (6, "Plain words of no harm at all.", "en", "s", 30)]
    assert stage(spark, spark.createDataFrame(rows, schema), SF_DIR).count() == 4
    assert pq.read_metadata(f"{SF_DIR}/documents.parquet").num_rows > 4
