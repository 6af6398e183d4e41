"""Releases added to stored counts, counters, quarantine, strongest pairs."""

import os
import random

import pytest

from collodec.operators.counters import counted_bigrams, counted_unigrams
from collodec.operators.counts import bigram_counts, prepare_bigrams, prepare_unigrams, unigram_counts
from collodec.operators.scores import with_scores
from collodec.operators.top import strongest_pairs
from collodec.plans.releases import add_release
from collodec.sinks import write_unigrams
from collodec.sources import read_unigrams
from collodec.sources.ngrams import quarantine_ngrams

from conftest import rows_of


def files_of(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("decade=")}


def test_releases(spark, tmp_path, ngrams, stop_words, workspace):
    """Stored counts and a release: as if counted at once; other decades' files stay."""
    rng = random.Random(2)
    words = ["god", "end", "the", "b1", "x"]
    rows = [(rng.choice(words), rng.choice([1801, 1815, 1824]), rng.randint(1, 9)) for _ in range(200)]
    more = [(rng.choice([*words, "new"]), rng.choice([1817, 1830]), rng.randint(1, 9)) for _ in range(100)]
    counted = lambda r: unigram_counts(prepare_unigrams(ngrams(r), "eng", stop_words))
    path = str(tmp_path / "u")
    write_unigrams(counted(rows), path)
    before = files_of(path)
    touched = add_release(read_unigrams(spark, path), path, counted(more), "c", workspace)
    after = files_of(path)
    assert rows_of(read_unigrams(spark, path)) == rows_of(counted(rows + more))
    assert sorted(r.decade for r in touched.collect()) == [1810, 1830]
    assert {d for d in after if before.get(d) != after[d]} == {"decade=1810", "decade=1830"}
    # An empty release changes nothing.
    add_release(read_unigrams(spark, path), path, counted(more).where("false"), "c", workspace)
    assert files_of(path) == after


def test_counters(spark, ngrams, stop_words):
    rows = [("god", 1801, 2), ("God,", 1802, 3), ("the", 1801, 9), ("--", 1801, 1), ("a b", 1801, 4), (None, 1801, 1), ("x", None, 1)]
    table, counters = counted_unigrams(ngrams(rows), "eng", stop_words)
    assert rows_of(table) == [("god", 1800, 5)]
    assert counters.values() == {"rows_read": 7, "right_arity": 4, "cleaned": 3, "kept": 2, "groups": 1, "occurrences": 5}
    pairs = [("god end", 1801, 2), ("the end", 1801, 3), ("god --", 1801, 4), ("god", 1801, 5)]
    table, counters = counted_bigrams(ngrams(pairs), "eng", stop_words)
    assert rows_of(table) == rows_of(bigram_counts(prepare_bigrams(ngrams(pairs), "eng", stop_words)))
    assert counters.values() == {"rows_read": 4, "right_arity": 3, "cleaned": 2, "kept": 1, "groups": 1, "occurrences": 2}
    table, counters = counted_unigrams(ngrams([]), "eng", stop_words)
    table.collect()
    assert set(counters.values().values()) == {0}


def test_quarantine(spark, tmp_path):
    lines = ["god\t1801\t10", "god\t1801", "god", "", "god\tyear\t1", "god\t1801\tmany\t9", "\t1801\t2", "god\t99999999999\t1", "x\t1802\t3\t4\t5"]
    source = str(tmp_path / "in")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(source)
    rows, rejected = quarantine_ngrams(spark, source, str(tmp_path / "out"))
    assert rows_of(rows) == [("", 1801, 2), ("god", 1801, 10), ("x", 1802, 3)]
    assert rows_of(rejected, "reason", "line") == sorted(
        [("fields", "god\t1801"), ("fields", "god"), ("fields", ""), ("year", "god\tyear\t1"), ("occurrences", "god\t1801\tmany\t9"), ("year", "god\t99999999999\t1")]
    )
    assert all(r.file.startswith("file:") and r.file.endswith(".txt") for r in rejected.collect())
    assert rows.count() + rejected.count() == len(lines)


@pytest.mark.parametrize("k", [1, 3, 1000])
def test_strongest_pairs(spark, k):
    """Ties go by words; rows without a score are in no list; -Infinity is the strongest."""
    rng = random.Random(k)
    odd = [None, float("nan"), float("-inf"), -0.0, 0.0]
    rows = [
        (f"w{rng.randrange(30)}", f"é{rng.randrange(30)}", rng.choice([None, 1800, 1810, 1820]), rng.choice([*odd, *[-1.0 * x for x in range(20)]]))
        for _ in range(900)
    ]
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame(rows, "w1 string, w2 string, decade int, llr double").repartition(7)
    got = [tuple(r) for r in strongest_pairs(df, k).collect()]
    expected = []
    for decade in (None, 1800, 1810, 1820):
        own = [r for r in rows if r[2] == decade and r[3] is not None and r[3] == r[3]]
        own.sort(key=lambda r: (r[3], r[0], r[1]))
        expected += [(decade, i, a, b, s) for i, (a, b, _, s) in enumerate(own[:k], 1)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert strongest_pairs(df.where("false"), k).count() == 0
    plan = strongest_pairs(df, k)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_strongest_pairs_compute_scores_once(spark):
    """No filter on the score, which would be pushed below it and write its terms out again and again."""
    rows = [(f"w{i}", "x", 1800, 10 + i, 20, 1 + i % 5, 1000) for i in range(30)] + [("no", "x", 1800, None, 20, 3, 1000)]
    df = spark.createDataFrame(rows, "w1 string, w2 string, decade int, c1 bigint, c2 bigint, c12 bigint, n bigint")
    top = strongest_pairs(with_scores(df), 5)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "LOG" in line.upper()]
    got = sorted(top.collect(), key=lambda r: r.rank)
    expected = with_scores(df).where("llr IS NOT NULL").orderBy("llr", "w1", "w2").limit(5).collect()
    assert [(r.rank, r.w1, r.llr) for r in got] == [(i, r.w1, r.llr) for i, r in enumerate(expected, 1)]
