import random

import pytest
from pyspark.sql import functions as F

from collodec.operators import (
    attach_first_marginal,
    attach_second_marginal,
    attach_total,
    marginal_by_window,
    pair_marginals,
    reverse_pairs,
    split_union,
    union_marginals_and_pairs,
)
from collodec.operators import lookup
from collodec.operators.lookup import SPLIT, assign_split, frequent_keys, hot_keys, lookup_join, repeat_hot

from conftest import rows_of

PAIRS = "w1 string, w2 string, decade int, c12 bigint"
WORDS = "w string, decade int, c bigint"


def brute_force(pairs, words, word):
    counts = {(w, d): c for w, d, c in words}
    return sorted(
        ((*p, counts.get((p[word], p[2]))) for p in pairs), key=lambda r: tuple(map(str, r))
    )


def skewed(seed):
    """Pairs of which word "hot" of one decade starts about a third."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(60)]
    pairs = set()
    while len(pairs) < 3000:
        first = "hot" if rng.random() < 0.4 else rng.choice(names)
        decade = 1800 if first == "hot" else rng.choice([1800, 1810])
        pairs.add((first, f"v{rng.randrange(4000)}", decade))
    pairs = [(*p, rng.randint(1, 9)) for p in sorted(pairs)]
    totals = {}
    for w1, w2, d, c in pairs:
        for w in (w1, w2):
            totals[w, d] = totals.get((w, d), 0) + c
    words = [(w, d, c) for (w, d), c in sorted(totals.items()) if w not in ("w7", "v9")]
    return pairs, words


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


@pytest.fixture(params=["adaptive", "shuffled"])
def shuffled(request, spark):
    """Lookups beyond the broadcast bound; Spark may still choose one, or may not."""
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {"max_broadcast_bytes": 0}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_marginals_against_brute_force(spark, shuffled, parts):
    pairs, words = skewed(parts)
    b, u = spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(words, WORDS)
    split = {"parts": parts, **shuffled}
    expected = brute_force(pairs, words, 0)
    assert sorted_rows(attach_first_marginal(b, u, **split)) == expected
    assert sorted_rows(marginal_by_window(b, u, parts=parts)) == expected
    assert sorted_rows(attach_second_marginal(b, u, **split)) == brute_force(pairs, words, 1)
    required = attach_first_marginal(b, u, required=True, **split)
    assert sorted_rows(required) == [r for r in expected if r[4] is not None]


def test_broadcast_lookup_against_brute_force(spark):
    pairs, words = skewed(4)
    b, u = spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(words, WORDS)
    assert sorted_rows(attach_first_marginal(b, u)) == brute_force(pairs, words, 0)


@pytest.mark.parametrize("known", [True, False])
def test_hot_key_is_spread(spark, known):
    """Also where the looked-up table does not have the hot word."""
    pairs, words = skewed(5)
    words = [r for r in words if known or r[0] != "hot"]
    b, u = spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(words, WORDS)
    key = ["w1", "decade"]
    hot = hot_keys(b, key, 16)
    assert ("hot", 1800) in [(r.w1, r.decade) for r in hot.collect()]
    split = assign_split(b, hot, key, ["w2"])
    assert split.count() == len(pairs)
    largest = split.groupBy(*key, SPLIT).count().agg(F.max("count")).first()[0]
    assert largest < 2 * len(pairs) / 16
    # Every assigned split exists on the other side, once.
    named = u.withColumnRenamed("w", "w1")
    repeated = repeat_hot(named, hot, key)
    assert repeated.groupBy(*key, SPLIT).count().where("count > 1").count() == 0
    matched = split.join(named, key, "left_semi")
    assert matched.join(repeated, [*key, SPLIT], "left_anti").count() == 0


@pytest.mark.parametrize("sizes", [[], [1], [1] * 50, [2] * 20, [500, 1, 1], [9, 8, 7, 1]])
def test_hot_list_is_bounded(spark, sizes):
    rows = [(f"w{i}", f"v{j}", 1800, 1) for i, size in enumerate(sizes) for j in range(size)]
    hot = hot_keys(spark.createDataFrame(rows, PAIRS), ["w1", "decade"], 8)
    assert hot.count() < 8
    splits = {r.w1: r._splits for r in hot.collect()}
    assert all(2 <= n <= 8 for n in splits.values())
    assert sum(splits.values()) <= 2 * 8
    fair = max(1, sum(sizes) // 8)
    assert set(splits) == {f"w{i}" for i, size in enumerate(sizes) if size > fair}


@pytest.mark.parametrize("seed", range(3))
def test_no_hot_key_is_missed(spark, seed):
    """Far more keys than counters, in many tasks, the frequent ones at the edge of a fair share."""
    rng, parts = random.Random(seed), 8
    n = 40_000
    edges = [n // parts + d for d in (2, 1, 0, -1)]
    words = [f"h{i}" for i, size in enumerate(edges) for _ in range(size)]
    words += [f"w{rng.randrange(15_000)}" for _ in range(n - len(words))]
    rng.shuffle(words)
    rows = spark.createDataFrame([(w, f"v{i}", 1800, 1) for i, w in enumerate(words)], PAIRS).repartition(13)
    hot = hot_keys(rows, ["w1", "decade"], parts)
    assert sorted((r.w1, r._splits) for r in hot.collect()) == [("h0", 2), ("h1", 2)]
    found = frequent_keys(rows, ["w1", "decade"], parts).first()
    assert found.n == n and len(found.top) <= 2 * parts


def test_hot_keys_exchange_no_keys(spark, tmp_path):
    """What tasks pass on to find hot keys is one summary each, and the join counts nothing."""
    b, u = (str(tmp_path / name) for name in "bu")
    pairs, words = skewed(3)
    spark.createDataFrame(pairs, PAIRS).write.parquet(b)
    spark.createDataFrame(words, WORDS).write.parquet(u)
    stored_b, stored_u = spark.read.parquet(b), spark.read.parquet(u)
    plan = frequent_keys(stored_b, ["w1", "decade"], 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan and "partial_approx_top_k" in plan
    joined = lookup_join(
        stored_b, stored_u, {"w": "w1", "decade": "decade"}, {"c": "c1"}, ["w2"], max_broadcast_bytes=0
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("max_broadcast_bytes", [1000, 1, 0])
def test_total_with_default(spark, max_broadcast_bytes):
    pairs = [("a", "b", 1800, 1), ("a", "c", 1810, 1), ("a", "b", 1820, 1)]
    totals = spark.createDataFrame([(1800, 50), (1810, 7)], "decade int, n bigint")
    got = attach_total(
        spark.createDataFrame(pairs, PAIRS), totals, max_broadcast_bytes=max_broadcast_bytes
    )
    assert [r[4] for r in sorted_rows(got)] == [50, 1, 7]


def test_pair_marginals(spark):
    b = spark.createDataFrame([("a", "b", 1800, 2)], PAIRS)
    u = spark.createDataFrame([("a", 1800, 5), ("b", 1800, 3)], WORDS)
    n = spark.createDataFrame([(1800, 8)], "decade int, n bigint")
    assert rows_of(pair_marginals(b, u, n)) == [("a", "b", 1800, 5, 2, 8)]


def test_reverse_twice(spark):
    b = spark.createDataFrame(skewed(1)[0], PAIRS)
    assert rows_of(reverse_pairs(reverse_pairs(b))) == rows_of(b)
    assert rows_of(reverse_pairs(b), "w1") == rows_of(b, "w2")


def test_union_and_split(spark):
    pairs, words = skewed(2)
    b, u = spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(words, WORDS)
    union = union_marginals_and_pairs(u, b)
    assert union.count() == len(pairs) + len(words)
    back_u, back_b = split_union(union)
    assert rows_of(back_u) == rows_of(u) and rows_of(back_b) == rows_of(b)


@pytest.mark.parametrize("required", [False, True])
def test_large_lookup_is_hashed(spark, tmp_path, monkeypatch, required):
    """A looked-up table whose partitions fit a task is hashed; a larger one is sorted, with the same rows."""
    pairs, words = skewed(3)
    b, u = (str(tmp_path / name) for name in "bu")
    spark.createDataFrame(pairs, PAIRS).write.parquet(b)
    spark.createDataFrame(words, WORDS).write.parquet(u)
    stored_b, stored_u = spark.read.parquet(b), spark.read.parquet(u)
    expected = [r for r in brute_force(pairs, words, 0) if not required or r[4] is not None]
    monkeypatch.setattr(lookup, "MIN_HASHED_BYTES", 0)
    for most, join in ((32 << 20, "ShuffledHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(lookup, "MAX_HASHED_BYTES", most)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = attach_first_marginal(stored_b, stored_u, required, max_broadcast_bytes=0)
            assert join in got._jdf.queryExecution().executedPlan().toString()
            assert sorted_rows(got) == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
