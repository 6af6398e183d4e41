import math
import os
import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from collodec import __main__ as job
from collodec import convert as conversion
from collodec import Run, RunPaths, Workspace, collocations, corpus, read_ngrams, read_stop_words, run
from collodec.operators import (
    bigram_counts,
    key_order,
    lookup,
    order_by_counts,
    prepare_bigrams,
    prepare_unigrams,
    unigram_counts,
)
from collodec.plans import catalogue, manifest, pipeline
from collodec.plans.catalogue import with_position
from collodec.plans.materialize import default_folder
from collodec.sinks import write_pairs, write_scores, write_totals, write_unigrams
from collodec.sources import parse_ngram_line, read_pairs, read_totals, read_unigrams
from collodec.sources.tables import read_scores

from conftest import rows_of

WORDS = ["the", "The", "god", "God,", "end", "--", "b1", "x", "can't", "é", "e"]


def random_tables(seed):
    rng = random.Random(seed)
    draw = lambda: rng.choices(WORDS, weights=[9, 2, 9, 3, 3, 2, 1, 1, 1, 1, 1])[0]
    twos = [(f"{draw()} {draw()}", rng.randint(1790, 1830), rng.randint(1, 5)) for _ in range(600)]
    ones = [(t, y, c) for g, y, c in twos for t in g.split(" ")]
    return ones, twos


def clean(token):
    return "".join(c for c in token if c.isascii() and c.isalnum()).lower()


def brute_force(ones, twos, stop):
    u, n, b = Counter(), Counter(), Counter()
    kept = lambda w: w and w not in stop
    for token, year, c in ones:
        w, d = clean(token), year // 10 * 10
        if kept(w):
            u[w, d] += c
            n[d] += c
    for gram, year, c in twos:
        w1, w2 = map(clean, gram.split(" "))
        if kept(w1) and kept(w2):
            b[w1, w2, year // 10 * 10] += c
    adjust = lambda p: 0.01 if p == 0 else 0.99 if p == 1 else p

    def ln_l(k, m, x):
        return k * math.log(x) + (m - k) * math.log(1 - x)

    scored = {}
    for (w1, w2, d), c12 in b.items():
        c1, c2, total = u[w1, d], u[w2, d], n[d]
        if c2 - c12 > total - c1:
            scored[w1, w2, d] = (c1, c2, c12, total, None)
            continue
        p, p1 = adjust(c2 / total), adjust(c12 / c1)
        p2 = adjust((c2 - c12) / (total - c1))
        llr = (
            ln_l(c12, c1, p)
            + ln_l(c2 - c12, total - c1, p)
            - ln_l(c12, c1, p1)
            - ln_l(c2 - c12, total - c1, p2)
        )
        scored[w1, w2, d] = (c1, c2, c12, total, llr)
    return scored


def as_dict(scores):
    return {
        (r.w1, r.w2, r.decade): (r.c1, r.c2, r.c12, r.n, r.llr) for r in scores.collect()
    }


def assert_same(got, expected):
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key][:4] == values[:4]
        if values[4] is None:
            assert got[key][4] is None
        else:
            assert got[key][4] == pytest.approx(values[4], abs=1e-8)
    assert any(v[4] is not None for v in expected.values())


@pytest.fixture
def nothing_is_small(spark, monkeypatch):
    """Every lookup but that of the decade totals takes the way of large tables."""
    is_bounded = lookup.is_bounded
    monkeypatch.setattr(
        lookup, "is_bounded", lambda df, rows: "n" in df.columns and is_bounded(df, rows)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_against_brute_force(spark, ngrams, stop_words, workspace, seed):
    ones, twos = random_tables(seed)
    got = collocations(ngrams(ones).repartition(5), ngrams(twos), "eng", stop_words, workspace=workspace)
    assert_same(as_dict(got), brute_force(ones, twos, {"the", "cant"}))


def test_collocations_of_large_tables(spark, ngrams, stop_words, workspace, nothing_is_small):
    ones, twos = random_tables(3)
    got = collocations(ngrams(ones), ngrams(twos).repartition(5), "eng", stop_words, workspace=workspace)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert_same(as_dict(got), brute_force(ones, twos, {"the", "cant"}))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("SortMergeJoin") == 2
    # Both sides of both lookups against the list of hot words, and the totals.
    assert plan.count("BroadcastHashJoin") == 5


def test_preparation_plan(ngrams, stop_words):
    """Words are dropped and partly summed before the only shuffle."""
    words = unigram_counts(prepare_unigrams(ngrams([("god", 1801, 1)]), "eng", stop_words))
    pairs = bigram_counts(prepare_bigrams(ngrams([("a b", 1801, 1)]), "eng", stop_words))
    for df, tokens in ((words, 1), (pairs, 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        shuffle = plan.index("Exchange hashpartitioning")
        assert plan.index("partial_sum") > shuffle and plan.index("LeftAnti") > shuffle
        # Each token is cleaned once.
        assert plan.count("regexp_replace") == tokens


def lines(rows):
    return ["\t".join(map(str, r)) for r in rows]


def write_lines(spark, rows, path):
    spark.createDataFrame([(x,) for x in rows], "value string").write.text(path)


def write_sequence(spark, rows, path):
    """Keys past the int range, as Python integers below it become IntWritable."""
    keyed = spark.sparkContext.parallelize([(2**33 + i, x) for i, x in enumerate(lines(rows))])
    keyed.saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
    )


def small_corpus(spark, tmp_path, seed):
    ones, twos = random_tables(seed)
    source = corpus("eng", root=str(tmp_path / "corpus"))
    write_lines(spark, [x + "\t9\t9" for x in lines(ones)], source.unigrams)
    write_lines(spark, lines(twos), source.bigrams)
    write_lines(spark, ["the", "cant"], str(tmp_path / "stop"))
    stop = read_stop_words(spark, str(tmp_path / "stop"))
    return source, stop, brute_force(ones, twos, {"the", "cant"})


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_run_from_files(spark, tmp_path, fmt):
    source, stop, expected = small_corpus(spark, tmp_path, 4)
    paths = RunPaths(str(tmp_path / "out"))
    got = run(spark, source, stop, paths, fmt="text", score_fmt=fmt, stage_fmt=fmt, sorted=True)
    if fmt == "parquet":
        assert_same(as_dict(got), expected)
    else:
        written = [r.value for r in spark.read.text(paths.scores).collect()]
        keys = [tuple(x.split("\t")[0].split(" ")) for x in written]
        ordered = sorted(keys, key=lambda k: (int(k[2]), k[1], k[0]))
        assert keys == ordered and len(keys) == len(expected)
        for r in got.collect():
            assert r.llr == pytest.approx(expected[r.w1, r.w2, r.decade][4], abs=1e-8)
    totals = read_totals(spark, paths.totals, fmt)
    assert totals.count() == len({k[2] for k in expected})
    assert sorted(os.listdir(tmp_path / "out" / paths.run_id)) == [
        "bigrams", "pairs", "scores", "totals", "unigrams",
    ]


def test_run_goes_on(spark, tmp_path):
    """Stages one by one; what is complete is not written again, what is not is."""
    source, stop, expected = small_corpus(spark, tmp_path, 5)
    paths = RunPaths(str(tmp_path / "out"), "r")
    first = Run(spark, source, stop, paths, fmt="text")
    first.count_words()
    first.count_pairs()
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        first.all()
    os.remove(tmp_path / "out" / "r" / "pairs" / "_SUCCESS")
    before = sorted(os.listdir(tmp_path / "out" / "r" / "unigrams" / "decade=1800"))
    again = run(spark, source, stop, paths, fmt="text", resume=True)
    assert sorted(os.listdir(tmp_path / "out" / "r" / "unigrams" / "decade=1800")) == before
    assert_same(as_dict(again), expected)
    with pytest.raises(ValueError, match="convert"):
        Run(spark, source, stop, paths, fmt="sequence")


def made(tmp_path, run_id):
    """What identifies each table's current writing."""
    root = tmp_path / "out" / run_id
    return {name: sorted(os.listdir(root / name)) + [os.stat(root / name).st_ino] for name in os.listdir(root)}


def test_resume_does_not_mix_runs(spark, tmp_path):
    """A stage is kept only if it was made from what the run has now."""
    source, stop, expected = small_corpus(spark, tmp_path, 8)
    paths = RunPaths(str(tmp_path / "out"), "r")
    options = {"fmt": "text", "resume": True}
    run(spark, source, stop, paths, **options)
    first = made(tmp_path, "r")
    run(spark, source, stop, paths, **options)
    assert made(tmp_path, "r") == first
    # Another score alone: stages 1 and 2 stay.
    run(spark, source, stop, paths, score_mode="ieee", **options)
    other = made(tmp_path, "r")
    assert {n for n in first if first[n] != other[n]} == {"scores"}
    run(spark, source, stop, paths, **options)
    # The first stage's table is gone: everything behind it is made anew, too.
    shutil.rmtree(tmp_path / "out" / "r" / "unigrams")
    before = made(tmp_path, "r")
    got = run(spark, source, stop, paths, **options)
    after = made(tmp_path, "r")
    assert all(before[n] != after[n] for n in before)
    assert_same(as_dict(got), expected)
    # Other stop words, and another file of 2-grams.
    more = stop.unionByName(spark.createDataFrame([("a",)], stop.schema))
    words = {r.w1 for r in run(spark, source, more, paths, **options).collect()}
    assert "a" not in words and {k[0] for k in expected} - words == ({"a"} & {k[0] for k in expected})
    before = made(tmp_path, "r")
    os.makedirs(source.bigrams, exist_ok=True)
    with open(f"{source.bigrams}/more.txt", "w") as file:
        file.write("b c\t1801\t7\n")
    run(spark, source, more, paths, **options)
    after = made(tmp_path, "r")
    assert {n for n in after if before[n] != after[n]} == {"bigrams", "pairs", "scores"}


def shuffle_files(spark):
    """Of this process' block manager, which is the driver's and, here, the only one."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


@pytest.mark.parametrize("fmt", ["parquet", "text"])
@pytest.mark.parametrize("required", [False, True])
def test_run_in_turns(spark, tmp_path, monkeypatch, nothing_is_small, fmt, required):
    """Keys taken a part at a time give the tables of all keys at once; no shuffle outlives its job."""
    source, stop, expected = small_corpus(spark, tmp_path, 6)
    options = {"fmt": "text", "stage_fmt": fmt, "required": required}
    whole = RunPaths(str(tmp_path / "out"), "whole")
    plain = run(spark, source, stop, whole, **options)
    monkeypatch.setattr(pipeline, "TURN_BYTES", 1)
    parts = RunPaths(str(tmp_path / "out"), "parts")
    assert len(pipeline.turns(spark, source.bigrams, pipeline.MAX_COUNT_TURNS)) > 1
    before = shuffle_files(spark)
    got = run(spark, source, stop, parts, **options)
    assert shuffle_files(spark) <= before
    assert rows_of(got) == rows_of(plain)
    assert_same(as_dict(got), expected)
    assert len(pipeline.turns(spark, parts.bigrams, pipeline.MAX_LOOKUP_TURNS)) > 1
    assert rows_of(spark.read.parquet(parts.bigrams)) == rows_of(spark.read.parquet(whole.bigrams))
    assert rows_of(read_pairs(spark, parts.pairs, fmt)) == rows_of(read_pairs(spark, whole.pairs, fmt))


def test_turns_of_pairs(ngrams, stop_words):
    """Every pair is in one turn, with all of its rows."""
    rows = ngrams([(f"W{i % 40}, x{i % 7}!", 1800 + i % 3, 1) for i in range(400)])
    pairs = prepare_bigrams(rows, "eng", stop_words)
    parts = [rows_of(bigram_counts(pipeline.in_turn(pairs, (k, 3), "w1"))) for k in range(3)]
    assert sorted(sum(parts, [])) == rows_of(bigram_counts(pairs))
    assert all(parts)


def test_a_table_is_whole_after_its_last_turn(spark, tmp_path):
    pairs = spark.sql("SELECT 'a' AS w1, 'b' AS w2, 1800 AS decade, 2L AS c1, 1L AS c12, 9L AS n")
    path = str(tmp_path / "pairs")
    for k in range(3):
        write_pairs(pairs, path, turn=(k, 3))
        assert os.path.exists(f"{path}/_SUCCESS") == (k == 2)
    assert read_pairs(spark, path).count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_pairs(pairs, path, turn=(0, 3))
    with pytest.raises(ValueError, match="whole"):
        write_scores(pairs, path, sorted=True, turn=(0, 3))


def test_a_run_that_consumes_its_ngrams(spark, tmp_path):
    source, stop, expected = small_corpus(spark, tmp_path, 7)
    paths = RunPaths(str(tmp_path / "out"), "r")
    with pytest.raises(ValueError, match="resumed"):
        run(spark, source, stop, paths, fmt="text", consume=True, resume=True)
    assert_same(as_dict(run(spark, source, stop, paths, fmt="text", consume=True)), expected)
    assert not os.path.exists(source.unigrams) and not os.path.exists(source.bigrams)
    assert os.path.exists(tmp_path / "stop")


def test_documents_take_little_disk(spark, tmp_path, monkeypatch):
    """The n-grams of the batch are packed, all of them, and gone when they are counted."""
    words = [f"w{i % 50}" for i in range(3000)]
    docs = [(i, " ".join(words[i:]), "en") for i in range(8)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def spied(spark, source, *args, **options):
        for path in (source.unigrams, source.bigrams):
            names = [x for x in os.listdir(path.removeprefix("file:")) if x.startswith("part-")]
            size = sum(os.path.getsize(f"{path.removeprefix('file:')}/{x}") for x in names)
            lines = [r.value for r in spark.read.text(path).collect()]
            assert size < sum(map(len, lines)) / 4
            seen.append((path, len(lines)))
        return run(spark, source, *args, **options)

    monkeypatch.setattr(pipeline, "run", spied)
    scores = catalogue.run_documents(spark, str(tmp_path))
    tokens = sum(3000 - i for i in range(8))
    assert [n for _, n in seen] == [tokens, tokens - 8]
    assert sum(r.c12 for r in scores.collect()) == tokens - 8
    assert not any(os.path.exists(path.removeprefix("file:")) for path, _ in seen)


def test_manifests(spark, tmp_path):
    folder = str(tmp_path)
    wanted = manifest.expected("words", {"a": "b"}, {"fmt": "text"}, [])
    assert manifest.read_id(spark, folder) is None and not manifest.matches(spark, folder, wanted)
    own = manifest.write(spark, folder, wanted)
    assert manifest.read_id(spark, folder) == own and manifest.matches(spark, folder, wanted)
    assert not [n for n in os.listdir(folder) if own in n]
    assert not manifest.matches(spark, folder, wanted | {"upstream": ["x"]})
    assert manifest.write(spark, folder, wanted) != own
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "word string")
    assert manifest.content(rows) == manifest.content(rows.orderBy(F.desc("word")).repartition(3))
    assert manifest.content(rows) != manifest.content(rows.distinct())
    assert manifest.content(rows.where("false")) == "0 None None"


def test_required_in_a_run(spark, tmp_path):
    """Pairs of a word that the unigrams lack."""
    source = corpus("eng", root=str(tmp_path / "corpus"))
    write_lines(spark, ["a\t1801\t5", "b\t1801\t4"], source.unigrams)
    write_lines(spark, ["a b\t1801\t2", "a c\t1801\t1"], source.bigrams)
    write_lines(spark, ["x"], str(tmp_path / "stop"))
    stop = read_stop_words(spark, str(tmp_path / "stop"))
    for required, words in ((False, ["b", "c"]), (True, ["b"])):
        paths = RunPaths(str(tmp_path / "out"))
        got = run(spark, source, stop, paths, fmt="text", required=required, stage_fmt="text")
        assert sorted(r.w2 for r in got.collect()) == words


def test_run_reads_in_the_jvm(spark, tmp_path):
    """The default way of the job has no Python node, and its pairs cross one exchange per word."""
    source, stop, _ = small_corpus(spark, tmp_path, 6)
    paths = RunPaths(str(tmp_path / "out"))
    batch = Run(spark, source, stop, paths, fmt="text")
    batch.count_words()
    batch.count_pairs()
    rows = read_ngrams(spark, source.bigrams, "text")
    for df in (rows, read_pairs(spark, paths.pairs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan and "Scan ExistingRDD" not in plan
    assert not [p for p in os.listdir(tmp_path / "out" / paths.run_id / "pairs") if "decade=" in p]


def test_job(spark, tmp_path):
    """The batch from the command line: sequence files of Hebrew n-grams to score lines."""
    ones = [("שָׁלוֹם", 1801, 9), ("רב", 1802, 5), ("של", 1803, 7), ("x", 1803, 7)]
    twos = [("שָׁלוֹם רב", 1801, 4), ("של רב", 1801, 1)]
    source = corpus("heb", root=str(tmp_path / "corpus"))
    for rows, target in ((ones, source.unigrams), (twos, source.bigrams)):
        write_sequence(spark, rows, target + "-sequence")
        conversion.main([target + "-sequence", target])
    write_lines(spark, ["של"], str(tmp_path / "stop"))
    arguments = ["heb", "--corpus", str(tmp_path / "corpus"), "--stop-words", str(tmp_path / "stop")]
    arguments += ["--output", str(tmp_path / "out"), "--run-id", "r1"]
    paths = job.main(arguments)
    (line,) = [r.value for r in spark.read.text(paths.scores).collect()]
    key, score = line.split("\tLogLikelihood is: ")
    assert key == "שלום רב 1800"
    # c1 = 9, c2 = 5, c12 = 4, n = 14: p = 5/14, p1 = 4/9, p2 = 1/5.
    expected = 5 * math.log(5 / 14) + 9 * math.log(9 / 14)
    expected -= 4 * math.log(4 / 9) + 5 * math.log(5 / 9) + math.log(1 / 5) + 4 * math.log(4 / 5)
    assert float(score) == pytest.approx(expected)
    job.main([*arguments, "--resume"])
    with pytest.raises(SystemExit):
        job.main(["lat", "--stop-words", "x", "--output", "y"])


def test_workspaces(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as own:
        table = own.materialize(spark.range(3))
        assert table.count() == 3 and os.listdir(tmp_path)
    assert not os.listdir(tmp_path)
    with pytest.raises(ValueError, match="name a folder"):
        Workspace(spark, "")


def test_folder_where_none_is_configured(spark):
    """The same rule for every master: the session's default file system."""

    class Unconfigured:
        conf = type("conf", (), {"get": staticmethod(lambda name, default=None: default)})
        _jsc = spark._jsc

    assert default_folder(Unconfigured).endswith("/tmp/collodec")
    assert default_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("seed", [7])
def test_partitions_and_input_order_do_not_matter(spark, ngrams, stop_words, workspace, seed):
    ones, twos = random_tables(seed)
    one_way = collocations(ngrams(ones).coalesce(1), ngrams(twos).coalesce(1), "eng", stop_words, workspace=workspace)
    random.Random(seed).shuffle(ones)
    random.Random(seed).shuffle(twos)
    other = collocations(ngrams(ones).repartition(7), ngrams(twos).repartition(3), "eng", stop_words, workspace=workspace)
    assert as_dict(one_way) == as_dict(other)


def test_product_properties(spark):
    scores = catalogue.product_collocations(spark, "/root/testdata/sf0.001")
    pairs = bigram_counts(catalogue.product_pairs(spark, "/root/testdata/sf0.001"))
    assert scores.count() == pairs.count()
    assert scores.where("c12 > least(c1, c2) or greatest(c1, c2) > n or llr is null").count() == 0


def test_runs_do_not_share_paths():
    a, b = RunPaths("/x"), RunPaths("/x")
    assert a.run_id != b.run_id and a.scores != b.scores
    assert RunPaths("/x", "r1").unigrams == "/x/r1/unigrams"


def test_corpus():
    assert corpus("heb", root="/c").bigrams == "/c/heb-all/2gram/data"
    assert corpus("eng", unigrams="/1", bigrams="/2").unigrams == "/1"
    for bad in ({"language": "lat", "root": "/c"}, {"language": "eng"}):
        with pytest.raises(ValueError):
            corpus(**bad)


@pytest.mark.parametrize("fmt", ["text", "sequence", "parquet"])
def test_read_ngrams(spark, tmp_path, ngrams, fmt):
    rows = [("god", 1801, 10), ('"quo\\ted', 1802, 2**40), (" x,y ", 1803, 1), ("שלום", 1804, 3)]
    path = str(tmp_path / "in")
    if fmt == "text":
        write_lines(spark, lines(rows), path)
    elif fmt == "sequence":
        write_sequence(spark, rows, path)
    else:
        ngrams(rows).write.parquet(path)
    got = read_ngrams(spark, path, fmt)
    assert got.columns == ["ngram", "year", "occurrences"]
    assert rows_of(got) == sorted(rows)


@pytest.mark.parametrize("bad", ["god\t1801\tmany", "god\tyear\t1", "god\t1801", "god"])
def test_malformed_lines(spark, bad):
    df = spark.createDataFrame([("god\t1801\t10",), (bad,)], "line string")
    assert rows_of(parse_ngram_line(df, "DROPMALFORMED")) == [("god", 1801, 10)]
    with pytest.raises(Exception, match="malformed line: " + bad):
        parse_ngram_line(df).collect()


def test_lines_are_split_once(spark, stop_words):
    lines = spark.range(1).selectExpr("cast(id as string) line")
    pairs = prepare_bigrams(parse_ngram_line(lines), "eng", stop_words)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("split(") == 1


def test_parquet_columns_by_name(spark, tmp_path, ngrams):
    """Other orders and types are cast; a missing column fails, a NULL as the mode says."""
    path = str(tmp_path / "odd")
    spark.sql("SELECT 7 AS occurrences, 'god' AS ngram, '1801' AS year").write.parquet(path)
    assert rows_of(read_ngrams(spark, path)) == [("god", 1801, 7)]
    for column in ("ngram", "year", "occurrences"):
        missing = str(tmp_path / column)
        ngrams([("god", 1801, 1)]).drop(column).write.parquet(missing)
        with pytest.raises(Exception, match=column):
            read_ngrams(spark, missing).collect()
    path = str(tmp_path / "nulls")
    ngrams([("god", 1801, None), ("end", 1802, 2)]).write.parquet(path)
    assert rows_of(read_ngrams(spark, path, mode="DROPMALFORMED")) == [("end", 1802, 2)]
    with pytest.raises(Exception, match="missing value of occurrences"):
        read_ngrams(spark, path).collect()
    with pytest.raises(ValueError, match="unknown mode"):
        read_ngrams(spark, path, mode="PERMISSIVE")


def test_text_with_missing_numbers(spark, tmp_path):
    """NULL is marked and comes back; a line with three measures fails."""
    p = spark.createDataFrame(
        [("a", "b", 1800, None, 2, 8), ("a", "c", 1800, 5, 2, None)],
        "w1 string, w2 string, decade int, c1 bigint, c12 bigint, n bigint",
    )
    write_pairs(p, str(tmp_path / "p"), "text")
    got = {tuple(r) for r in read_pairs(spark, str(tmp_path / "p"), "text").select(*p.columns).collect()}
    assert got == {tuple(r) for r in p.collect()}
    s = spark.createDataFrame([("a", "b", 1800, None)], "w1 string, w2 string, decade int, llr double")
    write_scores(s, str(tmp_path / "s"), "text")
    assert spark.read.text(str(tmp_path / "s")).first()[0] == "a b 1800\tLogLikelihood is: \\N"
    assert read_scores(spark, str(tmp_path / "s"), "text").first().llr is None
    for bad in ("a b 1800\t1 2 3", "a b\t1 2 3 4", "a b 1800"):
        write_lines(spark, [bad], str(tmp_path / f"bad{len(bad)}"))
        with pytest.raises(Exception, match="malformed line"):
            read_pairs(spark, str(tmp_path / f"bad{len(bad)}"), "text").collect()


def test_totals_in_odd_lines(spark, tmp_path):
    write_lines(spark, ["1800 5", "1810", "x y", "1820 7 8"], str(tmp_path / "n"))
    assert rows_of(read_totals(spark, str(tmp_path / "n"), "text", "DROPMALFORMED")) == [(1800, 5)]
    with pytest.raises(Exception, match="malformed line|CAST_INVALID_INPUT"):
        read_totals(spark, str(tmp_path / "n"), "text").collect()


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_round_trips(spark, tmp_path, fmt):
    u = spark.createDataFrame([("a", 1800, 5), ("b", 1810, 3)], "w string, decade int, c bigint")
    write_unigrams(u, str(tmp_path / "u"), fmt)
    assert rows_of(read_unigrams(spark, str(tmp_path / "u"), fmt), *u.columns) == rows_of(u)
    n = spark.createDataFrame([(1800, 5), (1810, 3)], "decade int, n bigint")
    write_totals(n, str(tmp_path / "n"), fmt)
    assert rows_of(read_totals(spark, str(tmp_path / "n"), fmt)) == rows_of(n)
    p = spark.createDataFrame(
        [("a", "b", 1800, 5, 2, 8)],
        "w1 string, w2 string, decade int, c1 bigint, c12 bigint, n bigint",
    )
    write_pairs(p, str(tmp_path / "p"), fmt)
    assert rows_of(read_pairs(spark, str(tmp_path / "p"), fmt), *p.columns) == rows_of(p)


def test_tables_are_laid_out_by_decade(spark, tmp_path):
    """One file for a small decade, however many tasks held its rows."""
    u = spark.range(1000).selectExpr(
        "cast(id as string) w", "cast(1800 + id % 3 * 10 as int) decade", "id c"
    )
    write_unigrams(u.repartition(8), str(tmp_path / "u"))
    files = sorted((tmp_path / "u").glob("decade=*/*.parquet"))
    assert [f.parent.name for f in files] == ["decade=1800", "decade=1810", "decade=1820"]
    one = read_unigrams(spark, str(tmp_path / "u")).where("decade = 1810")
    assert "PartitionFilters: [isnotnull(decade" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 333


def test_text_forms(spark, tmp_path):
    u = spark.createDataFrame([("a", 1800, 5)], "w string, decade int, c bigint")
    write_unigrams(u, str(tmp_path / "u"), "text")
    assert spark.read.text(str(tmp_path / "u")).first()[0] == "a * 1800\t5 0 0 0"
    s = spark.createDataFrame([("a", "b", 1800, -1.5)], "w1 string, w2 string, decade int, llr double")
    write_scores(s, str(tmp_path / "s"), "text")
    assert spark.read.text(str(tmp_path / "s")).first()[0] == "a b 1800\tLogLikelihood is: -1.5"


def test_orders(spark):
    rows = [
        ("b", "a", 1800, 5, 2),
        ("a", "é", 1800, 5, 2),
        ("a", "z", 1800, 4, 2),
        ("a", None, 1800, 9, 9),
        (None, None, 1800, 9, 10),
        ("a", "b", 1790, 1, 1),
        ("\U0001f600", "b", 1790, 1, 3),
        ("￮", "b", 1790, 1, 4),
    ]
    df = spark.createDataFrame(rows, "w1 string, w2 string, decade int, c1 bigint, c12 bigint")
    df = df.repartition(4)
    # None sorts before any bytes.
    by_key = sorted(rows, key=lambda r: (r[2], (r[0] or "").encode(), (r[1] or "").encode()))
    positions = {tuple(r)[:5]: r.position for r in with_position(key_order(df)).collect()}
    assert sorted(rows, key=positions.get) == by_key
    assert sorted(positions.values()) == list(range(1, len(rows) + 1))
    pairs = df.where("w2 is not null")
    got = [(r.c12, r.c1) for r in order_by_counts(pairs).collect()]
    assert got == sorted(got)
