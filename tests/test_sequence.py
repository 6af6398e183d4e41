"""Sequence files in byte ranges, against Hadoop's reader."""

import io
import os
import random

import pytest

from collodec.sources import sequence
from collodec.sources.ngrams import read_ngrams
from collodec.sources.sequence import read_header, read_range, read_sequence

OUTPUT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"
LONG, TEXT = "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text"


def write(spark, texts, path, parts=2, **conf):
    """Keys past the int range, as Python integers below it become IntWritable."""
    keyed = spark.sparkContext.parallelize([(2**33 + i, x) for i, x in enumerate(texts)], parts)
    keyed.saveAsNewAPIHadoopFile(path, OUTPUT, LONG, TEXT, conf=conf)


def some_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab\té שלום\0") for _ in range(rng.choice([0, 1, 5, 30, 127, 128, 129, 300, 40_000 if not i % 500 else 3]))) for i in range(n)]


def files_in(path):
    return [f"{path}/{name}" for name in sorted(os.listdir(path)) if name.startswith("part")]


def whole(path, cuts, stretch):
    data = open(path, "rb").read()
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(data)]):
        for values in read_range(io.BytesIO(data), path, a, b, len(data), stretch):
            out += values.to_pylist()
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ranges_cut_anywhere(spark, tmp_path, seed):
    """Also within a record, a mark, the header, or the bytes read at once."""
    texts = some_texts(seed, 4000)
    write(spark, texts, str(tmp_path / "in"), parts=1)
    (path,) = files_in(str(tmp_path / "in"))
    rng = random.Random(seed)
    data = open(path, "rb").read()
    sync, first = read_header(data, path)
    mark = data.find(b"\xff\xff\xff\xff" + sync)
    assert mark > 0
    cuts = [[], [first], [5], [mark], [mark + 1], [mark + 19], [mark + 20], [first, first + 1, first + 2]]
    cuts += [sorted(rng.sample(range(1, len(data)), k)) for k in (1, 2, 5, 20)]
    for own in cuts:
        for stretch in (1 << 22, rng.randrange(50, 5000)):
            assert whole(path, own, stretch) == texts


def test_against_the_hadoop_reader(spark, tmp_path):
    texts = [f"{a}\t{1800 + i % 50}\t{i}" for i, a in enumerate(t.replace("\t", "") for t in some_texts(9, 3000))]
    path = str(tmp_path / "in")
    write(spark, texts, path, parts=3)
    got = sorted(r.value for r in read_sequence(spark, path, range_bytes=10_000).collect())
    assert got == sorted(texts)
    assert len(sequence._files(spark, path)) == 3 == len(sequence._files(spark, f"{path}/part-*"))
    rows = [sorted(map(tuple, read_ngrams(spark, path, fmt).collect())) for fmt in ("sequence", "sequence-hadoop")]
    assert rows[0] == rows[1] and len(rows[0]) == len(texts)
    plan = read_ngrams(spark, path, "sequence")._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "collodec-sequence" in plan


def test_odd_files(spark, tmp_path):
    write(spark, [], str(tmp_path / "none"))
    assert read_sequence(spark, str(tmp_path / "none")).count() == 0
    compressed = {"mapreduce.output.fileoutputformat.compress": "true", "mapreduce.output.fileoutputformat.compress.type": "BLOCK"}
    write(spark, ["a\t1801\t3"], str(tmp_path / "block"), **compressed)
    with pytest.raises(Exception, match="compressed; read it as 'sequence-hadoop'"):
        read_sequence(spark, str(tmp_path / "block")).collect()
    assert [tuple(r) for r in read_ngrams(spark, str(tmp_path / "block"), "sequence-hadoop").collect()] == [("a", 1801, 3)]
    with pytest.raises(ValueError, match="no files"):
        read_sequence(spark, str(tmp_path / "nowhere"))
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "part-0").write_text("no sequence file")
    with pytest.raises(Exception, match="no sequence file of version 6"):
        read_sequence(spark, str(tmp_path / "text")).collect()
