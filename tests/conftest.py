import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("collodec-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    from collodec import Workspace

    with Workspace(spark, str(tmp_path / "tables")) as own:
        yield own
    assert not os.listdir(tmp_path / "tables")


@pytest.fixture
def ngrams(spark):
    def build(rows):
        return spark.createDataFrame(rows, "ngram string, year int, occurrences bigint")

    return build


@pytest.fixture
def stop_words(spark):
    return spark.createDataFrame([("the",), ("cant",)], "word string")


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())
