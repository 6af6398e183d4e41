"""Intermediate tables, in storage that outlives executors, and who owns them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    """(file system, path) as the cluster knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the table."""
    return exists(spark, f"{path}/_SUCCESS")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What all files below a path, or a pattern of paths, take."""
    files, where = _file_system(spark, path)
    return sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(where) or [])


#: Whether Spark deletes a job's shuffle files when the job is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs in it are deleted as each is done.

    Else they stay until the driver happens to collect its garbage. For jobs that end in a
    table: nothing reads their shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def default_folder(spark: SparkSession) -> str:
    """The configured checkpoint folder, else one in the session's default file system.

    A cluster shares both; the rule is the same for every master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").rstrip("/") + "/tmp/collodec"


class Workspace:
    """A folder of its own for the intermediate tables of some work.

    ``with Workspace(spark, folder) as workspace:`` deletes all of it at the end; what was
    made from the tables has to be written by then. Every executor has to see ``folder``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        if not folder:
            raise ValueError("name a folder that all executors share")
        self.spark = spark
        self.path = f"{folder.rstrip('/')}/collodec-{uuid.uuid4().hex}"

    def new_path(self) -> str:
        return f"{self.path}/{uuid.uuid4().hex}"

    def materialize(self, df: DataFrame) -> DataFrame:
        """df as a table written to the folder and read back.

        A table and not ``checkpoint()``: it is columnar, so that its readers prune
        columns, and its size is known when they are planned.
        """
        path = self.new_path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        self.close()
