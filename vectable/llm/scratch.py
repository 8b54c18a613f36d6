"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from vectable.sources.paths import delete
from vectable.workspace import fresh_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes what a query has shuffled as soon as the query ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def kept(df: DataFrame, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a cut of the lineage."""
    spark = df.sparkSession
    path = fresh_folder(spark)
    with shuffles_deleted(spark):
        df.write.parquet(path, compression=codec)
    found = spark.read.schema(df.schema).parquet(path)
    _paths[found] = path
    return found


def forget(table: DataFrame) -> None:
    """Delete the files of a ``kept`` table that nothing reads any more."""
    delete(table.sparkSession, _paths.pop(table))
