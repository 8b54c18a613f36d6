"""Reads and writes in the shape of option calls, over the native scan and append.

``reader(spark).option(...).load()`` and ``writer(df).option(...).mode("append").save()`` take the
options ``uri``, ``database``, ``collection``, ``batchsize`` and ``token``. They plan what
``read_collection`` and ``append_collection`` plan, so columns and partitions are pruned, files
are split, and binding, auto ids and file systems are the same.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vectable.operators.batches import map_batches
from vectable.plans.options import CollectionOptions
from vectable.sources.collection import append_collection, read_collection


class _Options:
    def __init__(self) -> None:
        self._given: dict[str, object] = {}

    def option(self, key: str, value: object):
        self._given[key] = value
        return self

    def options(self, **given: object):
        self._given.update(given)
        return self


class Reader(_Options):
    """Options of a read; ``partition`` restricts it to one partition."""

    def __init__(self, spark: SparkSession) -> None:
        super().__init__()
        self._spark = spark

    def load(self) -> DataFrame:
        return read_collection(self._spark, self._given, self._given.get("partition"))

    def map_batches(self, func: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
        """``func`` over the rows, ``batchsize`` at a time."""
        return map_batches(self.load(), func, schema, CollectionOptions.of(self._given).batchsize)


class Writer(_Options):
    """Options of a write; ``table`` names a SQL table over the collection to refresh."""

    def __init__(self, df: DataFrame) -> None:
        super().__init__()
        self._df = df
        self._mode = "append"

    def mode(self, mode: str) -> Writer:
        self._mode = mode
        return self

    def save(self) -> None:
        append_collection(self._df, self._given, self._mode, table=self._given.get("table"))


def reader(spark: SparkSession) -> Reader:
    return Reader(spark)


def writer(df: DataFrame) -> Writer:
    return Writer(df)
