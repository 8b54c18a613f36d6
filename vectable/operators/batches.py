"""Bounded batches over a collection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.plans.schema import PARTITION_COLUMN
from vectable.plans.sqltext import quoted_name


def batch_plan(df: DataFrame, batchsize: int) -> DataFrame:
    """Rows of each partition, and in how many batches ``map_batches`` delivers them."""
    rows = F.count(F.lit(1))
    per_task = df.select(PARTITION_COLUMN, F.spark_partition_id().alias("task")).groupBy(PARTITION_COLUMN, "task")
    counted = per_task.agg(rows.alias("rows"), F.ceil(rows / F.lit(batchsize)).alias("batches"))
    return counted.groupBy(PARTITION_COLUMN).agg(F.sum("rows").alias("row_count"), F.sum("batches").alias("batches"))


def map_batches(
    df: DataFrame,
    func: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: T.StructType | str,
    batchsize: int,
) -> DataFrame:
    """Apply ``func`` to the rows of ``df``, ``batchsize`` at a time.

    Tasks work on their own splits side by side. A batch holds rows of one ``__partition`` of one
    split, and only the last batch of each is smaller. Without that column a split is one partition.
    """
    tagged = PARTITION_COLUMN in df.columns

    def in_batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[pa.RecordBatch]] = {}
        for batch in incoming:
            for name, part in _by_partition(batch) if tagged else [(None, batch)]:
                waiting = held.setdefault(name, [])
                waiting.append(part)
                if sum(b.num_rows for b in waiting) >= batchsize:
                    whole = pa.concat_batches(waiting)
                    full = whole.num_rows // batchsize * batchsize
                    for start in range(0, full, batchsize):
                        yield func(whole.slice(start, batchsize))
                    held[name] = [whole.slice(full)]
        for waiting in held.values():
            if sum(b.num_rows for b in waiting):
                yield func(pa.concat_batches(waiting))

    return df.mapInArrow(in_batches, schema)


def _by_partition(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The batch in runs of rows of one partition."""
    names = batch.column(PARTITION_COLUMN).to_pylist()
    start = 0
    for end in range(1, len(names) + 1):
        if end == len(names) or names[end] != names[start]:
            yield names[start], batch.slice(start, end - start)
            start = end


def batch_addresses(df: DataFrame, batchsize: int) -> DataFrame:
    """Where the batches of a scan lie: partition, file, first row in it (from 0) and number of rows.

    ``df`` is a collection's scan, filtered by partition at most. A batch is a run of rows of one file, so
    addresses depend on the files alone and not on how tasks split them; files are only ever added by
    appends, so an address stays good, and a job that broke off can go on behind the last address done.
    Only the row counts of the files are read.
    """
    name = F.col("_metadata.file_path").alias("file")
    counted = df.select(PARTITION_COLUMN, name).groupBy(PARTITION_COLUMN, "file").agg(F.count("*").alias("held"))
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("held") - 1, F.lit(batchsize).cast("long")))
    placed = counted.select("*", start.alias("start"))
    return placed.select(PARTITION_COLUMN, "file", "start", F.least(F.col("held") - F.col("start"), F.lit(batchsize)).alias("rows"))


def with_address(df: DataFrame, batchsize: int) -> DataFrame:
    """The rows of a collection's scan, each with ``file`` and ``start`` of its batch."""
    number = F.col("_metadata.row_index")
    return df.select("*", F.col("_metadata.file_path").alias("file"), (number - number % batchsize).alias("start"))


def read_batch(df: DataFrame, address: Row, columns: list[str] | None = None) -> DataFrame:
    """The rows of one batch of ``df``, a collection's scan, in their order in the file; only that file is opened."""
    names = [f.name for f in df.schema.fields if f.name != PARTITION_COLUMN]
    plain = df.sparkSession.read.schema(df.select(*map(quoted_name, names)).schema).parquet(address["file"])
    number, start = F.col("_metadata.row_index"), address["start"]
    own = plain.where((number >= start) & (number < start + address["rows"])).orderBy("_metadata.row_index")
    tagged = own.select(*map(quoted_name, names), F.lit(address[PARTITION_COLUMN]).alias(PARTITION_COLUMN))
    return tagged if columns is None else tagged.select(*map(quoted_name, columns))
