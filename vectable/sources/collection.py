"""Read a collection as a DataFrame and append DataFrames to it.

Both directions are Spark's own Parquet source, so column pruning, predicate
pushdown and partition pruning on ``__partition`` come from Catalyst.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.plans.binder import bind
from vectable.plans.errors import SaveModeError
from vectable.plans.options import CollectionOptions
from vectable.plans.schema import PARTITION_COLUMN, CollectionSchema
from vectable.plans.sqltext import quoted_name
from vectable.sources import paths
from vectable.sources.autoid import auto_ids
from vectable.sources.catalog import Options, open_collection
from vectable.sources.tables import add_partitions, follow, partition_names

# Salts per writer's share of rows when adaptive execution cannot split a hot partition value:
# enough that hashing spreads one value evenly over its writers.
SALTS_PER_WRITER = 4
SALTS = "__salts"


def read_collection(spark: SparkSession, options: Options, partition: str | None = None) -> DataFrame:
    """Every committed row of a collection, in field order, tagged with ``__partition``.

    ``partition`` restricts the scan to one partition's directory.
    """
    opts, schema = open_collection(spark, options)
    # The schema is always given: inference would read footers and turn a partition
    # named "01" into the number 1.
    df = spark.read.schema(schema.struct).parquet(opts.data_path)
    return df if partition is None else df.where(F.col(PARTITION_COLUMN) == partition)


def count_rows(spark: SparkSession, options: Options, partition: str | None = None) -> int:
    """The number of committed rows, from the footers of the files; no column is read.

    Spark pushes a count into its second Parquet source only, which a session of its own switches on.
    """
    opts, schema = open_collection(spark, options)
    # Pushed down, the count of no files at all is null.
    return _counted(spark, schema, opts, partition).first()[0] or 0


def _counted(spark: SparkSession, schema: CollectionSchema, opts: CollectionOptions, partition: str | None) -> DataFrame:
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = footers.read.schema(schema.struct).parquet(opts.data_path)
    if partition is not None:
        rows = rows.where(F.col(PARTITION_COLUMN) == partition)
    return rows.agg(F.count("*").alias("row_count"))


def list_partitions(spark: SparkSession, options: Options) -> DataFrame:
    """Partition names that hold rows, from the directory names; no file is opened."""
    opts, _ = open_collection(spark, options)
    names = partition_names(spark, opts.data_path)
    return spark.createDataFrame([(n,) for n in names], f"{PARTITION_COLUMN} string")


def append_collection(
    df: DataFrame,
    options: Options,
    mode: str = "append",
    table: str | None = None,
    aligned: bool = False,
) -> None:
    """Append ``df`` to an existing collection, each row to the partition it names.

    Columns are taken by name, checked and cast (see ``plans.binder``); auto ids are
    generated; function outputs are skipped. Spark's file committer publishes the
    rows when the job ends, so a failed append leaves nothing behind. Appends may run
    side by side: each has pending files of its own, and auto ids of its own.

    ``table`` names a SQL table over the collection (``sources.tables``) to refresh.
    ``aligned`` skips the routing shuffle for input that already comes partition by
    partition, such as another collection's scan.
    """
    if str(mode).lower() != "append":
        raise SaveModeError(f"Only Append mode is supported, not {mode}")
    spark = df.sparkSession
    opts, schema = open_collection(spark, options)
    bound = bind(df, schema)
    routed = bound if aligned else _route(bound)
    if table is not None:
        follow(spark, opts, table)
    before = set(partition_names(spark, opts.data_path)) if table is not None else set()
    with auto_ids(routed, schema, opts) as filled, own_attempt(spark, opts.data_path) as options_of_attempt:
        writer = filled.write.mode("append").partitionBy(PARTITION_COLUMN).options(**options_of_attempt)
        if opts.batchsize_given:
            writer = writer.option("maxRecordsPerFile", opts.batchsize)
        writer.parquet(opts.data_path)
    if table is not None:
        add_partitions(spark, table, [n for n in partition_names(spark, opts.data_path) if n not in before])


@contextmanager
def own_attempt(spark: SparkSession, data_path: str) -> Iterator[dict[str, str]]:
    """Write options by which the committer keeps a job's pending files apart from other jobs'.

    By default all jobs share one folder of pending files, and the first to end deletes it.
    """
    number = uuid.uuid4().int & 0x7FFFFFFF
    skip = "mapreduce.fileoutputcommitter.cleanup.skipped"
    try:
        yield {"mapreduce.job.application.attempt.id": str(number), skip: "true"}
    finally:
        paths.delete(spark, f"{data_path}/_temporary/{number}")
        paths.delete_empty(spark, f"{data_path}/_temporary")


def copy_collection(spark: SparkSession, source: Options, target: Options) -> None:
    """Append all rows of one collection to another, without a shuffle."""
    append_collection(read_collection(spark, source), target, aligned=True)


def _route(df: DataFrame) -> DataFrame:
    """Bring the rows of a partition together, but a hot partition to many tasks.

    Under adaptive execution the rebalance splits partition values above the advisory
    size and packs small ones, by measured sizes. Without it the rows of each value are
    counted first: a value of more than a writer's share of all rows is spread by a salt, over
    writers in proportion; any other has one writer.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled") == "true":
        return df.hint("rebalance", PARTITION_COLUMN)
    writers = int(conf.get("spark.sql.shuffle.partitions"))
    share = max(1, df.count() // writers)
    counts = df.groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"))
    salts = F.ceil(F.lit(SALTS_PER_WRITER) * F.col("rows") / share).cast("int").alias(SALTS)
    hot = counts.where(F.col("rows") > share).select(PARTITION_COLUMN, salts)  # fewer than the writers
    # Content and task, both the same when a task is recomputed; equal rows of many tasks spread by
    # the task, and of one task by their place in it.
    plain = [quoted_name(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]
    salt = F.pmod(F.xxhash64(*plain, F.monotonically_increasing_id()), F.coalesce(SALTS, F.lit(1)))
    spread = df.join(F.broadcast(hot), PARTITION_COLUMN, "left").repartition(PARTITION_COLUMN, salt)
    return spread.select(*[quoted_name(c) for c in df.columns])
