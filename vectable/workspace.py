"""The shared folder for tables the package writes on its own account."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vectable.sources.paths import delete, qualified


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one beside the warehouse's tables.

    Both are places that the driver and all executors reach; on a cluster a warehouse in a local folder
    may not be one, and is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = qualified(spark, spark.conf.get("spark.sql.warehouse.dir"))
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_vectable_scratch"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/vectable/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder."""
    delete(spark, _own_folder(spark))


def pinned(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder, so a recomputed task sees the same rows."""
    path = fresh_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
