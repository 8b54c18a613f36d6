"""SQL tables over collections: native Parquet tables, read-only by convention.

``INSERT INTO`` such a table would bypass the binder's checks; append through
``sources.collection`` instead.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from vectable.plans.schema import PARTITION_COLUMN
from vectable.plans.sqltext import quoted_name, text_literal
from vectable.sources import paths
from vectable.sources.catalog import Options, open_collection


def create_table(spark: SparkSession, options: Options, table: str) -> None:
    """Create the external table ``table`` over an existing collection.

    Spark keeps every column of a table over files as nullable, whatever it is declared as;
    ``describe_collection`` says which fields may be null.
    """
    opts, schema = open_collection(spark, options)
    columns = ", ".join(
        f"{quoted_name(f.name)} {f.dataType.simpleString()} COMMENT {text_literal(f.metadata.get('comment', ''))}"
        for f in schema.struct.fields
    )
    location = text_literal(paths.qualified(spark, opts.data_path))
    spark.sql(
        f"CREATE TABLE {_quoted(table)} ({columns}) USING parquet PARTITIONED BY ({PARTITION_COLUMN}) LOCATION {location}"
    )
    repair_table(spark, table)


def follow(spark: SparkSession, options: Options, table: str) -> None:
    """Define the table anew if its collection was replaced since."""
    opts, _ = open_collection(spark, options)
    name = _quoted(table)
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    if [f["data_type"] for f in facts] != [paths.qualified(spark, opts.data_path)]:
        spark.sql(f"DROP TABLE {name}")  # external: no file is touched
        create_table(spark, opts, table)


def repair_table(spark: SparkSession, table: str) -> None:
    """Make all partitions and files that were added visible to SQL."""
    spark.catalog.recoverPartitions(_quoted(table))
    spark.catalog.refreshTable(_quoted(table))


def add_partitions(spark: SparkSession, table: str, names: list[str]) -> None:
    """Make new partitions, and new files in known ones, visible to SQL."""
    if names:
        each = " ".join(f"PARTITION ({PARTITION_COLUMN} = {text_literal(name)})" for name in names)
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS {each}")
    spark.catalog.refreshTable(_quoted(table))


def partition_names(spark: SparkSession, data_path: str) -> list[str]:
    """Partitions that hold a data file, from Spark's own index of the files.

    Spark lists many folders in parallel; what comes back to Python is a name per partition, not per file.
    """
    scan = spark.read.schema(f"{PARTITION_COLUMN} string").parquet(data_path)
    found = scan._jdf.queryExecution().analyzed().relation().location().partitionSpec().partitions()
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [part.path().getName() for part in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found)]
    return sorted(unescape(name.partition("=")[2]) for name in names)


def _quoted(table: str) -> str:
    """The name's parts, each quoted; a part may be quoted already."""
    return ".".join(quoted_name(part.strip("`")) for part in table.split("."))
