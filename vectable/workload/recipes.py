"""Example collections derived from the test tables, and where they are kept.

Each recipe is a definition plus a DataFrame over the whole source table. A
collection that queries only read is written once per session; one that a query
writes to gets a fresh folder each time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.half import encode_bf16, encode_fp16
from vectable.plans.options import CollectionOptions
from vectable.plans.schema import PARTITION_COLUMN, CollectionSchema, Field
from vectable.sources.catalog import create_collection, has_collection
from vectable.sources.collection import append_collection
from vectable.sources.tables import create_table
from vectable.workspace import clear_scratch, fresh_folder

HELLO = CollectionSchema(
    [
        Field("id", "Int64", primary_key=True, description="row number"),
        Field("f2", "Bool"),
        Field("f3", "Int8"),
        Field("f4", "Int16"),
        Field("f5", "Int32"),
        Field("f6", "Int64"),
        Field("f7", "Float", description="first coordinate"),
        Field("f8", "Double"),
        Field("f9", "VarChar", max_length=1024),
        Field("f10", "Array", element_type="VarChar", max_capacity=1024, max_length=1024),
        Field("f10_2", "Array", element_type="Int32", max_capacity=1024),
        Field("f11", "JSON", nullable=True, description="free-form attributes"),
        Field("vec_dense", "FloatVector", dim=64, metric="COSINE"),
        Field("vec_binary", "BinaryVector", dim=64, metric="HAMMING"),
        Field("vec_sparse", "SparseFloatVector", metric="IP"),
        Field("vec_fp16", "Float16Vector", dim=64, metric="COSINE"),
        Field("vec_bf16", "BFloat16Vector", dim=64, metric="COSINE"),
    ],
    "every field type once",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packed_byte(first: int) -> str:
    """Eight signs of the embedding from position ``first`` on, high bit first, as a signed byte."""
    top, *rest = (f"IF(e[{first + i}] > 0, {1 << (7 - i)}, 0)" for i in range(8))
    return f"CAST({' + '.join(rest)} - {top} AS TINYINT)"


def _wrapped_int(number: str) -> str:
    """The number as Int32, wrapping round where a large table runs past its range."""
    return f"CAST(pmod({number} + 2147483648, 4294967296) - 2147483648 AS INT)"


def hello_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of the HELLO definition per embedding."""
    rows = _table(spark, sf_dir, "embeddings").selectExpr("vec_id AS v", "embedding AS e", "label")
    steps = "sequence(0, CAST(v % 5 + 4 AS INT))"
    return rows.selectExpr(
        "v AS id",
        "v % 2 = 0 AS f2",
        "CAST(v % 256 - 128 AS TINYINT) AS f3",
        "CAST((v * 131) % 65536 - 32768 AS SMALLINT) AS f4",
        f"{_wrapped_int('v * 7919 - 1000000')} AS f5",
        "v * 1000003 AS f6",
        "e[0] AS f7",
        "CAST(e[1] AS DOUBLE) AS f8",
        "concat('vec-', v) AS f9",
        f"transform({steps}, k -> concat('string-', v, '-', k)) AS f10",
        f"transform({steps}, k -> {_wrapped_int('v * k - 100')}) AS f10_2",
        """CASE WHEN v % 11 <> 0 THEN concat('{"path":"root/abc/path', v, '","size":', v,
            IF(v % 7 = 0, ',"special":true', ''), ',"flags":[', v, ',', v + 1, ',', v + 2, ']}') END AS f11""",
        "e AS vec_dense",
        f"array({', '.join(_packed_byte(8 * i) for i in range(8))}) AS vec_binary",
        "map_from_entries(transform(e, (x, i) -> struct(i * 15013 + v % 7, x))) AS vec_sparse",
        f"IF(label < 5, '_default', concat('p', label)) AS {PARTITION_COLUMN}",
    ).select(
        *[f.name for f in HELLO.fields[:-2]],
        encode_fp16("vec_dense").alias("vec_fp16"),
        encode_bf16("vec_dense").alias("vec_bf16"),
        PARTITION_COLUMN,
    )


HELLO_ARRAYS = CollectionSchema(
    [
        Field("id", "Int64", primary_key=True),
        Field("a_bool", "Array", element_type="Bool"),
        Field("a_int8", "Array", element_type="Int8"),
        Field("a_int16", "Array", element_type="Int16"),
        Field("a_int32", "Array", element_type="Int32"),
        Field("a_int64", "Array", element_type="Int64"),
        Field("a_float", "Array", element_type="Float"),
        Field("a_double", "Array", element_type="Double"),
        Field("a_string", "Array", element_type="String"),
        Field("a_varchar", "Array", element_type="VarChar", max_capacity=4, max_length=64),
    ],
    "every array element type once",
)


def hello_arrays_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-element arrays of the scalar fields; integers arrive wide and are narrowed by the binder."""
    return hello_rows(spark, sf_dir).selectExpr(
        "id",
        "array(f2, NOT f2) AS a_bool",
        "array(INT(f3), -INT(f3) - 1) AS a_int8",
        "array(BIGINT(f4), -BIGINT(f4) - 1) AS a_int16",
        "array(BIGINT(f5), -BIGINT(f5)) AS a_int32",
        "array(f6, -f6) AS a_int64",
        "array(DOUBLE(f7), f8) AS a_float",
        "array(f8, -f8) AS a_double",
        "array(f9, upper(f9)) AS a_string",
        "array(f9, concat(f9, '!')) AS a_varchar",
        PARTITION_COLUMN,
    )


HELLO_AUTO = CollectionSchema(
    [replace(f, auto_id=True) if f.primary_key else f for f in HELLO.fields], "ids drawn on append"
)

# The hidden field stands before arrays and vectors, where a lookup by position would slip.
HELLO_FN = CollectionSchema(
    [
        *HELLO.fields[:9],
        Field("sparse_out", "SparseFloatVector", metric="IP", function_output=True),
        *HELLO.fields[9:],
    ],
    "one function output",
)

HELLO_NULLS = CollectionSchema([replace(f, nullable=not f.primary_key) for f in HELLO.fields], "all nullable")


def hello_nulls_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row ``v`` has a null in field number ``v`` modulo the field count, except for the key."""
    rows = hello_rows(spark, sf_dir)
    count = len(HELLO.fields)
    blanked = [f"IF(id % {count} <> {i}, {f.name}, NULL) AS {f.name}" for i, f in enumerate(HELLO.fields) if i]
    return rows.selectExpr("id", *blanked, PARTITION_COLUMN)


def hello_shuffled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The HELLO rows with columns in the opposite order."""
    rows = hello_rows(spark, sf_dir)
    return rows.select(*reversed(rows.columns))


LINEITEM = CollectionSchema(
    [
        Field("l_orderkey", "Int64"),
        Field("l_partkey", "Int64"),
        Field("l_suppkey", "Int64"),
        Field("l_linenumber", "Int32"),
        Field("l_quantity", "Double"),
        Field("l_extendedprice", "Double"),
        Field("l_discount", "Double"),
        Field("l_tax", "Double"),
        Field("l_linestatus", "VarChar", max_length=1),
        Field("l_shipdate", "VarChar", max_length=32),
    ],
    "scalar fields at scale",
)


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem")
    return rows.withColumns(
        {"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"), PARTITION_COLUMN: F.col("l_returnflag")}
    )


EVENTS = CollectionSchema(
    [
        Field("event_id", "Int64", primary_key=True),
        Field("user_id", "Int64"),
        Field("ts", "VarChar", max_length=26),
        Field("event_type", "VarChar", max_length=32),
        Field("value", "Double"),
        Field("props", "JSON", nullable=True),
    ],
    "JSON at scale",
)


def events_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events")
    return rows.withColumns(
        {"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), PARTITION_COLUMN: F.col("event_type")}
    )


Rows = Callable[[SparkSession, str], DataFrame]
RECIPES: dict[str, tuple[CollectionSchema, Rows]] = {
    "hello": (HELLO, hello_rows),
    "hello_arrays": (HELLO_ARRAYS, hello_arrays_rows),
    "hello_auto": (HELLO_AUTO, hello_rows),
    "hello_fn": (HELLO_FN, hello_rows),
    "hello_nulls": (HELLO_NULLS, hello_nulls_rows),
    "hello_shuffled": (HELLO, hello_shuffled_rows),
    "lineitem_coll": (LINEITEM, lineitem_rows),
    "events_coll": (EVENTS, events_rows),
}

_kept: dict[tuple[str, str, str], CollectionOptions] = {}


def kept_collection(spark: SparkSession, sf_dir: str, name: str) -> CollectionOptions:
    """The named collection, written once per session and table folder; only read it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept or not has_collection(spark, _kept[key]):
        _kept[key] = new_collection(spark, sf_dir, name)
    return _kept[key]


_tables: dict[tuple[str, str, str], str] = {}


def kept_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The SQL table over the kept collection, created once per session; see ``clear_kept``."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables or not spark.catalog.tableExists(_tables[key]):
        _tables[key] = f"{name}_{uuid.uuid4().hex}"
        create_table(spark, kept_collection(spark, sf_dir, name), _tables[key])
    return _tables[key]


def clear_kept(spark: SparkSession) -> None:
    """Drop the session's tables and all it wrote below the shared folder; results read before are void."""
    for key in [k for k in _tables if k[0] == spark.sparkContext.applicationId]:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(key)}")
    for key in [k for k in _kept if k[0] == spark.sparkContext.applicationId]:
        del _kept[key]
    clear_scratch(spark)


def new_collection(spark: SparkSession, sf_dir: str, name: str, batchsize: int | None = None) -> CollectionOptions:
    """The named collection in a fresh folder, filled from its recipe."""
    schema, rows = RECIPES[name]
    options = empty_collection(spark, name, schema, batchsize)
    append_collection(rows(spark, sf_dir), options)
    return options


def empty_collection(
    spark: SparkSession, name: str, schema: CollectionSchema, batchsize: int | None = None
) -> CollectionOptions:
    """An empty collection in a fresh folder."""
    given = {"uri": fresh_folder(spark), "collection": name}
    if batchsize is not None:
        given["batchsize"] = batchsize
    options = CollectionOptions.of(given)
    create_collection(spark, options, schema)
    return options
