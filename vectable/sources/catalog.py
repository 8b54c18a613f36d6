"""Create, find, describe and drop collections.

Layout: ``<uri>/<database>/<collection>/data/__partition=<name>/*.parquet`` with
the definition in ``_collection.json`` beside ``data``. The definition is written
last on create and removed first on drop, so a half-made or half-dropped
collection is simply absent. A replaced collection's data are in a folder
``data-<version>`` that its definition names; the new definition takes the old one's
place in one step.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vectable.plans.errors import CollectionExistsError, CollectionNotFoundError
from vectable.plans.options import CollectionOptions
from vectable.plans.schema import CollectionSchema
from vectable.sources import paths

Options = CollectionOptions | Mapping[str, object]

DESCRIPTION_STRUCT = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
        T.StructField("comment", T.StringType(), False),
    ]
)


def create_collection(
    spark: SparkSession, options: Options, schema: CollectionSchema, replace: bool = False
) -> None:
    """Create an empty collection; with ``replace``, in place of one of that name.

    Until the new definition is there, the old collection is whole, also if the replacing fails;
    from then on it is the new one, and the old rows are removed.
    """
    opts = CollectionOptions.of(options)
    old = None
    if has_collection(spark, opts):
        if not replace:
            raise CollectionExistsError(f"Collection {opts.collection} already exists in database {opts.database}")
        old, _ = open_collection(spark, opts)
    # A folder of an earlier collection, also one whose drop was interrupted, is never used again.
    used = paths.exists(spark, opts.data_path) or paths.exists(spark, opts.ids_path)
    new = dataclasses.replace(opts, version=uuid.uuid4().hex if used else "")
    paths.make_dirs(spark, new.data_path)
    if old is None:
        paths.write_new_text(spark, new.descriptor_path, schema.to_json(new.version))
        return
    paths.replace_text(spark, new.descriptor_path, schema.to_json(new.version))
    paths.delete(spark, old.ids_path)
    paths.delete(spark, old.data_path)


def drop_collection(spark: SparkSession, options: Options) -> bool:
    """Remove a collection with its data; False if there was none."""
    opts = CollectionOptions.of(options)
    found = paths.delete(spark, opts.descriptor_path)
    # Leftovers of an interrupted create, replace or drop go as well.
    for name in paths.children(spark, opts.collection_path):
        if name.partition("-")[0] in ("data", "_ids"):
            found = paths.delete(spark, f"{opts.collection_path}/{name}") or found
    return found


def has_collection(spark: SparkSession, options: Options) -> bool:
    return paths.exists(spark, CollectionOptions.of(options).descriptor_path)


def load_schema(spark: SparkSession, options: Options) -> CollectionSchema:
    """The definition of an existing collection."""
    return open_collection(spark, options)[1]


def open_collection(spark: SparkSession, options: Options) -> tuple[CollectionOptions, CollectionSchema]:
    """The options of an existing collection, with the version of its data, and its definition."""
    opts = CollectionOptions.of(options)
    if not has_collection(spark, opts):
        raise CollectionNotFoundError(
            f"Collection {opts.collection} does not exist in database {opts.database}"
        )
    text = paths.read_text(spark, opts.descriptor_path)
    version = json.loads(text).get("version", "")
    return dataclasses.replace(opts, version=version), CollectionSchema.from_json(text)


def describe_collection(spark: SparkSession, options: Options) -> DataFrame:
    """One row per readable column, from the definition rather than the files."""
    struct = load_schema(spark, options).struct
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment", ""))
        for i, f in enumerate(struct.fields)
    ]
    return spark.createDataFrame(rows, DESCRIPTION_STRUCT)


def list_function_outputs(spark: SparkSession, options: Options) -> DataFrame:
    """Names of the fields hidden from reads and writes."""
    names = load_schema(spark, options).function_outputs
    return spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField("name", T.StringType(), False)]))
