"""Rows to JSON entities and back, for text export and import of whole tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.members import json_members
from vectable.plans.binder import bind
from vectable.plans.schema import PARTITION_COLUMN, CollectionSchema, Field
from vectable.plans.sqltext import quoted_name

ENTITY_COLUMN = "entity"


def _fields(schema: CollectionSchema, auto_ids: bool) -> tuple[Field, ...]:
    return schema.visible_fields if auto_ids else schema.insert_fields


def to_entities(df: DataFrame, schema: CollectionSchema, auto_ids: bool = False) -> DataFrame:
    """One JSON object per row in ``entity``, next to ``__partition``.

    JSON fields are embedded as they are, vectors and arrays are number lists, sparse
    vectors objects in key order, nulls ``null``. Auto ids are left out unless asked
    for. JSON has no NaN or infinity: such a value fails the job.
    """
    fields = _fields(schema, auto_ids)
    bound = bind(df, schema, fields)
    parts: list[Column] = []
    run: list[Field] = []
    # Neighbouring plain fields share one to_json call; a JSON field is spliced between.
    for spec in [*fields, None]:
        if spec is not None and spec.type != "JSON":
            run.append(spec)
            continue
        if run:
            parts.append(_object_members(run))
            run = []
        if spec is not None:
            parts.append(_json_member(spec))
    entity = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return bound.select(entity.alias(ENTITY_COLUMN), PARTITION_COLUMN)


def _object_members(run: list[Field]) -> Column:
    text = F.to_json(F.struct(*[_finite(f).alias(f.name) for f in run]), {"ignoreNullFields": "false"})
    return F.substr(text, F.lit(2), F.length(text) - 2)


def _json_member(spec: Field) -> Column:
    # Line breaks in JSON text are blanks between tokens; an entity stays one line.
    text = F.translate(F.col(quoted_name(spec.name)), "\r\n", "  ")
    return F.concat(F.lit(json.dumps(spec.name, ensure_ascii=False) + ":"), F.coalesce(text, F.lit("null")))


def _finite(spec: Field) -> Column:
    value = F.col(quoted_name(spec.name))

    def endless(x: Column) -> Column:
        return F.isnan(x) | (F.abs(x) == float("inf"))

    def any_endless(values: Column) -> Column:
        # NaN sorts above infinity.
        return (F.array_max(values) >= float("inf")) | (F.array_min(values) == float("-inf"))

    kind = spec.spark_type
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        bad = endless(value)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        bad = any_endless(value)
    elif isinstance(kind, T.MapType):
        bad = any_endless(F.map_values(value))
    else:
        return value
    error = F.raise_error(F.lit(f"NaN or infinity in field {spec.name} has no JSON form")).cast(kind)
    return F.when(bad, error).otherwise(value)


def from_entities(
    df: DataFrame, schema: CollectionSchema, auto_ids: bool = False, entity: str = ENTITY_COLUMN
) -> DataFrame:
    """The rows that entities describe, checked and typed as for an append.

    Numbers are parsed wide and then range-checked, so a value too large for its
    field fails the job instead of turning into null. JSON fields come back byte for
    byte, without blanks around them; JSON ``null`` comes back as a null field. A
    sparse key that isn't a whole number fails the job.
    """
    fields = _fields(schema, auto_ids)
    json_fields = [f.name for f in fields if f.type == "JSON"]
    wide = T.StructType([T.StructField(f.name, _wide(f.spark_type)) for f in fields if f.type != "JSON"])
    columns = [F.from_json(F.col(entity), wide, {"mode": "FAILFAST"}).alias("row")]
    if json_fields:
        columns.append(json_members(F.col(entity), json_fields).alias("written"))
    parsed = df.select(*columns, PARTITION_COLUMN)
    out = []
    for spec in fields:
        if spec.type == "JSON":
            value = F.col("written").getField(f"m{json_fields.index(spec.name)}")
        else:
            value = F.col("row").getField(spec.name)
            if isinstance(spec.spark_type, T.MapType):
                value = _whole_keys(value, spec)
        out.append(value.alias(spec.name))
    return bind(parsed.select(*out, PARTITION_COLUMN), schema, fields)


def _whole_keys(value: Column, spec: Field) -> Column:
    keys = F.map_keys(value)
    odd = F.size(F.filter(keys, lambda k: ~k.rlike("^[0-9]+$"))) > 0
    error = F.raise_error(F.lit(f"a key of sparse vector field {spec.name} isn't a whole number"))
    typed = F.transform_keys(value, lambda k, _: k.cast("bigint"))
    return F.when(odd, error.cast("map<bigint,double>")).otherwise(typed)


def _wide(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_wide(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), T.DoubleType())
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, T.FloatType) else kind
