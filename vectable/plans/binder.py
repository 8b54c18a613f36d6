"""Binds a DataFrame to a collection definition by field name.

Type compatibility is decided while planning. Value checks (nulls, ranges,
lengths, JSON validity) become plain column expressions evaluated in the same
stage as the read, and only where the incoming type leaves room for a bad value.
The expressions are SQL text: one call to the JVM per field keeps binding a wide
collection quick on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vectable.plans.errors import SchemaError, UnsupportedTypeError
from vectable.plans.schema import PARTITION_COLUMN, CollectionSchema, Field
from vectable.plans.sqltext import quoted_name, text_literal

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_BINDABLE = (T.NullType, T.BooleanType, T.StringType, T.ArrayType, T.MapType, *_INTEGERS, *_FLOATS)
# Bounds of the bounded numeric types, and the noun used in range errors.
_INT_BOUNDS = {
    T.ByteType: (-(2**7), 2**7 - 1, "Byte"),
    T.ShortType: (-(2**15), 2**15 - 1, "Short"),
    T.IntegerType: (-(2**31), 2**31 - 1, "Int"),
}
_FLOAT_MAX = "3.4028234663852886E38D"
# Source types each floating type holds exactly.
_EXACT = {
    T.FloatType: (T.ByteType, T.ShortType),
    T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType),
}

# The condition that marks a bad value, and an expression for the message it raises.
Check = tuple[str, str]


def bind(df: DataFrame, schema: CollectionSchema, fields: Iterable[Field] | None = None) -> DataFrame:
    """Project ``df`` onto the insertable fields and ``__partition``, checked and cast.

    Raises ``SchemaError`` for missing or incompatible columns at once; a bad value
    fails the job that evaluates the result.
    """
    fields = tuple(schema.insert_fields if fields is None else fields)
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in [*(f.name for f in fields), PARTITION_COLUMN] if n not in types]
    if missing:
        raise SchemaError(f"the DataFrame lacks the columns {missing}; it has {list(types)}")
    bound = [_bound_field(types[f.name], f) for f in fields]
    return df.selectExpr(*bound, _bound_partition(types[PARTITION_COLUMN]))


def _bound_partition(source: T.DataType) -> str:
    if not isinstance(source, T.StringType):
        raise SchemaError(f"{PARTITION_COLUMN} must be a string, not {source.simpleString()}")
    tag = quoted_name(PARTITION_COLUMN)
    message = text_literal(f"{PARTITION_COLUMN} is null or empty")
    return f"{_checked(tag, [(f'{tag} IS NULL OR {tag} = {text_literal(str())}', message)])} AS {tag}"


def _bound_field(source: T.DataType, spec: Field) -> str:
    value, target = quoted_name(spec.name), spec.spark_type
    checks: list[Check] = []
    if not spec.nullable:
        checks.append((f"{value} IS NULL", text_literal(f"null in the non-nullable field {spec.name}")))
    if not isinstance(source, T.NullType):
        _require_kind(source, target, spec)
        if isinstance(target, T.ArrayType):
            checks += _array_checks(value, source, target, spec)
        elif isinstance(target, T.MapType):
            checks += _sparse_checks(value, source, target, spec)
        else:
            checks += _scalar_checks(value, source, target, spec)
    bound = _checked(f"CAST({value} AS {target.simpleString()})", checks)
    if isinstance(target, T.MapType):
        bound = f"map_from_entries(sort_array(map_entries({bound})))"
    return f"{bound} AS {value}"


def _checked(result: str, checks: list[Check]) -> str:
    """``result``, or the error of the first check that finds the value bad."""
    if not checks:
        return result
    branches = " ".join(f"WHEN {bad} THEN raise_error({message})" for bad, message in checks)
    return f"CASE {branches} ELSE {result} END"


def _require_kind(source: T.DataType, target: T.DataType, spec: Field) -> None:
    """Fail unless ``source`` widens to ``target`` or can be range-checked into it."""
    if not isinstance(source, _BINDABLE):
        raise UnsupportedTypeError(f"Unsupported data type: {source.simpleString()} in field: {spec.name}")
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return _require_kind(source.elementType, target.elementType, spec)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        _require_kind(source.keyType, target.keyType, spec)
        return _require_kind(source.valueType, target.valueType, spec)
    fits = (
        type(source) is type(target)
        or (isinstance(source, _INTEGERS) and isinstance(target, _INTEGERS))
        or (isinstance(source, _FLOATS) and isinstance(target, _FLOATS))
        or isinstance(source, _EXACT.get(type(target), ()))
    )
    if not fits:
        raise SchemaError(
            f"column {spec.name} of type {source.simpleString()} does not fit field type {spec.type}"
            f" ({target.simpleString()})"
        )


def _out_of_range(value: str, source: T.DataType, target: T.DataType) -> tuple[str, str] | None:
    """Condition and noun for values a narrowing cast would change, if there can be any."""
    if isinstance(target, _INTEGERS) and isinstance(source, _INTEGERS):
        if _INTEGERS.index(type(source)) > _INTEGERS.index(type(target)):
            low, high, noun = _INT_BOUNDS[type(target)]
            return f"({value} < {low} OR {value} > {high})", noun
    if isinstance(target, T.FloatType) and isinstance(source, T.DoubleType):
        # Infinity and NaN pass: only finite doubles that would turn infinite are bad.
        return f"(abs({value}) > {_FLOAT_MAX} AND abs({value}) < double('Infinity'))", "Float"
    return None


def _has_null(values: str, element: T.DataType) -> str:
    """Whether an array holds a null, without a lambda, which would be interpreted.

    ``array_contains`` of a value that is not there is null exactly if a null is. Only
    where the value is there does the sorted array, nulls first, have to decide.
    """
    probe = "float('NaN')" if isinstance(element, T.FloatType) else "-128Y"
    first_is_null = f"get(sort_array({values}), 0) IS NULL"
    return f"coalesce(array_contains({values}, {probe}) AND {first_is_null}, {values} IS NOT NULL)"


def _is_json(value: str) -> str:
    """Whether a text is one whole JSON value.

    The parser stops after the first value, so the text is parsed as the first of two array
    elements, the second being a hash of it that nothing in the text can anticipate.
    Objects that repeat a key aren't JSON here.
    """
    parsed = f"""try_parse_json(concat('[', {value}, ',"', sha2({value}, 256), '"]'))"""
    return f"coalesce(try_variant_get({parsed}, '$[1]', 'string') <=> sha2({value}, 256), false)"


def _any_out_of_range(values: str, source: T.DataType, target: T.DataType) -> tuple[str, str] | None:
    """``_out_of_range`` for the elements of an array, by built-ins where they can tell."""
    ranged = _out_of_range("x", source, target)
    if ranged is None:
        return None
    if isinstance(target, _INTEGERS):
        low, high, noun = _INT_BOUNDS[type(target)]
        return f"(array_min({values}) < {low} OR array_max({values}) > {high})", noun
    # Finite elements that turn infinite; an infinite one could hide them from the extremes.
    return f"exists({values}, x -> {ranged[0]})", ranged[1]


def _scalar_checks(value: str, source: T.DataType, target: T.DataType, spec: Field) -> list[Check]:
    checks: list[Check] = []
    ranged = _out_of_range(value, source, target)
    if ranged:
        bad, noun = ranged
        tail = text_literal(f" out of {noun} range in field {spec.name}")
        checks.append((bad, f"concat('Value ', CAST({value} AS STRING), {tail})"))
    if spec.max_length is not None and isinstance(target, T.StringType):
        message = text_literal(f"text longer than {spec.max_length} in field {spec.name}")
        checks.append((f"char_length({value}) > {spec.max_length}", message))
    if spec.type == "JSON":
        message = text_literal(f"invalid JSON in field {spec.name}")
        checks.append((f"{value} IS NOT NULL AND NOT {_is_json(value)}", message))
    return checks


def _array_checks(value: str, source: T.ArrayType, target: T.ArrayType, spec: Field) -> list[Check]:
    checks: list[Check] = []
    length = spec.vector_length
    if length is not None:
        head = text_literal(f"vector field {spec.name} needs {length} stored elements, not ")
        checks.append((f"array_size({value}) <> {length}", f"concat({head}, CAST(array_size({value}) AS STRING))"))
        if source.containsNull:
            checks.append(
                (_has_null(value, target.elementType), text_literal(f"null element in vector field {spec.name}"))
            )
    if spec.max_capacity is not None:
        message = text_literal(f"more than {spec.max_capacity} elements in field {spec.name}")
        checks.append((f"array_size({value}) > {spec.max_capacity}", message))
    ranged = _any_out_of_range(value, source.elementType, target.elementType)
    if ranged:
        bad, noun = ranged
        checks.append((bad, text_literal(f"element out of {noun} range in field {spec.name}")))
    if spec.max_length is not None and isinstance(target.elementType, T.StringType):
        message = text_literal(f"element longer than {spec.max_length} in field {spec.name}")
        checks.append((f"exists({value}, x -> char_length(x) > {spec.max_length})", message))
    return checks


def _sparse_checks(value: str, source: T.MapType, target: T.MapType, spec: Field) -> list[Check]:
    weights = f"map_values({value})"
    checks: list[Check] = []
    if source.valueContainsNull:
        message = text_literal(f"null value in sparse vector field {spec.name}")
        checks.append((_has_null(weights, target.valueType), message))
    ranged = _any_out_of_range(weights, source.valueType, target.valueType)
    if ranged:
        checks.append((ranged[0], text_literal(f"value out of {ranged[1]} range in field {spec.name}")))
    return checks
