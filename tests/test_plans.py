"""Options, definitions and binding: everything decided before or checked while writing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vectable.plans.binder import bind
from vectable.plans.errors import OptionError, SchemaError, UnsupportedTypeError
from vectable.plans.options import CollectionOptions
from vectable.plans.schema import CollectionSchema, Field
from vectable.workload.recipes import HELLO, HELLO_FN

ALL_TYPES = CollectionSchema(
    [
        Field("id", "Int64", primary_key=True),
        Field("small", "Int8", nullable=True),
        Field("medium", "Int16", nullable=True),
        Field("real", "Float", nullable=True),
        Field("text", "VarChar", nullable=True, max_length=3),
        Field("doc", "JSON", nullable=True),
        Field("tags", "Array", element_type="VarChar", nullable=True, max_capacity=2, max_length=3),
        Field("bytes", "Array", element_type="Int8", nullable=True),
        Field("dense", "FloatVector", nullable=True, dim=2),
        Field("packed", "BinaryVector", nullable=True, dim=16),
        Field("half", "Float16Vector", nullable=True, dim=1),
        Field("sparse", "SparseFloatVector", nullable=True),
    ]
)


def good_row(spark, **columns):
    df = spark.range(1).selectExpr(
        "id", "1Y AS small", "1S AS medium", "1F AS real", "'abc' AS text", """'{"a": 1}' AS doc""",
        "array('abc') AS tags", "array(1Y) AS bytes", "array(1F, 2F) AS dense", "array(1Y, -1Y) AS packed",
        "array(0Y, 60Y) AS half", "map(7L, 1F, 2L, 3F) AS sparse", "'p' AS __partition",
    )
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def bound_row(spark, **columns):
    return bind(good_row(spark, **columns), ALL_TYPES).first()


def test_good_row_binds_and_sorts_sparse(spark):
    row = bound_row(spark)
    assert list(row.sparse.items()) == [(2, 3.0), (7, 1.0)]
    assert row.packed == [1, -1]


def test_wide_input_is_narrowed(spark):
    row = bound_row(spark, small="-128", medium="32767L", bytes="array(-128L, 127L)", dense="array(0.5D, 1.5D)")
    assert (row.small, row.medium, row.bytes, row.dense) == (-128, 32767, [-128, 127], [0.5, 1.5])


def test_untyped_null_fits_a_nullable_field(spark):
    assert bound_row(spark, dense="NULL").dense is None


@pytest.mark.parametrize(
    "column, text, message",
    [
        ("small", "300", "Value 300 out of Byte range in field small"),
        ("medium", "40000", "Value 40000 out of Short range in field medium"),
        ("real", "1e300D", "out of Float range in field real"),
        ("text", "'abcd'", "text longer than 3 in field text"),
        ("doc", "'{\"a\"'", "invalid JSON in field doc"),
        ("tags", "array('a', 'b', 'c')", "more than 2 elements in field tags"),
        ("tags", "array('abcd')", "element longer than 3 in field tags"),
        ("bytes", "array(1, 200)", "element out of Byte range in field bytes"),
        ("dense", "array(1F)", "vector field dense needs 2 stored elements, not 1"),
        ("dense", "array(1F, NULL)", "null element in vector field dense"),
        ("dense", "array(1D, 1e39D)", "element out of Float range in field dense"),
        ("packed", "array(1Y)", "vector field packed needs 2 stored elements"),
        ("packed", "array(-128Y, CAST(NULL AS TINYINT))", "null element in vector field packed"),
        ("half", "array(1Y)", "vector field half needs 2 stored elements"),
        ("sparse", "map(1L, CAST(NULL AS FLOAT))", "null value in sparse vector field sparse"),
        ("id", "CAST(NULL AS BIGINT)", "null in the non-nullable field id"),
        ("__partition", "CAST(NULL AS STRING)", "__partition is null or empty"),
        ("__partition", "''", "__partition is null or empty"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_value_fails_the_job(spark, column, text, message, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match=message):
            bound_row(spark, **{column: text})
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(
    "column, text, kind",
    [
        ("small", "1.5BD", "decimal"),
        ("text", "DATE'2024-01-01'", "date"),
        ("text", "TIMESTAMP'2024-01-01 00:00:00'", "timestamp"),
        ("doc", "named_struct('a', 1)", "struct"),
        ("dense", "array(array(1F))", "does not fit"),
        ("sparse", "map('a', 1F)", "does not fit"),
        ("small", "'1'", "does not fit"),
        ("real", "1L", "does not fit"),
    ],
)
def test_unfitting_type_fails_before_any_job(spark, column, text, kind):
    with pytest.raises(SchemaError, match=rf"{kind}.*") as error:
        bind(good_row(spark, **{column: text}), ALL_TYPES)
    assert column in str(error.value)


def test_missing_columns_are_named(spark):
    with pytest.raises(SchemaError, match="small.*__partition"):
        bind(good_row(spark).drop("small", "__partition"), ALL_TYPES)


@pytest.mark.parametrize("kind", ["Decimal", "Date", "Timestamp", "Struct", "Map"])
def test_unsupported_field_type(kind):
    with pytest.raises(UnsupportedTypeError, match=f"Unsupported data type: {kind} in field: x"):
        Field("x", kind)


@pytest.mark.parametrize("element", [None, "JSON", "Array", "FloatVector"])
def test_unsupported_element_type(element):
    with pytest.raises(UnsupportedTypeError, match="Unsupported array element data type: .* in field: x"):
        Field("x", "Array", element_type=element)


@pytest.mark.parametrize(
    "bad",
    [
        dict(name="__partition", type="VarChar"),
        dict(name="", type="Int64"),
        dict(name="x", type="FloatVector"),
        dict(name="x", type="BinaryVector", dim=12),
        dict(name="x", type="Double", primary_key=True),
        dict(name="x", type="VarChar", primary_key=True, auto_id=True),
        dict(name="x", type="Int64", primary_key=True, nullable=True),
        dict(name="x", type="Int64", metric="COSINE"),
        dict(name="x", type="FloatVector", dim=2, metric="L7"),
    ],
)
def test_bad_definitions(bad):
    with pytest.raises(SchemaError):
        Field(**bad)


def test_repeated_names_and_keys():
    with pytest.raises(SchemaError, match="repeat"):
        CollectionSchema([Field("a", "Int64"), Field("A", "Bool")])
    with pytest.raises(SchemaError, match="primary key"):
        CollectionSchema([Field(n, "Int64", primary_key=True) for n in "ab"])
    with pytest.raises(SchemaError, match="readable"):
        CollectionSchema([Field("a", "Int64", function_output=True)])


def test_definition_survives_json():
    for schema in (HELLO, HELLO_FN, ALL_TYPES):
        assert CollectionSchema.from_json(schema.to_json()) == schema


def test_option_defaults_and_checks():
    opts = CollectionOptions.of({"URI": "/data", "collection": "c", "token": "t"})
    assert (opts.database, opts.batchsize, opts.batchsize_given) == ("default", 1000, False)
    assert opts.data_path == "/data/default/c/data"
    for given, key in [
        ({"collection": "c"}, "uri"),
        ({"uri": "/d"}, "collection"),
        ({"uri": "/d", "collection": "a/b"}, "collection"),
        ({"uri": "/d", "collection": ".."}, "collection"),
        *[({"uri": "/d", "collection": "c", "batchsize": b}, "batchsize") for b in ("0", "abc", "-1", "1.5", "")],
    ]:
        with pytest.raises(OptionError, match=key):
            CollectionOptions.of(given)
