"""Codecs against numpy, generators, bit strings."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions import generators
from vectable.functions.half import (
    binary_bits,
    decode_bf16,
    decode_fp16,
    encode_bf16,
    encode_fp16,
    from_bf16_bits,
    to_bf16_bits,
)

FLOATS = T.StructType([T.StructField("v", T.ArrayType(T.FloatType()))])
BYTES = T.StructType([T.StructField("b", T.ArrayType(T.ByteType()))])


def as_bytes(patterns: np.ndarray) -> list[int]:
    return patterns.astype("<u2").view(np.int8).tolist()


def nearest_bf16(value: float) -> int:
    """Bit pattern by search: the nearest of the two neighbours, the even one on a tie."""
    low = int(np.float32(value).view(np.uint32) >> 16)
    options = [low, low + 1]
    as_floats = [float(from_bf16_bits(np.array([o], np.uint16))[0]) for o in options]
    # The neighbour beyond the largest finite value counts as the next power of two.
    as_floats = [np.copysign(2.0**128, value) if np.isinf(f) else f for f in as_floats]
    gaps = [abs(f - float(np.float32(value))) for f in as_floats]
    if gaps[0] == gaps[1]:
        return options[0] if options[0] % 2 == 0 else options[1]
    return options[int(np.argmin(gaps))]


def test_every_fp16_pattern_decodes_and_returns(spark):
    patterns = np.arange(65536, dtype=np.uint16)
    df = spark.createDataFrame([(as_bytes(patterns),)], BYTES)
    row = df.select(decode_fp16("b").alias("v")).select("v", encode_fp16("v").alias("back")).first()
    expected = patterns.view(np.float16).astype(np.float32)
    assert np.array_equal(np.array(row.v, np.float32), expected, equal_nan=True)
    back = np.array(row.back, np.int8).view("<u2")
    finite = ~np.isnan(expected)
    assert np.array_equal(back[finite], patterns[finite])


def test_every_bf16_pattern_decodes_and_returns(spark):
    patterns = np.arange(65536, dtype=np.uint16)
    df = spark.createDataFrame([(as_bytes(patterns),)], BYTES)
    row = df.select(decode_bf16("b").alias("v")).select("v", encode_bf16("v").alias("back")).first()
    expected = (patterns.astype(np.uint32) << 16).view(np.float32)
    assert np.array_equal(np.array(row.v, np.float32), expected, equal_nan=True)
    back = np.array(row.back, np.int8).view("<u2")
    finite = ~np.isnan(expected)
    assert np.array_equal(back[finite], patterns[finite])


def test_special_values(spark):
    values = [0.0, -0.0, float("inf"), float("-inf"), 65519.0, 65520.0, -1e30, 6e-8, 2e-8, 1.0009766, 1e-45]
    row = (
        spark.createDataFrame([(values,)], FLOATS).select(encode_fp16("v").alias("h"), encode_bf16("v").alias("b")).first()
    )
    with np.errstate(over="ignore"):
        assert row.h == np.array(values, np.float32).astype("<f2").view(np.int8).tolist()
    patterns = np.array(row.b, np.int8).view("<u2")
    finite = [i for i, v in enumerate(values) if np.isfinite(v)]
    assert [int(patterns[i]) for i in finite] == [nearest_bf16(values[i]) for i in finite]
    assert list(patterns[2:4]) == [0x7F80, 0xFF80]


def test_nan_stays_nan(spark):
    both = spark.createDataFrame([([float("nan")],)], FLOATS).select(
        decode_fp16(encode_fp16("v")).alias("h"), decode_bf16(encode_bf16("v")).alias("b")
    )
    row = both.first()
    assert np.isnan(row.h[0]) and np.isnan(row.b[0])


@given(st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False), min_size=1, max_size=50))
def test_bf16_rounds_to_the_nearest_even(values):
    found = to_bf16_bits(np.array(values, np.float32))
    assert [int(f) for f in found] == [nearest_bf16(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(st.floats(width=32, allow_nan=False), max_size=6)), min_size=1, max_size=8))
def test_fp16_columns_match_numpy(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>").coalesce(1)
    found = [r.h for r in df.select("i", encode_fp16("v").alias("h")).orderBy("i").collect()]
    with np.errstate(over="ignore"):
        expected = [None if v is None else np.array(v, np.float32).astype("<f2").view(np.int8).tolist() for v in vectors]
    assert found == expected


def test_null_rows_and_negative_bytes_in_bit_strings(spark):
    df = spark.createDataFrame([([-1, 0, 5, -128],), (None,), ([],)], BYTES).coalesce(1)
    found = [r[0] for r in df.select(binary_bits("b")).collect()]
    assert found == ["11111111000000000000010110000000", None, ""]


def test_filtered_batches_keep_their_rows(spark):
    """Sliced Arrow columns must not shift values."""
    df = spark.range(1000).selectExpr("id", "array(FLOAT(id), FLOAT(-id)) AS v").where("id % 3 = 1")
    wrong = df.withColumn("back", decode_fp16(encode_fp16("v"))).where("back[0] <> id OR back[1] <> -id")
    assert wrong.count() == 0


@pytest.mark.parametrize("encode", [encode_fp16, encode_bf16])
def test_null_element_is_an_error(spark, encode):
    with pytest.raises(Exception, match="null element in a vector"):
        spark.createDataFrame([([1.0, None],)], FLOATS).select(encode("v")).collect()


def test_odd_byte_count_is_an_error(spark):
    with pytest.raises(Exception, match="even number of bytes"):
        spark.createDataFrame([([1, 2, 3],)], BYTES).select(decode_fp16("b")).collect()


def all_kinds(df, seed):
    key = F.col("id")
    return df.select(
        "id",
        generators.random_float_vector(key, 8, seed).alias("dense"),
        generators.random_binary_vector(key, 16, seed).alias("packed"),
        generators.random_half_vector(key, 8, False, seed).alias("fp16"),
        generators.random_half_vector(key, 8, True, seed).alias("bf16"),
        F.map_entries(generators.random_sparse_vector(key, seed)).alias("sparse"),
    )


def test_generators_repeat_whatever_the_split(spark):
    one = all_kinds(spark.range(0, 500, 1, 1), 3)
    many = all_kinds(spark.range(0, 500, 1, 7), 3)
    assert one.exceptAll(many).count() == 0
    assert one.exceptAll(all_kinds(spark.range(500), 4)).count() == 500


def test_generated_halves_are_the_floats(spark):
    df = all_kinds(spark.range(200), 1)
    wrong = df.where(F.col("fp16") != encode_fp16("dense")).count() + df.where(F.col("bf16") != encode_bf16("dense")).count()
    assert wrong == 0


def test_generated_sparse_vectors(spark):
    df = all_kinds(spark.range(5000), 2).select("id", F.explode("sparse").alias("e")).select("id", "e.*")
    sizes = df.groupBy("id").count().agg(F.min("count"), F.max("count"), F.count_distinct("count")).first()
    assert sizes[0] >= 8 and sizes[1] == 19 and sizes[2] >= 10
    assert df.where("key < 0 OR key >= 1000000 OR value < 0 OR value >= 1").count() == 0
    assert df.groupBy("id", "key").count().where("count > 1").count() == 0


@pytest.mark.parametrize("dim", [0, -8, 12])
def test_generator_dims_are_checked(spark, dim):
    with pytest.raises(ValueError, match="dim"):
        generators.random_binary_vector(F.lit(1), dim)
