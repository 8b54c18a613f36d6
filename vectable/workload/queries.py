"""The registered queries: every operator over whole tables, by name.

Each takes the session and the folder of the source tables and returns a DataFrame
of scalar columns.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions import generators, half
from vectable.operators import batches, entities
from vectable.operators.topk import top_k
from vectable.plans.schema import DEFAULT_PARTITION, PARTITION_COLUMN, CollectionSchema, Field
from vectable.sources import catalog, collection
from vectable.sources.collection import append_collection, count_rows, read_collection
from vectable.sources.facade import reader, writer
from vectable.workload import recipes
from vectable.workload.recipes import HELLO, HELLO_FN, empty_collection, kept_collection, new_collection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCHSIZE = 100


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- shared pieces ---------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_collection(spark, kept_collection(spark, sf_dir, name))


def _total(values: Column) -> Column:
    return F.round(F.aggregate(values, F.lit(0.0), lambda total, x: total + x), 6)


def _scalars(df: DataFrame) -> list[Column]:
    return [
        F.col("id"), F.col("f2"), F.col("f3"), F.col("f4"), F.col("f5"), F.col("f6"),
        F.round(F.col("f7").cast("double"), 6).alias("f7"), F.round("f8", 6).alias("f8"), F.col("f9"),
    ]


def _arrays() -> list[Column]:
    return [F.array_join("f10", "|").alias("f10"), F.array_join("f10_2", "|").alias("f10_2")]


def _vectors() -> list[Column]:
    return [
        _total(F.col("vec_dense")).alias("dense_sum"),
        half.binary_bits("vec_binary").alias("bits"),
        F.array_join(F.map_keys("vec_sparse"), "|").alias("sparse_keys"),
        _total(F.map_values("vec_sparse")).alias("sparse_sum"),
        _total(half.decode_fp16("vec_fp16")).alias("fp16_sum"),
        _total(half.decode_bf16("vec_bf16")).alias("bf16_sum"),
    ]


def _flat(df: DataFrame) -> DataFrame:
    """Every field of a HELLO row as scalar columns."""
    return df.select(*_scalars(df), *_arrays(), "f11", *_vectors(), PARTITION_COLUMN)


def _per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("row_count"), F.countDistinct("id").alias("ids"), F.sum("f6").alias("f6_sum")
    )


# --- sources and catalog ---------------------------------------------------------


@registered
def scan_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_read(spark, sf_dir, "hello"))


@registered
def scan_partition_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "hello").select("id", PARTITION_COLUMN)


@registered
def scan_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = kept_collection(spark, sf_dir, "hello")
    return read_collection(spark, options, partition="p7").select("id", "f9", PARTITION_COLUMN)


@registered
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_plan(_read(spark, sf_dir, "hello"), BATCHSIZE)


@registered
def batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads the collection in bounded batches and adds up what each held."""

    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"batch_rows": pa.array([batch.num_rows], pa.int64())})

    held = batches.map_batches(_read(spark, sf_dir, "hello").select("id", PARTITION_COLUMN), sizes, "batch_rows bigint", BATCHSIZE)
    return held.agg(
        F.sum("batch_rows").alias("row_count"),
        F.count("*").alias("batches"),
        (F.max("batch_rows") <= BATCHSIZE).alias("bounded"),
    )


@registered
def batch_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row lies in the batch that an address names; addresses add up to the collection."""
    df, at = _read(spark, sf_dir, "hello"), [PARTITION_COLUMN, "file", "start"]
    held = batches.with_address(df, BATCHSIZE).groupBy(*at).agg(F.count("*").alias("held"))
    both = batches.batch_addresses(df, BATCHSIZE).join(held, at, "full")
    return both.groupBy(PARTITION_COLUMN).agg(
        F.sum("rows").alias("row_count"),
        F.bool_and(F.col("rows").eqNullSafe(F.col("held"))).alias("found"),
        (F.max("held") <= BATCHSIZE).alias("bounded"),
    )


@registered
def scan_hides_function_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "hello_fn")
    return df.select(
        "id", *_arrays(), *_vectors(),
        F.lit(len(df.columns)).alias("column_count"), F.lit("sparse_out" in df.columns).alias("shown"),
    )


@registered
def scan_field_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "hello_shuffled")
    return _flat(df).withColumn("column_names", F.lit(",".join(df.columns)))


@registered
def has_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = kept_collection(spark, sf_dir, "hello")
    missing = {"uri": options.uri, "collection": "absent"}
    return _read(spark, sf_dir, "hello").agg(
        F.count("*").alias("row_count"),
        F.lit(catalog.has_collection(spark, options)).alias("present"),
        F.lit(catalog.has_collection(spark, missing)).alias("absent_present"),
    )


@registered
def describe_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The definition, next to how many values each column holds."""
    options = kept_collection(spark, sf_dir, "hello")
    df = read_collection(spark, options)
    held = df.agg(*[F.count(c).alias(c) for c in df.columns])
    counts = held.unpivot([], list(df.columns), "name", "value_count")
    return catalog.describe_collection(spark, options).join(counts, "name")


@registered
def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.list_partitions(spark, kept_collection(spark, sf_dir, "hello"))


@registered
def list_function_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = kept_collection(spark, sf_dir, "hello_fn")
    names = [r.name for r in catalog.list_function_outputs(spark, options).collect()]
    hidden = F.lit(",".join(names)).alias("function_outputs")
    return read_collection(spark, options).agg(hidden, F.count("*").alias("row_count"))


def _over_table(spark: SparkSession, sf_dir: str, name: str, query: str) -> DataFrame:
    """The query over the SQL table of the kept collection."""
    return spark.sql(query.format(table=recipes.kept_table(spark, sf_dir, name)))


@registered
def sql_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_table(
        spark,
        sf_dir,
        "hello",
        "SELECT __partition, count(*) AS row_count, count(DISTINCT id) AS ids, sum(f6) AS f6_sum"
        " FROM {table} GROUP BY __partition",
    )


@registered
def sql_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = "SELECT id, f2, f5, f9, f11, __partition FROM {table} ORDER BY id LIMIT 10"
    return _over_table(spark, sf_dir, "hello", query)


@registered
def option_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read by option calls, of one partition and two columns."""
    held = kept_collection(spark, sf_dir, "hello")
    found = reader(spark).option("uri", held.uri).option("collection", held.collection).option("partition", "p7")
    return found.load().select("id", "f9", PARTITION_COLUMN)


@registered
def option_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by option calls, with drawn ids and a batch size."""
    held = empty_collection(spark, "hello_auto", recipes.HELLO_AUTO)
    for _ in range(2):
        call = writer(recipes.hello_rows(spark, sf_dir)).options(uri=held.uri, collection=held.collection)
        call.option("batchsize", BATCHSIZE).mode("append").save()
    per_file = (
        read_collection(spark, held)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("file_rows"), F.countDistinct("id").alias("ids"))
    )
    return per_file.agg(
        F.sum("file_rows").alias("row_count"),
        F.sum("ids").alias("ids"),
        (F.max("file_rows") <= BATCHSIZE).alias("bounded"),
    )


@registered
def create_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating again with replace empties the collection; a second fill stands alone."""
    options = new_collection(spark, sf_dir, "hello")
    catalog.create_collection(spark, options, HELLO, replace=True)
    append_collection(recipes.hello_rows(spark, sf_dir), options)
    return _per_partition(read_collection(spark, options))


# --- sinks -----------------------------------------------------------------------


@registered
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends add up."""
    options = new_collection(spark, sf_dir, "hello")
    append_collection(recipes.hello_rows(spark, sf_dir), options)
    return _per_partition(read_collection(spark, options))


@registered
def append_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row lies in the directory its tag names."""
    df = read_collection(spark, new_collection(spark, sf_dir, "hello"))
    inside = F.col("_metadata.file_path").contains(F.concat(F.lit("/__partition="), PARTITION_COLUMN, F.lit("/")))
    return df.groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("row_count"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.bool_and(inside).alias("in_its_directory"),
    )


@registered
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a batch size given, no written file holds more rows."""
    options = new_collection(spark, sf_dir, "hello", batchsize=BATCHSIZE)
    per_file = (
        read_collection(spark, options)
        .groupBy(PARTITION_COLUMN, F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("file_rows"))
    )
    return per_file.groupBy(PARTITION_COLUMN).agg(
        F.sum("file_rows").alias("row_count"), (F.max("file_rows") <= BATCHSIZE).alias("bounded")
    )


@registered
def append_auto_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are drawn, not taken from the input, and two appends never share one."""
    options = new_collection(spark, sf_dir, "hello_auto")
    append_collection(recipes.hello_rows(spark, sf_dir), options)
    return read_collection(spark, options).agg(
        F.count("*").alias("row_count"), F.countDistinct("id").alias("ids"), F.countDistinct("f9").alias("inputs")
    )


@registered
def append_skips_function_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column offered for a hidden field is not stored."""
    options = empty_collection(spark, "hello_fn", HELLO_FN)
    offered = recipes.hello_rows(spark, sf_dir).withColumn("sparse_out", F.col("vec_sparse"))
    append_collection(offered, options)
    stored = spark.read.parquet(options.data_path).columns
    return _per_partition(read_collection(spark, options)).withColumn("stored", F.lit("sparse_out" in stored))


@registered
def to_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = entities.to_entities(_read(spark, sf_dir, "hello"), HELLO)

    def part(path: str) -> Column:
        return F.get_json_object("entity", path)

    return exported.select(
        part("$.id").cast("bigint").alias("id"),
        F.array_join(F.json_object_keys("entity"), ",").alias("names"),
        part("$.f2").alias("f2"),
        part("$.f9").alias("f9"),
        part("$.f10[1]").alias("second_text"),
        part("$.f10_2[3]").cast("int").alias("fourth_number"),
        part("$.f11").alias("f11"),
        F.round(part("$.vec_dense[63]").cast("float").cast("double"), 6).alias("last_dense"),
        part("$.vec_binary[0]").cast("int").alias("first_byte"),
        F.json_array_length(part("$.vec_fp16")).alias("fp16_bytes"),
        F.array_join(F.json_object_keys(part("$.vec_sparse")), "|").alias("sparse_keys"),
        PARTITION_COLUMN,
    )


@registered
def from_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = entities.to_entities(_read(spark, sf_dir, "hello"), HELLO)
    return _flat(entities.from_entities(exported, HELLO))


@registered
def copy_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = empty_collection(spark, "hello2", HELLO)
    collection.copy_collection(spark, kept_collection(spark, sf_dir, "hello"), target)
    return _flat(read_collection(spark, target))


GENERATED = CollectionSchema(
    [
        Field("id", "Int64", primary_key=True),
        Field("vec_dense", "FloatVector", dim=8, metric="COSINE"),
        Field("vec_binary", "BinaryVector", dim=16, metric="HAMMING"),
        Field("vec_sparse", "SparseFloatVector", metric="IP"),
        Field("vec_fp16", "Float16Vector", dim=16, metric="COSINE"),
    ],
    "synthetic vectors",
)


@registered
def insert_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic row per order, all in the default partition, which many tasks write."""
    options = empty_collection(spark, "generated", GENERATED)
    key = F.col("id")
    generated = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id")).select(
        "id",
        generators.random_float_vector(key, 8, seed=1).alias("vec_dense"),
        generators.random_binary_vector(key, 16, seed=2).alias("vec_binary"),
        generators.random_sparse_vector(key, seed=3).alias("vec_sparse"),
        generators.random_half_vector(key, 16, bf16=False, seed=4).alias("vec_fp16"),
        F.lit(DEFAULT_PARTITION).alias(PARTITION_COLUMN),
    )
    append_collection(generated, options)
    return read_collection(spark, options).groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("row_count"),
        F.countDistinct("id").alias("ids"),
        F.min(F.size("vec_dense")).alias("dense_size"),
        F.min(F.size("vec_binary")).alias("binary_size"),
        F.min(F.size("vec_fp16")).alias("fp16_size"),
    )


# --- types -----------------------------------------------------------------------


@registered
def types_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "hello")
    return df.select(*_scalars(df))


@registered
def types_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls of every type come back as nulls."""
    df = _read(spark, sf_dir, "hello_nulls")
    return df.select("id", *[F.col(f.name).isNull().alias(f.name) for f in HELLO.fields[1:]])


@registered
def types_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(path: str) -> Column:
        return F.get_json_object("f11", path)

    return _read(spark, sf_dir, "hello").select(
        "id",
        part("$.path").alias("path"),
        part("$.size").cast("bigint").alias("size"),
        part("$.special").alias("special"),
        part("$.flags[2]").cast("bigint").alias("last_flag"),
    )


@registered
def types_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pair(name: str) -> Column:
        return F.array_join(F.col(name).cast("array<string>"), "|").alias(name)

    def rounded(name: str, i: int) -> Column:
        return F.round(F.col(name)[i].cast("double"), 6).alias(f"{name}_{i}")

    whole = ("a_bool", "a_int8", "a_int16", "a_int32", "a_int64", "a_string", "a_varchar")
    return _read(spark, sf_dir, "hello_arrays").select(
        "id", *map(pair, whole), *[rounded(n, i) for n in ("a_float", "a_double") for i in (0, 1)]
    )


def _elements(df: DataFrame, values: Column) -> DataFrame:
    return df.select("id", F.posexplode(values).alias("pos", "value")).select(
        "id", "pos", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@registered
def types_float_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _elements(_read(spark, sf_dir, "hello"), F.col("vec_dense"))


@registered
def types_binary_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _elements(_read(spark, sf_dir, "hello"), F.col("vec_binary"))


@registered
def types_fp16_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _elements(_read(spark, sf_dir, "hello"), half.decode_fp16("vec_fp16"))


@registered
def types_bf16_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _elements(_read(spark, sf_dir, "hello"), half.decode_bf16("vec_bf16"))


@registered
def types_sparse_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.posexplode(F.map_entries("vec_sparse")).alias("pos", "entry")
    return _read(spark, sf_dir, "hello").select("id", entries).select(
        "id", "pos", F.col("entry.key").alias("key"),
        F.round(F.col("entry.value").cast("double"), 6).alias("value"),
    )


# --- codecs and generators -------------------------------------------------------


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")


def _encoded(spark: SparkSession, sf_dir: str, encode: Callable[..., Column]) -> DataFrame:
    """Element count and a position-weighted sum of the unsigned bytes."""
    weighted = F.transform("bytes", lambda b, i: b.cast("bigint").bitwiseAND(255) * (i + 1))
    return _embeddings(spark, sf_dir).select("id", encode("embedding").alias("bytes")).select(
        "id", F.size("bytes").alias("byte_count"),
        F.aggregate(weighted, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("checksum"),
    )


def _decoded(df: DataFrame, values: Column) -> DataFrame:
    return df.select("id", values.alias("values")).select(
        "id", F.size("values").alias("dim"), _total(F.col("values")).alias("total"),
        F.round(F.array_min("values").cast("double"), 6).alias("low"),
        F.round(F.array_max("values").cast("double"), 6).alias("high"),
    )


@registered
def encode_fp16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, half.encode_fp16)


@registered
def encode_bf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, half.encode_bf16)


@registered
def decode_fp16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(_embeddings(spark, sf_dir), half.decode_fp16(half.encode_fp16("embedding")))


@registered
def decode_bf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(_embeddings(spark, sf_dir), half.decode_bf16(half.encode_bf16("embedding")))


@registered
def binary_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = half.binary_bits("vec_binary")
    return _read(spark, sf_dir, "hello").select("id", bits.alias("bits")).withColumn(
        "ones", F.length(F.replace("bits", F.lit("0"), F.lit("")))
    )


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generator key per order line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("key"))


def _drawn(df: DataFrame, vector: Column, size: Column, fits: Column, *more: Column) -> DataFrame:
    return df.select(vector.alias("vector")).agg(
        F.count("vector").alias("vectors"), F.min(size).alias("min_size"), F.max(size).alias("max_size"),
        F.bool_and(fits).alias("in_range"), *more,
    )


def _unit(values: Column) -> Column:
    return (F.array_min(values) >= 0) & (F.array_max(values) < 1)


@registered
def gen_float_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.avg(_total(F.col("vector")) / 8)
    return _drawn(
        _keys(spark, sf_dir), generators.random_float_vector(F.col("key"), 8), F.size("vector"), _unit(F.col("vector")),
        mean.between(0.48, 0.52).alias("centred"),
    )


@registered
def gen_constant_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = (F.array_min("vector") == 0.5) & (F.array_max("vector") == 0.5)
    return _drawn(_keys(spark, sf_dir), generators.constant_float_vector(0.5, 8), F.size("vector"), fits)


@registered
def gen_binary_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of both signs occur."""
    low, high = F.array_min("vector"), F.array_max("vector")
    signs = (F.min(low) < -120) & (F.max(high) > 120)
    return _drawn(
        _keys(spark, sf_dir), generators.random_binary_vector(F.col("key"), 16), F.size("vector"), low <= high, signs.alias("both_signs")
    )


@registered
def gen_sparse_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes vary with colliding keys, so they are reported as lying within bounds."""
    keys = F.map_keys("vector")
    key_fits = (F.array_min(keys) >= 0) & (F.array_max(keys) < 1_000_000)
    drawn = _drawn(
        _keys(spark, sf_dir), generators.random_sparse_vector(F.col("key")), F.size("vector"),
        key_fits & _unit(F.map_values("vector")),
    )
    return drawn.select(
        "vectors", "in_range", F.col("min_size").between(1, 10).alias("min_fits"),
        F.col("max_size").between(11, 19).alias("max_fits"),
    )


@registered
def gen_half_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A float just below one may round up to one in half precision."""
    df, key = _keys(spark, sf_dir), F.col("key")
    halves = df.select(
        generators.random_half_vector(key, 16, bf16=False).alias("fp16"), generators.random_half_vector(key, 16, bf16=True).alias("bf16")
    )

    def unit(values: Column) -> Column:
        return (F.array_min(values) >= 0) & (F.array_max(values) <= 1)

    return halves.agg(
        F.count("*").alias("vectors"),
        F.min(F.size("fp16")).alias("fp16_size"),
        F.min(F.size("bf16")).alias("bf16_size"),
        F.bool_and(unit(half.decode_fp16("fp16")) & unit(half.decode_bf16("bf16"))).alias("in_range"),
    )


# --- queries over a collection ---------------------------------------------------


@registered
def count_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_rows(spark, kept_collection(spark, sf_dir, "hello"))
    return spark.createDataFrame([(counted,)], "row_count long")


@registered
def project_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_read(spark, sf_dir, "hello").orderBy("id").limit(5)).drop(PARTITION_COLUMN, "bf16_sum")


@registered
def project_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = _read(spark, sf_dir, "hello").select("id", "vec_dense", "vec_binary", "vec_fp16").orderBy("id").limit(5)
    return few.select(
        "id", _total(F.col("vec_dense")).alias("dense_sum"), half.binary_bits("vec_binary").alias("bits"),
        _total(half.decode_fp16("vec_fp16")).alias("fp16_sum"),
    )


def _nearest(spark: SparkSession, sf_dir: str, vector: str, **bounds: int) -> DataFrame:
    """The five rows nearest to the first row of each partition, in the whole collection."""
    df = _read(spark, sf_dir, "hello")
    first = df.groupBy(F.col(PARTITION_COLUMN).alias("query_id")).agg(F.min_by(vector, "id").alias("query_vector"))
    found = top_k(df, HELLO, vector, first, k=5, **bounds)
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@registered
def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "vec_dense")


@registered
def topk_cosine_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search with queries cut into blocks of two vectors or so."""
    return _nearest(spark, sf_dir, "vec_dense", block_bytes=1024)


@registered
def topk_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "vec_binary")


@registered
def topk_sparse_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "vec_sparse")


@registered
def topk_cosine_fp16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "vec_fp16")


@registered
def topk_cosine_bf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "vec_bf16")


@registered
def host_surface_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, join and group over a collection like over any DataFrame."""
    labels = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "label")
    df = _read(spark, sf_dir, "hello").where(F.col("f8") > 0)
    return df.join(labels, "id").groupBy(PARTITION_COLUMN, "label").agg(
        F.count("*").alias("row_count"), F.round(F.sum("f8"), 6).alias("f8_sum")
    )


# --- larger tables ---------------------------------------------------------------


def _line_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(PARTITION_COLUMN, "l_linestatus").agg(
        F.count("*").alias("row_count"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.min("l_shipdate").alias("first_shipped"),
        F.max("l_shipdate").alias("last_shipped"),
    )


@registered
def scan_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_totals(_read(spark, sf_dir, "lineitem_coll"))


@registered
def append_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_totals(read_collection(spark, new_collection(spark, sf_dir, "lineitem_coll")))


@registered
def copy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = empty_collection(spark, "lineitem_copy", recipes.LINEITEM)
    collection.copy_collection(spark, kept_collection(spark, sf_dir, "lineitem_coll"), target)
    return _line_totals(read_collection(spark, target))


@registered
def scan_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events_coll").groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("row_count"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"),
        F.round(F.sum("value"), 2).alias("value_sum"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@registered
def entities_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export and re-import a whole table of JSON rows."""
    exported = entities.to_entities(_read(spark, sf_dir, "events_coll"), recipes.EVENTS)
    return entities.from_entities(exported, recipes.EVENTS).groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("row_count"),
        F.sum("event_id").alias("event_ids"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"),
        F.round(F.sum("value"), 2).alias("value_sum"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
