"""Entities, batches and top-k."""

import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vectable.functions import generators
from vectable.functions.members import members
from vectable.operators import topk
from vectable.operators.batches import batch_addresses, batch_plan, map_batches, read_batch, with_address
from vectable.operators.entities import from_entities, to_entities
from vectable.plans.errors import SchemaError
from vectable.plans.schema import CollectionSchema, Field
from vectable.sources.collection import read_collection
from vectable.workload.recipes import EVENTS, HELLO, HELLO_AUTO, HELLO_NULLS, kept_collection


def comparable(df):
    return df.withColumn("vec_sparse", F.map_entries("vec_sparse")) if "vec_sparse" in df.columns else df


@pytest.mark.parametrize("name, schema", [("hello", HELLO), ("hello_nulls", HELLO_NULLS)])
def test_entities_return_the_rows(spark, name, schema):
    df = read_collection(spark, kept_collection(spark, SF_DIR, name))
    back = comparable(from_entities(to_entities(df, schema), schema))
    assert back.columns == df.columns and back.schema["f3"].dataType == df.schema["f3"].dataType
    assert back.exceptAll(comparable(df)).count() == 0 and back.count() == df.count()


def test_entity_text(spark):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello")).where("id = 14")
    entity = json.loads(to_entities(df, HELLO).first().entity)
    assert list(entity) == [f.name for f in HELLO.fields]
    assert entity["f11"] == {"path": "root/abc/path14", "size": 14, "special": True, "flags": [14, 15, 16]}
    assert entity["f10"] == [f"string-14-{k}" for k in range(9)] and len(entity["vec_fp16"]) == 128
    assert list(entity["vec_sparse"]) == [str(i * 15013) for i in range(64)]


def test_auto_ids_are_left_out_unless_asked_for(spark):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello_auto"))
    assert "id" not in json.loads(to_entities(df, HELLO_AUTO).first().entity)
    full = to_entities(df, HELLO_AUTO, auto_ids=True)
    assert from_entities(full, HELLO_AUTO, auto_ids=True).select("id").exceptAll(df.select("id")).count() == 0


def test_json_of_every_kind_survives(spark):
    texts = ['{"b": 1, "a": [true, null, "x"]}', "[1, 2]", '"text"', '"{}"', '"7"', "7", "true", '{\n"a":\r\n1}', None]
    rows = [(i, 1, "t", "e", 1.0, t, "p") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double, props string, __partition string")
    entities = to_entities(df, EVENTS)
    assert entities.where(F.col("entity").rlike("[\r\n]")).count() == 0
    found = {r.event_id: r.props for r in from_entities(entities, EVENTS).collect()}
    assert [found[i] for i in range(len(texts))] == [t and t.replace("\n", " ").replace("\r", " ") for t in texts]


def test_members_are_found_as_they_are_written():
    objects = {
        '{"a":1,"b":"x"}': ("1", '"x"'),
        ' { "b" : [ 1 , {"a":2} ] , "a" : {"a":{"b":3}} } ': ('{"a":{"b":3}}', '[ 1 , {"a":2} ]'),
        '{"a":"q\\"},{:\\\\","b":"\\\\"}': ('"q\\"},{:\\\\"', '"\\\\"'),
        '{"c":[[["a"]]],"b":null,"a":"null"}': ('"null"', None),
        '{"\\u0061":1,"\\"b":2}': ("1", None),
        '{"a":1,"a":2.50}': ("2.50", None),
        '{"a":"日本:,","b":-0.0e+10}': ('"日本:,"', "-0.0e+10"),
        '{"a":1} {"b":2}': ("1", None),
        "{}": (None, None),
        "": (None, None),
        "[]": (None, None),
    }
    texts = [*objects, None]
    for given in (texts, texts[::-1], texts * 3):
        found = members(pa.array(given, pa.string()), ["a", "b"])
        pairs = list(zip(*(f.to_pylist() for f in found), strict=True))
        assert pairs == [objects.get(t, (None, None)) for t in given]
    assert [len(f) for f in members(pa.array([], pa.string()), ["a"])] == [0]


@given(
    st.lists(
        st.dictionaries(
            st.text(max_size=3),
            st.recursive(
                st.none() | st.booleans() | st.floats(allow_nan=False, allow_infinity=False) | st.text('"\\{}[]:, \n日', max_size=5),
                lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=2), inner, max_size=3),
                max_leaves=6,
            ),
            max_size=4,
        ),
        max_size=5,
    ),
    st.sampled_from([None, 1]),
    st.booleans(),
)
@settings(max_examples=150, deadline=None)
def test_members_of_any_object(objects, indent, plain):
    names = sorted({name for o in objects for name in o}) or ["a"]
    texts = [json.dumps(o, indent=indent, ensure_ascii=plain) for o in objects]
    found = members(pa.array(texts, pa.string()), names)
    for column, name in zip(found, names, strict=True):
        for text, o in zip(column.to_pylist(), objects, strict=True):
            assert (text is None) == (o.get(name) is None)
            if text is not None:
                assert json.loads(text) == o[name] and text == text.strip()


def test_malformed_objects_do_not_break_the_scan():
    for text in ('{"a":"', '{"a', ":::", '":{"', "\\\\", "}}}{:", '{:1}', '{"a":1', ',"a":'):
        for name in members(pa.array([text, '{"a":1}', text], pa.string()), ["a"]):
            assert name[1].as_py() == "1"


@pytest.mark.parametrize("bad", ["NaN", "Infinity", "-Infinity"])
def test_endless_floats_have_no_entity(spark, bad):
    df = spark.range(1).selectExpr(
        "id AS event_id", "1L AS user_id", "'t' AS ts", "'e' AS event_type", f"double('{bad}') AS value", "'{}' AS props", "'p' AS __partition"
    )
    with pytest.raises(PySparkException, match="NaN or infinity in field value"):
        to_entities(df, EVENTS).collect()


@pytest.mark.parametrize(
    "entity", ['{"event_id":1', '{"event_id":99999999999999999999}', '{"event_id":"x"}', '{"event_id":null}', "[]"]
)
def test_bad_entities_fail(spark, entity):
    df = spark.createDataFrame([(entity, "p")], "entity string, __partition string")
    with pytest.raises(Exception, match="MALFORMED_RECORD|null in the non-nullable field"):
        from_entities(df, EVENTS).collect()


def test_batches(spark):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello"))
    plan = {r.asDict()["__partition"]: (r.row_count, r.batches) for r in batch_plan(df, 100).collect()}
    assert plan["_default"] == (248, 3) and plan["p5"] == (51, 1)

    def size(batch):
        return pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    sizes = [r.n for r in map_batches(df.select("id").coalesce(1), size, "n long", 60).collect()]
    assert sizes == [60] * 8 + [20]
    for batchsize in (7, 60, 20_000):
        found = [r.n for r in map_batches(df.select("id", "__partition"), size, "n long", batchsize).collect()]
        planned = batch_plan(df, batchsize).agg(F.sum("batches"), F.sum("row_count")).first()
        assert (len(found), sum(found)) == tuple(planned) and max(found) <= batchsize


def test_batches_have_addresses(spark):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello"))
    whole = {r.id: r["__partition"] for r in df.select("id", "__partition").collect()}
    found = []
    for split in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            found.append(sorted(batch_addresses(df, 60).collect()))
            rows = with_address(df, 60).groupBy("__partition", "file", "start").count().collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(map(tuple, rows)) == list(map(tuple, found[-1]))
    assert found[0] == found[1] and sum(a["rows"] for a in found[0]) == len(whole)
    seen = []
    for address in found[0]:
        batch = read_batch(df, address, ["id", "__partition"])
        rows = batch.collect()
        assert len(rows) == address["rows"] <= 60 and {r["__partition"] for r in rows} == {address["__partition"]}
        seen += [(r.id, r["__partition"]) for r in rows]
    assert sorted(seen) == sorted(whole.items())
    assert [f.rsplit("/", 1)[1] for f in batch.inputFiles()] == [address["file"].rsplit("/", 1)[1]]
    assert "ReadSchema: struct<id:bigint," in batch._jdf.queryExecution().executedPlan().toString()
    plan = batch_addresses(df, 60)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_a_batch_holds_one_partition(spark):
    df = spark.range(30_000, numPartitions=2).selectExpr("id", "concat('p', id % 3) AS __partition")

    def one(batch):
        names = set(batch.column("__partition").to_pylist())
        return pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows]), "names": pa.array([len(names)])})

    found = map_batches(df, one, "n long, names long", 4000).collect()
    assert all(r.names == 1 for r in found) and sorted(r.n for r in found) == [1000] * 6 + [4000] * 6


JSON_TEXTS = {
    '{"a":1}': True, "[1, 2]": True, ' "x" ': True, "null": True, "12": True, '{"a":"\\u0041\\""}': True,
    '{"a":1} x': False, '{"a":1}}': False, '{"a":1}{"b":2}': False, '[1],"x":{"y":2}': False, '{"a":1},2': False,
    "": False, "{": False, '{"a":1,"a":2}': False, "NaN": False, '1,"x"]': False,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_only_whole_json_is_bound(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        schema = CollectionSchema([Field("j", "JSON", nullable=True)])
        for text, right in JSON_TEXTS.items():
            df = spark.createDataFrame([(text, "p")], "j string, __partition string")
            if right:
                assert to_entities(df, schema).first().entity == '{"j":' + text + "}"
            else:
                with pytest.raises(Exception, match="invalid JSON in field j"):
                    to_entities(df, schema).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_entities_give_equal_values_or_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    schema = CollectionSchema([Field("j", "JSON", nullable=True), Field("s", "SparseFloatVector", nullable=True)])

    def back(entity):
        df = spark.createDataFrame([(entity, "p")], "entity string, __partition string")
        return from_entities(df, schema).first()

    try:
        for text in ('{"b":0.1,"a":[1,"x"]}', "12345678901234567890123456789012345678901", '"Infinity"', "1.5", '"a 1e999"', "true"):
            assert back('{"j":' + text + ',"s":{"3":1.5}}').j == text
        assert back('{"j":null,"s":null}').j is None
        for text in ("1.50", "1E-400", "0.12345678901234567890123", "[123456789012345678901.5,  {}]", "1e400"):
            assert back('{"j": ' + text + ' ,"s":null}').j == text
        for key in ("1.5", "x", "-1", ""):
            with pytest.raises(Exception, match="whole number"):
                back('{"j":1,"s":{"' + key + '":1}}')
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


SEARCHED = CollectionSchema(
    [
        Field("id", "Int64", primary_key=True),
        Field("dense", "FloatVector", nullable=True, dim=8, metric="COSINE"),
        Field("fp16", "Float16Vector", dim=8, metric="COSINE"),
        Field("bf16", "BFloat16Vector", dim=8, metric="COSINE"),
        Field("packed", "BinaryVector", dim=16, metric="HAMMING"),
        Field("sparse", "SparseFloatVector", metric="IP"),
        Field("plain", "FloatVector", dim=2),
    ]
)


@pytest.fixture(scope="module")
def vectors(spark):
    """1,200 rows, a third of them copies of one vector, some without one."""
    key = F.expr("IF(id % 3 = 0, 0, id)")
    df = spark.range(1200).select(
        "id",
        F.when(F.col("id") % 50 != 7, generators.random_float_vector(key, 8)).alias("dense"),
        generators.random_half_vector(key, 8, False).alias("fp16"),
        generators.random_half_vector(key, 8, True).alias("bf16"),
        generators.random_binary_vector(key, 16).alias("packed"),
        F.expr("map(id % 13, FLOAT(id % 100) / 8, 20 + id % 7, 0.5F)").alias("sparse"),
    )
    return df.cache()


def brute_force(rows, queries, metric, k):
    found = []
    for number, query in queries:
        scored = []
        for i, vector in rows:
            if vector is None:
                continue
            if metric == "IP":
                if not set(vector) & set(query):
                    continue
                score = sum(w * query.get(d, 0.0) for d, w in vector.items())
            elif metric == "HAMMING":
                score = sum(bin((a ^ b) & 255).count("1") for a, b in zip(vector, query))
            else:
                a, b = np.array(vector, float), np.array(query, float)
                score = float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
            scored.append((round(score if metric == "HAMMING" else -score, 12), i))
        for rank, (order, i) in enumerate(sorted(scored)[:k], 1):
            found.append((number, rank, i, round(abs(order), 6)))
    return found


def decoded(values, name):
    array = np.array(values, np.int8)
    if name == "fp16":
        return array.view("<f2").astype(float)
    return (array.view("<u2").astype(np.uint32) << 16).view(np.float32).astype(float)


@pytest.mark.parametrize("name", ["dense", "fp16", "bf16", "packed", "sparse"])
@pytest.mark.parametrize("many_blocks", [False, True])
def test_top_k_equals_brute_force(spark, vectors, monkeypatch, name, many_blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "SPARSE_MATCHES", 50)
    queries = vectors.where(f"id IN (0, 1, 2, 100, 555, 1001) AND {name} IS NOT NULL").selectExpr(
        "concat('q', id) AS query_id", f"{name} AS query_vector"
    )
    bound = 400 if many_blocks else topk.BLOCK_BYTES
    df = topk.top_k(vectors, SEARCHED, name, queries, 7, block_bytes=bound)
    found = sorted((r.query_id, r["rank"], r.id, round(r.score, 6)) for r in df.collect())
    def convert(v):
        return decoded(v, name) if name in ("fp16", "bf16") else v

    rows = [(r.id, r[name] if r[name] is None else convert(r[name])) for r in vectors.select("id", name).collect()]
    asked = [(r.query_id, convert(r.query_vector)) for r in queries.collect()]
    expected = brute_force(rows, asked, SEARCHED[name].metric, 7)
    assert [f[:3] for f in found] == [e[:3] for e in sorted(expected)]
    assert np.allclose([f[3] for f in found], [e[3] for e in sorted(expected)], atol=1e-6)


def test_bad_queries_are_errors(spark, vectors):
    good = vectors.where("id < 3").selectExpr("id AS query_id", "dense AS query_vector")
    endless = good.withColumn("query_vector", F.expr("array_repeat(float('NaN'), 8)"))
    bad = {
        "null id": good.withColumn("query_id", F.lit(None).cast("long")),
        "null id or vector": good.withColumn("query_vector", F.lit(None).cast("array<float>")),
        "repeat": good.unionByName(good),
        "NaN": endless,
    }
    for message, queries in bad.items():
        with pytest.raises(ValueError, match=message):
            topk.top_k(vectors, SEARCHED, "dense", queries, 1)
    with pytest.raises(ValueError, match="exceeds"):
        topk.top_k(vectors, SEARCHED, "dense", good, 1, block_bytes=8)


def test_endless_rows_rank_last(spark):
    schema = CollectionSchema([Field("id", "Int64", primary_key=True), Field("v", "FloatVector", dim=2, metric="COSINE")])
    df = spark.sql(
        "SELECT * FROM VALUES (1L, array(1F, 0F)), (2L, array(float('NaN'), 1F)), (3L, array(-1F, 0F)),"
        " (4L, array(1F, float('Infinity'))) AS t(id, v)"
    )
    found = topk.top_k(df, schema, "v", spark.sql("SELECT 1 AS query_id, array(1F, 0F) AS query_vector"), 10)
    assert [(r.id, r.score) for r in found.orderBy("rank").collect()] == [(1, 1.0), (3, -1.0), (2, None), (4, None)]


def test_text_keys_are_kept_whole(spark):
    schema = CollectionSchema([Field("id", "VarChar", primary_key=True), SEARCHED["packed"]])
    df = spark.createDataFrame([("a\0",), ("a",), ("b" * 70_000,)], "id string").selectExpr("id", "array(1Y, 2Y) AS packed")
    queries = spark.sql("SELECT 1 AS query_id, array(1Y, 2Y) AS query_vector")
    assert [r.id for r in topk.top_k(df, schema, "packed", queries, 3).orderBy("rank").collect()] == ["a", "a\0", "b" * 70_000]


def test_k_beyond_the_rows_and_no_queries(spark, vectors):
    few = vectors.where("id < 4")
    queries = few.selectExpr("id AS query_id", "packed AS query_vector")
    assert topk.top_k(few, SEARCHED, "packed", queries, 10).count() == 16
    assert topk.top_k(vectors, SEARCHED, "packed", queries.limit(0), 10).count() == 0


def test_zero_vector_has_cosine_zero(spark):
    df = spark.sql("SELECT 1L AS id, array(0F,0F,0F,0F,0F,0F,0F,0F) AS dense")
    queries = spark.sql("SELECT 1 AS query_id, array(1F,0F,0F,0F,0F,0F,0F,0F) AS query_vector")
    assert topk.top_k(df, SEARCHED, "dense", queries, 1).first().score == 0.0


def test_text_keys_tie_in_order(spark):
    schema = CollectionSchema([Field("id", "VarChar", primary_key=True), SEARCHED["packed"]])
    df = spark.range(50).selectExpr("concat('k', id) AS id", "array(1Y, 2Y) AS packed")
    queries = spark.sql("SELECT 1 AS query_id, array(1Y, 2Y) AS query_vector")
    found = topk.top_k(df, schema, "packed", queries, 4).orderBy("rank").collect()
    assert [r.id for r in found] == sorted(f"k{i}" for i in range(50))[:4]


def test_field_without_metric_is_not_searched(spark, vectors):
    queries = spark.sql("SELECT 1 AS query_id, array(1F, 2F) AS query_vector")
    with pytest.raises(SchemaError, match="plain"):
        topk.top_k(vectors, SEARCHED, "plain", queries, 1)


def test_collection_is_scanned_without_a_shuffle(spark):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello"))
    queries = spark.sql("SELECT 1 AS query_id, array_repeat(1F, 64) AS query_vector")
    rows = df.selectExpr("id", "vec_dense AS vector").where("vector IS NOT NULL")
    shared = spark.sparkContext.broadcast(queries.toArrow())
    asked = queries.withColumnRenamed("query_vector", "vector")
    planned = topk.ranked(rows, shared, topk._Search("FloatVector", 3), asked, "COSINE")
    text = planned._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("MapInArrow") :]
    assert "Exchange" not in scan and "IsNotNull(vec_dense)" in scan and "f9" not in scan
    assert text.count("WindowGroupLimit") == 4


def test_queries_are_evaluated_once(spark, vectors):
    """A query set that isn't deterministic is searched as it was when it was written."""
    ids = F.expr("CAST(rand() * 1e15 AS BIGINT)").alias("query_id")
    queries = vectors.where("id < 40 AND dense IS NOT NULL").select(ids, F.col("dense").alias("query_vector"))
    found = topk.top_k(vectors, SEARCHED, "dense", queries, 2, block_bytes=100)
    first = {r.query_id for r in found.collect()}
    assert len(first) == queries.count() and first == {r.query_id for r in found.collect()}


def test_blocks_are_cut_by_bytes(spark):
    rows = [(f"{i}" * (1 if i % 10 else 300), [float(i)] * (i % 7)) for i in range(200)]
    asked = spark.createDataFrame(rows, "query_id string, vector array<double>")
    blocks = [b.collect() for b in topk._blocks(asked, 1000)]
    assert sorted(r.query_id for b in blocks for r in b) == sorted(i for i, _ in rows) and len(blocks) > 10
    assert all(sum(len(r.query_id) + 8 * len(r.vector) for r in b) <= 2000 for b in blocks)


def test_rows_below_every_bar_are_skipped(spark):
    rng = np.random.default_rng(0)
    rows = [(i, {int(d): float(w) for d, w in zip(rng.choice(300, 12, replace=False), rng.exponential(size=12) ** 2 * rng.choice([1, -0.2], 12), strict=True)}) for i in range(3000)]
    kind = pa.map_(pa.int64(), pa.float64())
    vectors = pa.array([list(v.items()) for _, v in rows], kind)
    score = topk._sparse_products(vectors.slice(0, 20))
    plain = topk._sparse_products(vectors.slice(0, 20))(vectors, np.full(20, np.inf))
    kept = topk._Kept(5, 20)
    for start in range(0, 3000, 250):
        kept.add(score(vectors.slice(start, 250), kept.bars), pa.array(range(start, start + 250)))
    best = np.sort(np.round(plain, topk.SCORE_DECIMALS), axis=1)[:, :5]
    order = kept.order.reshape(20, 5)
    assert np.allclose(order, best, atol=1e-12) and score.skipped > 300


def test_hamming_holds_packed_words():
    rng = np.random.default_rng(0)
    for width in (1, 7, 8, 16, 23):
        given = rng.integers(-128, 128, (50, width)).astype(np.int8)
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(given.ravel()), width).cast(pa.list_(pa.int8()))
        bits = np.unpackbits(given.view(np.uint8), axis=1)
        expected = (bits[:9, None] != bits[None]).sum(2)
        assert (topk._hamming_distances(vectors.slice(0, 9))(vectors, np.full(9, np.inf)) == expected).all()
    wide = pa.FixedSizeListArray.from_arrays(pa.array(np.zeros(20_000 * 128, np.int8)), 128).cast(pa.list_(pa.int8()))
    score = topk._hamming_distances(wide.slice(0, 2))
    tracemalloc.start()
    score(wide, np.full(2, np.inf))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * 20_000 * 128  # 32 times as much as bits of four bytes
