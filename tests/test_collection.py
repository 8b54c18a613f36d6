"""Catalog, scans, appends and SQL tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import SF_DIR
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vectable.operators.entities import from_entities, to_entities
from vectable.operators.topk import top_k
from vectable.plans.errors import CollectionExistsError, CollectionNotFoundError, SaveModeError
from vectable.plans.schema import CollectionSchema, Field
from vectable.plans.options import CollectionOptions
from vectable.sources import autoid, paths
from vectable.sources.catalog import (
    create_collection,
    describe_collection,
    drop_collection,
    has_collection,
    load_schema,
)
from vectable.sources.collection import (
    _counted,
    _route,
    append_collection,
    count_rows,
    copy_collection,
    list_partitions,
    read_collection,
)
from vectable.sources.tables import create_table, partition_names
from vectable.workspace import shared_folder
from vectable.workload.recipes import HELLO, hello_rows, kept_collection

SIMPLE = CollectionSchema([Field("id", "Int64", primary_key=True, description="it's the key"), Field("n", "Int32")])


@pytest.fixture
def options(spark, uri):
    options = {"uri": uri, "collection": "simple"}
    create_collection(spark, options, SIMPLE)
    return options


def rows(spark, count, partition="CAST(id % 3 AS STRING)"):
    return spark.range(count).selectExpr("id", "INT(id * 2) AS n", f"{partition} AS __partition")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_lifecycle(spark, uri, options):
    assert has_collection(spark, options)
    assert read_collection(spark, options).count() == 0
    with pytest.raises(CollectionExistsError):
        create_collection(spark, options, SIMPLE)
    append_collection(rows(spark, 9), options)
    create_collection(spark, options, HELLO, replace=True)
    assert load_schema(spark, options) == HELLO and read_collection(spark, options).count() == 0
    assert drop_collection(spark, options) and not drop_collection(spark, options)
    assert not has_collection(spark, options)


def test_missing_collection_is_named(spark, uri):
    missing = {"uri": uri, "collection": "gone", "database": "db7"}
    for call in (read_collection, describe_collection, lambda s, o: append_collection(rows(s, 1), o)):
        with pytest.raises(CollectionNotFoundError, match="gone.*db7"):
            call(spark, missing)


def test_databases_are_apart(spark, uri, options):
    other = {**options, "database": "other"}
    create_collection(spark, other, SIMPLE)
    append_collection(rows(spark, 4), other)
    assert read_collection(spark, options).count() == 0 and read_collection(spark, other).count() == 4


@pytest.mark.parametrize("mode", ["overwrite", "ignore", "error", "errorifexists"])
def test_only_append(spark, options, mode):
    with pytest.raises(SaveModeError, match="Only Append mode is supported"):
        append_collection(rows(spark, 1), options, mode=mode)


def test_appends_add_up_and_may_repeat_keys(spark, options):
    append_collection(rows(spark, 6), options)
    append_collection(rows(spark, 6), options)
    assert read_collection(spark, options).groupBy("id").count().where("count <> 2").count() == 0


def test_failed_append_leaves_nothing(spark, options):
    bad = rows(spark, 1000).withColumn("n", F.expr("IF(id = 999, NULL, n)"))
    with pytest.raises(PySparkException, match="non-nullable field n"):
        append_collection(bad, options)
    assert read_collection(spark, options).count() == 0


def test_preview(spark, options, capsys):
    append_collection(rows(spark, 9), options)
    read_collection(spark, options).orderBy("id").show(5, False)
    lines = capsys.readouterr().out.splitlines()
    assert lines[1] == "|id |n  |__partition|" and "|4  |8  |1          |" in lines
    assert "only showing top 5 rows" in lines


def test_partition_names_are_kept_as_text(spark, options):
    names = ["01", "1", "a b", "x=y", "100%", "a/b", "ü", "__HIVE", "null"]
    listed = ", ".join(f"'{n}'" for n in names)
    append_collection(rows(spark, 90, f"element_at(array({listed}), INT(id % 9) + 1)"), options)
    assert {r[0] for r in list_partitions(spark, options).collect()} == set(names)
    assert all(read_collection(spark, options, partition=n).count() == 10 for n in names)


def test_describe_keeps_nullability_and_comments(spark, options):
    found = [tuple(r) for r in describe_collection(spark, options).orderBy("position").collect()]
    assert found == [
        (0, "id", "bigint", False, "it's the key"),
        (1, "n", "int", False, ""),
        (2, "__partition", "string", False, ""),
    ]


def test_scan_prunes_partitions_and_columns(spark):
    options = kept_collection(spark, SF_DIR, "hello")
    text = plan(read_collection(spark, options, partition="p7").where("f5 > 10").select("id"))
    assert "PartitionFilters: [isnotnull(__partition" in text and "= p7)]" in text
    assert "GreaterThan(f5,10)" in text
    assert "ReadSchema: struct<id:bigint,f5:int>" in text
    assert "Exchange" not in text


def test_copy_has_no_shuffle_and_keeps_rows(spark, uri):
    target = {"uri": uri, "collection": "copied"}
    create_collection(spark, target, HELLO)
    source = kept_collection(spark, SF_DIR, "hello")
    copy_collection(spark, source, target)
    columns = [c for c in HELLO.struct.names if c != "vec_sparse"]
    left, right = (read_collection(spark, o).select(*columns) for o in (source, target))
    assert left.exceptAll(right).count() == 0 and left.count() == right.count()


def test_hot_partition_is_split(spark, options):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        append_collection(rows(spark, 300_000, "'_default'").repartition(16), options)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = read_collection(spark, options).select("_metadata.file_path").distinct().count()
    assert files >= 8


def test_routing_without_adaptive_execution_salts(spark, options):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        routed = _route(rows(spark, 10_000, "'_default'"))
        filled = routed.groupBy(F.spark_partition_id()).count().count()
        append_collection(rows(spark, 10_000, "'_default'"), options)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert filled == 8
    assert read_collection(spark, options).count() == 10_000


def test_equal_rows_fill_all_writers_without_adaptive_execution(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        routed = _route(spark.range(10_000, numPartitions=2).selectExpr("1L AS id", "2 AS n", "'p' AS __partition"))
        assert routed.groupBy(F.spark_partition_id()).count().count() == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_are_counted_from_footers(spark, options):
    assert count_rows(spark, options) == 0
    append_collection(rows(spark, 3000, "'a'"), options)
    append_collection(rows(spark, 2000, "'b'"), options)
    opts = CollectionOptions.of(options)
    for partition, expected in ((None, 5000), ("b", 2000), ("absent", 0)):
        assert count_rows(spark, options, partition) == expected
        counted = _counted(spark, load_schema(spark, options), opts, partition)
        assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_batchsize_bounds_files_only_when_given(spark, options):
    append_collection(rows(spark, 5000, "'a'"), options)
    append_collection(rows(spark, 5000, "'b'"), {**options, "batchsize": "700"})
    per_file = read_collection(spark, options).groupBy("__partition", "_metadata.file_path").count()
    most = dict(per_file.groupBy("__partition").agg(F.max("count")).collect())
    assert most["a"] == 5000 and most["b"] <= 700


def test_auto_ids_follow_existing_ones(spark, uri):
    schema = CollectionSchema([Field("k", "Int32"), Field("id", "Int64", primary_key=True, auto_id=True)])
    options = {"uri": uri, "collection": "auto"}
    create_collection(spark, options, schema)
    offered = rows(spark, 1000).selectExpr("INT(id) AS k", "-1L AS id", "__partition")
    append_collection(offered, options)
    first = read_collection(spark, options).agg(F.max("id")).first()[0]
    append_collection(offered.drop("id"), options)
    df = read_collection(spark, options)
    assert df.columns == ["k", "id", "__partition"]
    assert df.select("id").distinct().count() == 2000 and df.where(F.col("id") < 0).count() == 0
    assert df.where(F.col("id") > first).count() == 1000


AUTO = CollectionSchema([Field("id", "Int64", primary_key=True, auto_id=True), Field("k", "Int32")])


@pytest.fixture
def auto(spark, uri):
    options = {"uri": uri, "collection": "auto"}
    create_collection(spark, options, AUTO)
    return options


def keys(spark, n):
    return rows(spark, n).selectExpr("INT(id) AS k", "__partition")


def test_settled_ranges_follow_without_a_look_at_the_data(spark, auto, monkeypatch):
    append_collection(keys(spark, 10), auto)
    opts = CollectionOptions.of(auto)
    highest = read_collection(spark, auto).agg(F.max("id")).first()[0]
    with monkeypatch.context() as blind:
        blind.setattr(CollectionSchema, "struct", property(lambda self: pytest.fail("the data is read")))
        assert autoid._take_ticket(spark, AUTO, opts) == (2, highest + 1)
        assert autoid._take_ticket(spark, AUTO, opts) == (3, highest + 1 + autoid.SPAN)  # 2 never settles
    append_collection(keys(spark, 10), auto)
    drawn = read_collection(spark, auto).select("id").distinct()
    assert drawn.count() == 20 and drawn.agg(F.max("id")).first()[0] > highest + 2 * autoid.SPAN
    append_collection(keys(spark, 10), auto)
    assert len(autoid._tickets(spark, opts)) <= 3


def test_rows_that_came_another_way_count(spark, auto):
    opts = CollectionOptions.of(auto)
    spark.sql("SELECT 41L AS id, 1 AS k, 'p' AS __partition").write.partitionBy("__partition").parquet(opts.data_path, mode="append")
    assert autoid._take_ticket(spark, AUTO, opts) == (1, 42)


def test_a_failed_append_costs_its_range_only(spark, auto):
    bad = keys(spark, 10).withColumn("k", F.expr("CAST(raise_error('stop') AS INT)"))
    with pytest.raises(Exception, match="stop"):
        append_collection(bad, auto)
    append_collection(keys(spark, 10), auto)
    assert read_collection(spark, auto).agg(F.min("id"), F.count("*")).first()[:] == (autoid.SPAN, 10)


def test_tickets_are_published_once(spark, uri):
    texts = [f"{i}" * 1000 for i in range(12)]
    with ThreadPoolExecutor(12) as pool:
        done = list(pool.map(lambda t: paths.publish_text(spark, f"{uri}/ids/1.first", t), texts))
    assert sum(done) == 1 and paths.read_text(spark, f"{uri}/ids/1.first") == texts[done.index(True)]
    assert paths.children(spark, f"{uri}/ids") == ["1.first"]


def test_a_late_ticket_gives_way_to_a_higher_one(spark, auto, monkeypatch):
    """An append that listed the tickets long ago must not take a number that was used and cleared."""
    opts = CollectionOptions.of(auto)
    for _ in range(4):
        append_collection(keys(spark, 2), auto)
    listed = autoid._tickets
    stale = iter([{1: {"first"}}])
    monkeypatch.setattr(autoid, "_tickets", lambda *a: next(stale, None) or listed(*a))
    number, first = autoid._take_ticket(spark, AUTO, opts)
    assert number == 5 and first > read_collection(spark, auto).agg(F.max("id")).first()[0]


def test_appends_side_by_side_draw_different_ids(spark, auto):
    def slow(n):
        spin = F.expr("aggregate(sequence(1, 20000), INT(0), (a, x) -> a + x % 2)")
        return keys(spark, n).withColumn("k", F.col("k") + spin)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: append_collection(slow(n), auto), [500, 700, 300, 500]))
    found = read_collection(spark, auto)
    assert found.count() == 2000 == found.select("id").distinct().count()
    data = CollectionOptions.of(auto).data_path
    assert "_temporary" not in paths.children(spark, data)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_auto_ids_run_out(spark, auto, ansi):
    folder = autoid._folder(CollectionOptions.of(auto))
    paths.publish_text(spark, f"{folder}/000000000001.first", '{"first": 0}')
    paths.publish_text(spark, f"{folder}/000000000001.settled", f'{{"next": {autoid.LARGEST - 2}}}')
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="no ids are left"):
            append_collection(keys(spark, 10), auto)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert read_collection(spark, auto).count() == 0


def test_listing_partitions_asks_nothing_per_file(spark, options, monkeypatch):
    client = spark.sparkContext._gateway._gateway_client
    send, calls = client.send_command, []
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))

    def count():
        calls.clear()
        assert partition_names(spark, CollectionOptions.of(options).data_path) == ["a", "b"]
        return len(calls)

    append_collection(rows(spark, 4, "element_at(array('a', 'b'), INT(id % 2) + 1)"), options)
    few = count()
    append_collection(rows(spark, 400, "element_at(array('a', 'b'), INT(id % 2) + 1)"), options | {"batchsize": 5})
    assert abs(count() - few) <= 2


def test_partitions_are_listed_from_directories(spark, options):
    assert list_partitions(spark, options).count() == 0
    append_collection(rows(spark, 6, "concat('a b/', id % 2, '%')"), options)
    listed = list_partitions(spark, options)
    assert {r[0] for r in listed.collect()} == {"a b/0%", "a b/1%"} and "parquet" not in plan(listed).lower()


def test_sql_table_sees_later_partitions(spark, options):
    append_collection(rows(spark, 6), options)
    create_table(spark, options, "2024_docs")
    try:
        assert spark.table("`2024_docs`").count() == 6
        append_collection(rows(spark, 4, "'new'"), options, table="2024_docs")
        assert spark.sql("SELECT count(*) FROM `2024_docs`").first()[0] == 10
        described = {r.col_name: r.comment for r in spark.sql("DESCRIBE `2024_docs`").collect()}
        assert described["id"] == "it's the key"
        shown = {r[0] for r in spark.sql("SHOW PARTITIONS `2024_docs`").collect()}
        assert "__partition=new" in shown
    finally:
        spark.sql("DROP TABLE `2024_docs`")
    assert read_collection(spark, options).count() == 10


def test_columns_bind_by_name(spark, uri):
    target = {"uri": uri, "collection": "shuffled"}
    create_collection(spark, target, HELLO)
    source = hello_rows(spark, SF_DIR)
    append_collection(source.select(*reversed(source.columns)), target)
    columns = [c for c in HELLO.struct.names if c != "vec_sparse"]
    assert read_collection(spark, target).select(*columns).exceptAll(source.select(*columns)).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_odd_field_names(spark, uri, adaptive):
    schema = CollectionSchema(
        [
            Field("the.id", "Int64", primary_key=True, auto_id=True),
            Field("a b", "VarChar", max_length=9),
            Field("it`s 'x'", "JSON", nullable=True),
            Field("v.1", "FloatVector", dim=2, metric="COSINE"),
        ]
    )
    options = {"uri": uri, "collection": "odd"}
    create_collection(spark, options, schema)
    offered = spark.createDataFrame(
        [("x", '{"k": 1}', [1.0, 2.0], "p"), ("y", None, [2.0, 1.0], "p")],
        "`a b` string, `it``s 'x'` string, `v.1` array<float>, __partition string",
    )
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        append_collection(offered, options)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    df = read_collection(spark, options)
    assert df.columns == ["the.id", "a b", "it`s 'x'", "v.1", "__partition"]
    back = from_entities(to_entities(df, schema), schema)
    assert {tuple(r[:2]) for r in back.collect()} == {("x", '{"k": 1}'), ("y", None)}
    queries = spark.sql("SELECT 1 AS query_id, array(1F, 2F) AS query_vector")
    assert round(top_k(df, schema, "v.1", queries, 1).first().score, 6) == 1.0
    create_table(spark, options, "odd_table")
    try:
        assert spark.sql("SELECT `a b` FROM odd_table WHERE `the.id` >= 0").count() == 2
    finally:
        spark.sql("DROP TABLE odd_table")


def test_small_partitions_have_one_writer_and_hot_ones_all_without_adaptive_execution(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        value = "IF(id % 2 = 0, 'hot', concat('p', id % 100))"
        routed = _route(spark.range(20_000).selectExpr("id", "id AS k", f"{value} AS __partition"))
        at = routed.select("__partition", F.spark_partition_id().alias("at"))
        writers = at.groupBy("__partition").agg(F.count_distinct("at").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert routed.columns == ["id", "k", "__partition"]
    by_value = {r["__partition"]: r["n"] for r in writers}
    assert by_value.pop("hot") >= 7 and set(by_value.values()) == {1}


def test_a_replace_that_fails_leaves_the_old_rows(spark, options, monkeypatch):
    append_collection(rows(spark, 9), options)

    def fail(*_):
        raise OSError("no disk")

    with monkeypatch.context() as broken:
        broken.setattr(paths, "replace_text", fail)
        with pytest.raises(OSError):
            create_collection(spark, options, HELLO, replace=True)
    assert load_schema(spark, options) == SIMPLE and read_collection(spark, options).count() == 9
    with monkeypatch.context() as watched:
        watched.setattr(paths, "delete", lambda *_: pytest.fail("removed before the swap") if has_old() else True)
        has_old = lambda: load_schema(spark, options) == SIMPLE
        create_collection(spark, options, HELLO, replace=True)
    assert load_schema(spark, options) == HELLO and read_collection(spark, options).count() == 0
    assert drop_collection(spark, options)
    assert paths.children(spark, CollectionOptions.of(options).collection_path) == []


def test_a_replaced_collection_takes_rows_ids_and_tables_along(spark, uri):
    options = {"uri": uri, "collection": "again"}
    keyed = CollectionSchema([Field("id", "Int64", primary_key=True, auto_id=True), Field("n", "Int64")])
    create_collection(spark, options, keyed)
    create_table(spark, options, "again_table")
    try:
        append_collection(spark.sql("SELECT 1L AS n, 'a' AS __partition"), options, table="again_table")
        for turn in range(2):
            create_collection(spark, options, keyed, replace=True)
            append_collection(spark.sql(f"SELECT {turn + 5}L AS n, 'b' AS __partition"), options, table="again_table")
            found = [tuple(r) for r in spark.table("again_table").collect()]
            assert found == [tuple(r) for r in read_collection(spark, options).collect()] == [(0, turn + 5, "b")]
            names = paths.children(spark, f"{uri}/default/again")
            assert sum(name.startswith("data") for name in names) == 1
        assert count_rows(spark, options) == 1 and [r[0] for r in list_partitions(spark, options).collect()] == ["b"]
    finally:
        spark.sql("DROP TABLE IF EXISTS again_table")


def test_scratch_beside_a_local_warehouse_is_refused_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "/tmp/somewhere"}
        _jvm, _jsc = spark._jvm, spark._jsc

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session())
    Context.master = "local[2]"
    assert shared_folder(Session()).startswith("file:")
