"""Reads and writes by option calls: the plans of the native scan and append."""

import pyarrow as pa
import pytest
from conftest import SF_DIR

from vectable.plans.errors import CollectionNotFoundError, OptionError, SaveModeError
from vectable.sources.catalog import create_collection
from vectable.sources.collection import read_collection
from vectable.sources.facade import reader, writer
from vectable.workload.recipes import HELLO, HELLO_AUTO, kept_collection


def comparable(df):
    return df.selectExpr("* EXCEPT (vec_sparse)", "map_entries(vec_sparse) AS vec_sparse")


def test_reads_and_appends_the_same_rows(spark, uri):
    held = kept_collection(spark, SF_DIR, "hello")
    found = reader(spark).option("uri", held.uri).option("collection", "hello").load()
    create_collection(spark, {"uri": uri, "collection": "target"}, HELLO)
    writer(found).options(uri=uri, collection="target").mode("append").save()
    stored = read_collection(spark, {"uri": uri, "collection": "target"})
    native = read_collection(spark, held)
    assert found.schema == native.schema
    assert comparable(stored).exceptAll(comparable(native)).count() == 0 and stored.count() == native.count()


def test_columns_and_partitions_are_pruned(spark):
    held = kept_collection(spark, SF_DIR, "hello")
    call = reader(spark).options(uri=held.uri, collection="hello", partition="p7")
    text = call.load().select("f9")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__partition" in text and "ReadSchema: struct<f9:string>" in text


def test_batchsize_bounds_files_and_batches(spark, uri):
    held = kept_collection(spark, SF_DIR, "hello")
    target = {"uri": uri, "collection": "auto", "batchsize": 60}
    create_collection(spark, target, HELLO_AUTO)
    writer(read_collection(spark, held)).options(**target).save()
    stored = read_collection(spark, target)
    assert stored.select("id").distinct().count() == 500
    assert stored.groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] <= 60

    def size(batch):
        return pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    sizes = [r.n for r in reader(spark).options(**target).map_batches(size, "n long").collect()]
    assert sum(sizes) == 500 and max(sizes) <= 60


def test_bad_calls(spark, uri):
    df = read_collection(spark, kept_collection(spark, SF_DIR, "hello"))
    for given, error in (({"uri": uri}, OptionError), ({"collection": "c"}, OptionError), ({"uri": uri, "collection": "gone"}, CollectionNotFoundError)):
        with pytest.raises(error):
            reader(spark).options(**given).load()
        with pytest.raises(error):
            writer(df).options(**given).save()
    for mode in ("overwrite", "ignore", "errorifexists"):
        with pytest.raises(SaveModeError):
            writer(df).options(uri=uri, collection="c").mode(mode).save()
