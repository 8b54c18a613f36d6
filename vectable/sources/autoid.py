"""Auto ids drawn by an append, from ranges that tickets give out.

Every append takes a ticket, a small numbered file beside the definition that says at which id
its range begins. A ticket is published by one step that fails if its number is taken, so of
appends that start together each gets its own; nothing is ever overwritten. When an append has
committed its rows it settles its ticket by the highest id it drew, and the next range begins
right above it. A range whose append is still running, or died, is left whole: the next one begins
``SPAN`` ids later. Every writing task takes 2**33 ids of its append's range.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vectable.plans.options import CollectionOptions
from vectable.plans.schema import PARTITION_COLUMN, CollectionSchema
from vectable.plans.sqltext import quoted_name
from vectable.sources import paths

LARGEST = (1 << 63) - 1
SPAN = 1 << 50  # ids kept for an append that hasn't settled: 131,072 tasks of any size


@contextmanager
def auto_ids(df: DataFrame, schema: CollectionSchema, opts: CollectionOptions) -> Iterator[DataFrame]:
    """``df`` with the auto-id field filled, in field order; to be written inside the block.

    Ids are drawn in the writing stage, after routing: a lost task is replaced as a whole together
    with its uncommitted file, so no id is ever handed out twice. Appends may run side by side. An
    append that passes its range, or the largest id, fails and leaves no rows.
    """
    spec = schema.auto_id_field
    if spec is None:
        yield df
        return
    spark = df.sparkSession
    number, first = _take_ticket(spark, schema, opts)
    drawn = F.monotonically_increasing_id()
    error = F.raise_error(F.lit(f"no ids are left for field {spec.name}")).cast("bigint")
    fresh = F.when(drawn > min(SPAN - 1, LARGEST - first), error).otherwise(drawn + F.lit(first))
    names = [quoted_name(f.name) for f in schema.visible_fields] + [PARTITION_COLUMN]
    seen = Observation()
    yield df.withColumn(spec.name, fresh).select(*names).observe(seen, F.max(quoted_name(spec.name)).alias("last"))
    last = seen.get["last"]
    next_id = first if last is None else last + 1
    paths.publish_text(spark, f"{_folder(opts)}/{number:012d}.settled", json.dumps({"next": next_id}))


def _folder(opts: CollectionOptions) -> str:
    return opts.ids_path


def _tickets(spark: SparkSession, opts: CollectionOptions) -> dict[int, set[str]]:
    """The published tickets by number, each with the kinds of its files."""
    found: dict[int, set[str]] = {}
    for name in paths.children(spark, _folder(opts)):
        number, _, kind = name.partition(".")
        if number.isdigit():
            found.setdefault(int(number), set()).add(kind)
    return {number: kinds for number, kinds in found.items() if "first" in kinds}


def _take_ticket(spark: SparkSession, schema: CollectionSchema, opts: CollectionOptions) -> tuple[int, int]:
    """A number no other append has, and the first id of its range."""
    folder = _folder(opts)
    while True:
        tickets = _tickets(spark, opts)
        last = max(tickets, default=0)
        try:
            first = _range_after(spark, schema, opts, last, tickets.get(last))
        except FileNotFoundError:  # a newer ticket is there, and the one just listed was cleared
            continue
        number = last + 1
        if not paths.publish_text(spark, f"{folder}/{number:012d}.first", json.dumps({"first": first})):
            continue
        # Only numbers below the highest are ever cleared, so a ticket that was once cleared and is
        # published again by a late append shows here: there is a higher one.
        if max(_tickets(spark, opts)) > number:
            continue
        for old, kinds in tickets.items():
            if old < last:
                for kind in kinds:
                    paths.delete(spark, f"{folder}/{old:012d}.{kind}")
        return number, first


def _range_after(spark, schema: CollectionSchema, opts: CollectionOptions, number: int, kinds: set[str] | None) -> int:
    if kinds is None:  # no append yet: rows that came another way count
        rows = spark.read.schema(schema.struct).parquet(opts.data_path)
        highest = rows.agg(F.max(quoted_name(schema.auto_id_field.name))).first()[0]
        return 0 if highest is None else highest + 1
    if "settled" in kinds:
        return json.loads(paths.read_text(spark, f"{_folder(opts)}/{number:012d}.settled"))["next"]
    return json.loads(paths.read_text(spark, f"{_folder(opts)}/{number:012d}.first"))["first"] + SPAN
