"""Corpus-wide line deduplication over levelled sorted runs of line keys.

A run is a table of line-key hashes and the number of documents that hold them, bucketed
and sorted by the hash, one file a bucket, in the shared folder. Every batch of documents
gives one new run: its counted keys, merge-anti-joined with those that a run already shows
to be in enough documents. When a level holds ``fan_in`` runs they are merge-joined into one
run of the next level, so a key is rewritten once per level. A run is neither shuffled nor
sorted where it is read; sorted are the new batch and, within its buckets, what is written.

Documents lose their lines by a join on the key. The keys that are in so many documents that
they would fill a task are fewer than tasks times batches, by arithmetic, and are broadcast.

The main path has DataFrame functions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm.scratch import kept
from vectable.sources.paths import delete
from vectable.workspace import fresh_folder

BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The text split at every newline; null and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), CAPITALS, CAPITALS.lower())


def hash_of(key: Column) -> Column:
    return F.xxhash64(key)


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Within, Spark trusts the order of bucketed tables of one file a bucket."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class LineRuns:
    """The levelled runs: ``add`` takes a batch of ``(h1, h2)`` rows, one per document and key."""

    def __init__(self, spark: SparkSession, enough: int, fan_in: int = 2) -> None:
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.spark = spark
        self.enough = enough
        self.fan_in = fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[DataFrame, str]]] = []

    def _write(self, counted: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_folder(self.spark)
        writer = counted.write.format("parquet").option("path", path)
        with ordered_scans(self.spark):
            writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and `run` knows them
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((run, path))

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run, _ in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's keys with their numbers of rows, without those that a run has often enough."""
        counted = batch.groupBy(*KEY).agg(F.count("*").alias("n"))
        for run in self.runs():
            counted = counted.join(run.where(F.col("n") >= self.enough).hint("merge"), KEY, "left_anti")
        return counted

    def add(self, batch: DataFrame) -> None:
        self._write(self.unseen(batch), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan_in:
            merged = self.levels[level]
            self._write(merge_runs([run for run, _ in merged]), level + 1)
            self.levels[level] = []
            for _, path in merged:
                delete(self.spark, path)
            level += 1

    def repeated(self) -> DataFrame:
        """The keys found in at least ``enough`` documents of all batches, and ``n``: in how many until then.

        They are written, and the runs deleted.
        """
        with ordered_scans(self.spark):
            found = kept(merge_runs(self.runs()).where(F.col("n") >= self.enough))
        for level in self.levels:
            for _, path in level:
                delete(self.spark, path)
        self.levels = []
        return found


def merge_runs(runs: list[DataFrame]) -> DataFrame:
    """The keys of all runs with the sums of their ``n``; two runs at a time are merged."""
    merged = runs[0]
    for run in runs[1:]:
        more = run.withColumnRenamed("n", "more").hint("merge")
        n = F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))
        merged = merged.join(more, KEY, "full").select(*KEY, n.alias("n"))
    return merged


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    fan_in: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with every line dropped whose key is found in at least ``min_docs`` documents.

    Keys of fewer than ``min_chars`` code points never count. The other lines stay in place,
    joined by newlines. Added are ``n_lines`` (before dropping) and ``n_dropped``; a column of
    that name is replaced. A null text becomes the empty text, which is one empty line; a
    document that loses all its lines becomes the empty text. Every row is a document, also one
    whose id is null or repeats. A key repeated in one document counts once. An empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    text = F.col(text_column)
    keys = F.filter(
        F.array_distinct(F.transform(lines_of(text), key_of)), lambda key: F.char_length(key) >= min_chars
    )
    held = docs.select(F.col(id_column).alias("doc"), F.explode(keys).alias("key"))
    digest = kept(
        held.select(
            "doc",
            hash_of(F.col("key")).alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
            F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int").alias("batch"),
        )
    )
    runs = LineRuns(spark, min_docs, fan_in)
    for number in range(batches):
        runs.add(digest.where(F.col("batch") == number).select(*KEY))
    repeated = runs.repeated()
    # Of all rows of `digest`, fewer than `most` keys can have more than this share each.
    most = runs.buckets * batches
    crowded = F.col("n") > digest.count() // most
    hot = F.broadcast(repeated.where(crowded).select(*KEY))
    rest = repeated.where(~crowded).select(*KEY)
    found = digest.join(hot, KEY, "left_semi").unionByName(
        digest.join(hot, KEY, "left_anti").join(rest, KEY, "left_semi")
    )
    hits = found.groupBy("doc").agg(F.collect_set("h1").alias("hits"))

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = row.join(hits, F.col(f"row.`{id_column}`").eqNullSafe(F.col("doc")), "left")
    lines = lines_of(F.col(f"row.`{text_column}`"))
    clean = F.when(F.col("hits").isNull(), lines).otherwise(
        F.filter(
            lines,
            lambda line: (F.char_length(key_of(line)) < min_chars)
            | ~F.array_contains(F.col("hits"), hash_of(key_of(line))),
        )
    )
    split = joined.select("row", F.size(lines).cast("long").alias("before"), clean.alias("clean"))
    new = {
        text_column: F.array_join("clean", "\n"),
        n_lines: F.col("before"),
        n_dropped: F.col("before") - F.size("clean"),
    }
    out = [new.pop(c).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return split.select(*out, *[value.alias(name) for name, value in new.items()])
