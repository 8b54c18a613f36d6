"""Exact top-k search by the metric a vector field declares.

Queries are written once to the shared folder, in blocks of bounded size, and each block is
searched on its own. The collection is scanned once for it and never shuffled: the block is
shipped to every task, which scores its rows in numpy and keeps the best ``k`` per query as it
goes. The final ranking has two steps, first among the tasks of one bucket and then among the
buckets, so no task ranks what all tasks kept. Scored pairs never become rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.half import from_bf16_bits
from vectable.plans.errors import SchemaError
from vectable.plans.schema import CollectionSchema
from vectable.plans.sqltext import quoted_name
from vectable.workspace import pinned

# What one block of queries may hold, as Arrow bytes, on the driver and in each task.
BLOCK_BYTES = 64 << 20
# Queries scored together, scores held at once, and sparse matches held at once in a task.
QUERY_BLOCK = 2048
SCORE_CELLS = 1 << 22
SPARSE_MATCHES = 1 << 22
# Buckets of tasks whose rows are ranked together first.
RANK_BUCKETS = 256
# Scores are compared at this many decimals, so equal vectors tie whatever order a
# block product adds them in; ties go to the smaller id.
SCORE_DECIMALS = 12
# The place of rows whose vector has a non-finite element: after all others, without a score.
LAST = 1e200

# From a block of queries to a function that scores a block of rows against it; ``bars`` are what a
# score must not exceed to matter, by query, and infinite scores need not be right beyond them.
Score = Callable[[pa.Array, np.ndarray], np.ndarray]
Scorer = Callable[[pa.Array], Score]

# The metric each vector type is searched by.
SEARCHES = {
    ("FloatVector", "COSINE"),
    ("Float16Vector", "COSINE"),
    ("BFloat16Vector", "COSINE"),
    ("BinaryVector", "HAMMING"),
    ("SparseFloatVector", "IP"),
}


def top_k(
    collection: DataFrame,
    schema: CollectionSchema,
    vector: str,
    queries: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` nearest rows for every row of ``queries``, by the field's metric.

    Returns ``query_id, rank, id, score`` where ``id`` is the primary key. COSINE and
    IP rank the largest score first, HAMMING the smallest. Rows without a vector are
    never returned; a sparse row must share a dimension with the query; a zero vector
    has cosine 0. A row whose vector has a NaN or infinite element ranks after all
    others and has a null score. ``queries`` hold vectors stored the same way as the
    field. Query ids that are null or repeat, and query vectors that are null, have a
    non-finite element or exceed ``block_bytes`` (with their id), are errors.

    ``queries`` are evaluated once. The blocks are ranked one after the other and their results kept in
    the shared folder, so the driver holds one block, of twice ``block_bytes`` at most.
    """
    spec = schema[vector]
    if (spec.type, spec.metric) not in SEARCHES:
        raise SchemaError(f"field {vector} of type {spec.type} is not searched by {spec.metric}")
    if k < 1:
        raise ValueError(f"k must be positive: {k}")
    key = next((f for f in schema.fields if f.primary_key), None)
    if key is None:
        raise SchemaError("a search needs a primary key")
    columns = [F.col(quoted_name(key.name)).alias("id"), F.col(quoted_name(vector)).alias("vector")]
    rows = collection.select(*columns).where(F.col("vector").isNotNull())
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector"))
    search = _Search(spec.type, k)
    results = []
    for block in _blocks(asked, block_bytes):
        shared = rows.sparkSession.sparkContext.broadcast(block.toArrow().combine_chunks())
        results.append(pinned(ranked(rows, shared, search, asked, spec.metric)))
        shared.unpersist()
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionByName(result)
    return whole


def _blocks(asked: DataFrame, block_bytes: int) -> Iterator[DataFrame]:
    """The queries, checked and written once, in blocks of twice ``block_bytes`` at most; none gives one empty block.

    Hashes of ids deal them into buckets of about ``block_bytes``, and a running sum of bytes cuts
    what lies in one bucket beyond that.
    """
    kind = asked.schema["vector"].dataType
    per_element = 12 if isinstance(kind, T.MapType) else _width(kind.elementType)
    id_bytes = F.octet_length("query_id") if isinstance(asked.schema["query_id"].dataType, T.StringType) else F.lit(8)
    size = F.coalesce(F.size("vector"), F.lit(0)).cast("long") * per_element + F.coalesce(id_bytes, F.lit(0))
    held = pinned(asked.withColumn("bytes", size))
    buckets = max(1, math.ceil(_checked_bytes(held, block_bytes) / block_bytes))
    if buckets == 1:
        yield held.drop("bytes")
        return
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(buckets))
    before = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("query_id")) - F.col("bytes")
    cut = held.withColumn("bucket", bucket).withColumn("part", F.floor(before / block_bytes))
    placed = pinned(cut.drop("bytes"), partition_by=("bucket", "part"))
    numbers = placed.select("bucket", "part").distinct().orderBy("bucket", "part").collect()  # a row a block
    for number in numbers:
        own = placed.where((F.col("bucket") == number["bucket"]) & (F.col("part") == number["part"]))
        yield own.select("query_id", "vector")


def _checked_bytes(held: DataFrame, block_bytes: int) -> int:
    found = held.agg(
        F.sum("bytes").alias("bytes"),
        F.max("bytes").alias("largest"),
        F.sum(F.when(F.col("query_id").isNull() | F.col("vector").isNull(), 1).otherwise(0)).alias("nulls"),
        F.sum(_endless(held.schema["vector"].dataType)).alias("endless"),
        (F.count("query_id") - F.count_distinct("query_id")).alias("repeats"),
    ).first()
    if found["nulls"]:
        raise ValueError(f"{found['nulls']} queries have a null id or vector")
    if found["endless"]:
        raise ValueError(f"{found['endless']} query vectors have a NaN or infinite element")
    if (found["largest"] or 0) > block_bytes:
        raise ValueError(f"a query of {found['largest']} bytes exceeds {block_bytes}")
    if found["repeats"]:
        raise ValueError(f"query ids repeat {found['repeats']} times")
    return found["bytes"] or 0


def _width(element: T.DataType) -> int:
    return {T.ByteType: 1, T.FloatType: 4}.get(type(element), 8)


def _endless(kind: T.DataType) -> Column:
    """1 where a vector of numbers has a NaN or infinite element; NaN sorts above infinity."""
    values = F.map_values("vector") if isinstance(kind, T.MapType) else F.col("vector")
    number = kind.valueType if isinstance(kind, T.MapType) else kind.elementType
    if not isinstance(number, (T.FloatType, T.DoubleType)):
        return F.lit(0)
    bad = (F.array_max(values) >= float("inf")) | (F.array_min(values) == float("-inf"))
    return F.when(bad, 1).otherwise(0)


def ranked(rows: DataFrame, shared, search: _Search, asked: DataFrame, metric: str) -> DataFrame:
    """The plan for one block of queries: ``rows`` scored against the broadcast ``shared``, and the best of them."""
    out = T.StructType(
        [
            asked.schema["query_id"],
            rows.schema["id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("bucket", T.IntegerType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _only_batch(shared.value)
        if asked is not None:
            yield from search.run(asked, batches)

    return _best(rows.mapInArrow(scan, out), metric, search.k)


def _best(candidates: DataFrame, metric: str, k: int) -> DataFrame:
    """The best ``k`` per query, first of every bucket of tasks and then of all."""
    best = F.col("score").asc_nulls_last() if metric == "HAMMING" else F.col("score").desc_nulls_last()
    for keys in (["query_id", "bucket"], ["query_id"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(best, "id"))
        candidates = candidates.withColumn("rank", place).where(F.col("rank") <= k)
    return candidates.select("query_id", "rank", "id", "score")


def _only_batch(table: pa.Table) -> pa.RecordBatch | None:
    batches = [b for b in table.to_batches() if b.num_rows]
    if len(batches) > 1:
        return pa.concat_batches(batches)
    return batches[0] if batches else None


@dataclass(frozen=True)
class _Search:
    """Scores Arrow batches of ``id, vector`` against queries, ``QUERY_BLOCK`` at a time.

    Scorers return a (queries x rows) block in which smaller is better and infinite
    is out of reach.
    """

    kind: str
    k: int

    def run(self, queries: pa.RecordBatch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best ``k`` rows per query over all ``batches``, as ``query_id, id, score, bucket``."""
        parts = [queries.slice(i, QUERY_BLOCK) for i in range(0, queries.num_rows, QUERY_BLOCK)]
        states = [(_SCORERS[self.kind](p.column("vector")), _Kept(self.k, p.num_rows), p) for p in parts]
        step = max(1, SCORE_CELLS // min(queries.num_rows, QUERY_BLOCK))
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                for score, kept, _ in states:
                    kept.add(score(rows.column("vector"), kept.bars), rows.column("id"))
        context = TaskContext.get()
        bucket = context.partitionId() % RANK_BUCKETS if context else 0
        for _, kept, part in states:
            if kept.numbers is None or not len(kept.numbers):
                continue
            scores = kept.order if self.kind == "BinaryVector" else -kept.order
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("query_id").take(pa.array(kept.numbers)),
                    pa.array(kept.ids.tolist(), id_type),
                    pa.array(scores, mask=kept.order >= LAST),
                    pa.array(np.full(len(scores), bucket, np.int32)),
                ],
                names=["query_id", "id", "score", "bucket"],
            )


class _Kept:
    """The best ``k`` rows of each query so far, ties included by id."""

    def __init__(self, k: int, queries: int) -> None:
        self.k = k
        # The k-th best score of each query; nothing worse can enter any more.
        self.bars = np.full(queries, np.inf)
        self.numbers: np.ndarray | None = None
        self.order: np.ndarray | None = None
        self.ids: np.ndarray | None = None

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        unset = np.flatnonzero(np.isinf(self.bars))
        if len(unset) and scores.shape[1] > self.k:
            self.bars[unset] = np.partition(scores[unset], self.k - 1, axis=1)[:, self.k - 1]
        # The margin lets scores in that only differ from the bar by rounding.
        most = np.finfo(scores.dtype).max
        limits = np.where(np.isinf(self.bars), most, self.bars + 2 * 10.0**-SCORE_DECIMALS)
        numbers, rows = np.nonzero(scores <= limits.astype(scores.dtype)[:, None])
        found = numbers, np.round(scores[numbers, rows].astype(np.float64), SCORE_DECIMALS), _ids(ids, rows)
        if self.numbers is not None:
            kept = self.numbers, self.order, self.ids
            found = tuple(np.concatenate(pair) for pair in zip(kept, found))
        self._rank(*found)

    def _rank(self, numbers: np.ndarray, order: np.ndarray, ids: np.ndarray) -> None:
        # Text is ranked among the candidates only; code points sort as UTF-8 does.
        codes = np.unique(ids, return_inverse=True)[1] if ids.dtype == object else ids
        by = np.lexsort((codes, order, numbers))
        sizes = np.bincount(numbers, minlength=len(self.bars))
        place = np.arange(len(by)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        last = by[place == self.k - 1]
        self.bars = np.full(len(self.bars), np.inf)
        self.bars[numbers[last]] = order[last]
        chosen = by[place < self.k]
        self.numbers, self.order, self.ids = numbers[chosen], order[chosen], ids[chosen]


def _ids(ids: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The keys of the given rows; texts as they are, not as fixed-width ones."""
    if pa.types.is_integer(ids.type):
        return ids.to_numpy(zero_copy_only=False)[rows]
    distinct, inverse = np.unique(rows, return_inverse=True)
    texts = np.empty(len(distinct), object)
    texts[:] = ids.take(pa.array(distinct)).to_pylist()
    return texts[inverse]


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list column of equal lengths as one (rows x length) array."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _cosines(read: Callable[[np.ndarray], np.ndarray]) -> Scorer:
    """Negated cosines of vectors that ``read`` turns into numbers."""

    def units(vectors: pa.Array) -> np.ndarray:
        dense = read(_matrix(vectors)).astype(np.float64)
        finite = np.isfinite(dense).all(axis=1)
        dense[~finite] = 0
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        return np.divide(dense, norms, out=np.zeros_like(dense), where=norms > 0), finite

    def against(queries: pa.Array) -> Score:
        asked, sound = units(queries)
        if not sound.all():
            raise ValueError("a query vector has a NaN or infinite element")

        def score(vectors: pa.Array, bars: np.ndarray) -> np.ndarray:
            stored, finite = units(vectors)
            return np.where(finite, -asked @ stored.T, LAST)

        return score

    return against


def _hamming_distances(queries: pa.Array) -> Score:
    """Differing bits, counted on words of 64; whole numbers, exact in float32."""

    def words(vectors: pa.Array) -> np.ndarray:
        stored = _matrix(vectors).view(np.uint8)
        padded = np.zeros((len(stored), -(-stored.shape[1] // 8) * 8), np.uint8)
        padded[:, : stored.shape[1]] = stored
        return np.ascontiguousarray(padded.view(np.uint64).T)

    asked = words(queries)

    def score(vectors: pa.Array, bars: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(queries), len(vectors)), np.float32)
        for own, stored in zip(asked, words(vectors), strict=True):
            counts += np.bitwise_count(own[:, None] ^ stored)
        return counts

    return score


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, dimension and weight of every entry of a map column."""
    offsets = vectors.offsets.to_numpy(zero_copy_only=False)
    inside = slice(offsets[0], offsets[-1])
    dims = vectors.keys.to_numpy(zero_copy_only=False)[inside]
    weights = vectors.items.to_numpy(zero_copy_only=False)[inside].astype(np.float64)
    return np.repeat(np.arange(len(vectors)), np.diff(offsets)), dims, weights


def _sparse_products(queries: pa.Array) -> Score:
    """Negated inner products; rows sharing no dimension with a query are out of reach.

    The largest query weight of a dimension, over what its query's bar asks for, bounds how far a row's
    weight there can bring it to any bar. Rows that don't reach one by the sum of that are skipped.
    """
    numbers, dims, weights = _entries(queries)
    by_dim = np.argsort(dims, kind="stable")
    numbers, dims, weights = numbers[by_dim], dims[by_dim], weights[by_dim]
    known, first_of = np.unique(dims, return_index=True)

    def steepest(bars: np.ndarray) -> np.ndarray | None:
        """Per dimension the most that a weight of 1 counts towards a bar, as a share of it."""
        needed = -bars - 2 * 10.0**-SCORE_DECIMALS
        if not len(dims) or not (needed > 0).any():
            return None
        share = np.where(needed[numbers] > 0, np.abs(weights) / np.maximum(needed[numbers], 1e-300), np.inf)
        return np.maximum.reduceat(share, first_of)

    def score(vectors: pa.Array, bars: np.ndarray) -> np.ndarray:
        rows, row_dims, row_weights = _entries(vectors)
        finite = np.ones(len(vectors), bool)
        finite[rows[~np.isfinite(row_weights)]] = False
        row_weights = np.where(np.isfinite(row_weights), row_weights, 0)
        slopes = steepest(bars)
        if slopes is not None:
            at = np.minimum(np.searchsorted(known, row_dims), len(known) - 1)
            share = np.where((known[at] == row_dims) & (row_weights != 0), slopes[at], 0) * np.abs(row_weights)
            # Rounding of the sum is far below this margin.
            reach = np.bincount(rows, share, len(vectors)) >= 1 - 1e-9
            score.skipped += int(len(vectors) - reach.sum())
            rows, row_dims, row_weights = rows[reach[rows]], row_dims[reach[rows]], row_weights[reach[rows]]
        first = np.searchsorted(dims, row_dims, "left")
        shared = np.searchsorted(dims, row_dims, "right") - first
        ends = np.cumsum(shared)
        cells = len(queries) * len(vectors)
        products, touched = np.zeros(cells), np.zeros(cells, bool)
        # One line per row entry and query entry of the same dimension, so many at once.
        for start in range(0, int(ends[-1]) if len(ends) else 0, SPARSE_MATCHES):
            line = np.arange(start, min(start + SPARSE_MATCHES, int(ends[-1])))
            entry = np.searchsorted(ends, line, "right")
            match = first[entry] + line - (ends[entry] - shared[entry])
            cell = numbers[match] * len(vectors) + rows[entry]
            products += np.bincount(cell, row_weights[entry] * weights[match], cells)
            touched |= np.bincount(cell, minlength=cells) > 0
        block = np.where(touched, -products, np.inf).reshape(len(queries), len(vectors))
        return np.where(finite | np.isinf(block), block, LAST)

    score.skipped = 0
    return score


_SCORERS: dict[str, Scorer] = {
    "FloatVector": _cosines(lambda stored: stored),
    "Float16Vector": _cosines(lambda stored: stored.view("<f2")),
    "BFloat16Vector": _cosines(lambda stored: from_bf16_bits(stored.view("<u2"))),
    "BinaryVector": _hamming_distances,
    "SparseFloatVector": _sparse_products,
}
