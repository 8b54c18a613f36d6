"""Near-duplicate vectors by cosine: an epsilon grid order join.

Cosine of at least ``c`` is a distance of at most ``sqrt(2 - 2c)`` (epsilon) between unit vectors,
and no projection makes distances larger. Distinct vectors are projected on their leading
principal directions, put into grid cells of side epsilon, and sorted by cell, dimension after
dimension: the epsilon grid order. The sorted sequence is cut into blocks; pairs of blocks whose
boxes are farther apart than epsilon are never opened, and a pair that is opened is joined by
halving its two intervals, skipping the provably distant halves. What is left is compared in
single precision, and in double precision where the error of that could matter.

Vectors are shuffled once, to be sorted. Pairs of blocks are opened by the tasks that read them: a
Cartesian product of the blocks' files with the boxes as its condition, so no block is written or shuffled
again for each block that it meets. Vectors stay as wide as the table has them.

Equal vectors are one node, and a task returns counts of links and a spanning forest of them, so
a dense group costs comparisons but never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.components import components
from vectable.llm.rolling import mix
from vectable.llm.scratch import forget, kept

DIRECTIONS = 6  # leading principal directions of the grid
BLOCK = 2048  # vectors of a block
BLOCK_BYTES = 1 << 20  # and their size, or one vector's
LEAF = 256  # vectors of an interval that is compared without halving
STEPS = 1 << 24  # a unit: components are rounded to its parts for the grid, so sums don't depend on their order
LINKS = "node long, links long, other long"


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column by length: their places and one matrix, null components as NaN."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == dim)
        yield places, flat[starts[places][:, None] + np.arange(dim)]


def _node_names(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's components."""
    spots = np.arange(1, rows.shape[1] + 1, dtype=np.uint64)
    return mix(mix(rows.view(np.uint64) + mix(spots)).sum(1, dtype=np.uint64)).view(np.int64)


def _nodes(kind: type):
    """``(vec_id, node, dim, vector)``; node, dim and vector are null where nothing can link.

    Linked are vectors that aren't null or zero and whose components are all there and finite.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, dims = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32)
            packed = np.full(batch.num_rows, None, object)
            for places, rows in _matrices(batch.column(1)):
                sound = np.isfinite(rows).all(1) & rows.any(1)
                places, rows = places[sound], rows[sound] + 0.0  # -0 is 0
                nodes[places], dims[places] = _node_names(rows), rows.shape[1]
                rows = rows.astype(kind)
                packed[places] = rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel().tolist()
            none = dims == 0
            columns = [pa.array(nodes, mask=none), pa.array(dims, mask=none), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["vec_id", "node", "dim", "vector"])

    return run


def _bytes(column: pa.Array) -> np.ndarray:
    """Packed vectors of one length, a row each."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)


def _unit(packed: np.ndarray, kind: type) -> np.ndarray:
    """Packed vectors as a matrix of unit rows."""
    rows = packed.view(kind).astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def principal_directions(vectors: DataFrame, dim: int, kind: type) -> np.ndarray:
    """The leading directions of all unit vectors, ``dim`` by at most ``DIRECTIONS``."""

    def moments(batches):
        total = np.zeros((dim + 1, dim))
        for batch in batches:
            unit = _unit(_bytes(batch.column(0)), kind)
            total[:-1] += unit.T @ unit
            total[-1] += unit.sum(0)
        numbers = pa.array(np.arange(total.size), pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, pa.array(total.ravel())], ["spot", "total"])

    sums = vectors.select("vector").mapInArrow(moments, "spot int, total double")
    rows = sums.groupBy("spot").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros((dim + 1) * dim)
    total[rows.column("spot").to_numpy()] = rows.column("total").to_numpy()
    total = total.reshape(dim + 1, dim)
    n = max(np.trace(total[:-1]), 1.0)  # unit vectors: the trace is their number
    mean = total[-1] / n
    _, directions = np.linalg.eigh(total[:-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(directions[:, ::-1][:, : min(DIRECTIONS, dim)])


def _gap(low_a, high_a, low_b, high_b) -> float:
    """The squared distance of two boxes."""
    apart = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0)
    return float((apart**2).sum())


class _Side:
    """Unit rows of a block in double and in single precision, and the boxes of its intervals."""

    def __init__(self, unit: np.ndarray, spots: np.ndarray) -> None:
        self.unit, self.spots = unit, spots
        self.single = unit.astype(np.float32)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        if (low, high) not in self.boxes:
            part = self.spots[low:high]
            self.boxes[low, high] = part.min(0), part.max(0)
        return self.boxes[low, high]


def _join(a: _Side, b: _Side, cosine: float, reach: float, same: bool):
    """Index pairs of linked rows. Projections decide which intervals are opened."""
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    margin = (a.unit.shape[1] + 8) * 2.0**-23  # more than single precision errs
    todo = [(0, len(a.unit), 0, len(b.unit))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if _gap(*a.box(a0, a1), *b.box(b0, b1)) > reach:
            continue
        if max(a1 - a0, b1 - b0) <= LEAF:
            products = a.single[a0:a1] @ b.single[b0:b1].T
            if products.max() < cosine - margin:
                continue
            i, j = np.nonzero(products >= cosine - margin)
            linked = products[i, j] >= cosine + margin
            i, j = i + a0, j + b0
            unsure = np.flatnonzero(~linked)
            linked[unsure] = (a.unit[i[unsure]] * b.unit[j[unsure]]).sum(1) >= cosine
            if same:
                linked &= i != j
            left.append(i[linked])
            right.append(j[linked])
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            todo += [(a0, middle, b0, b1), (middle, a1, b0, b1)]
        else:
            middle = (b0 + b1) // 2
            todo += [(a0, a1, b0, middle), (a0, a1, middle, b1)]
    return np.concatenate(left), np.concatenate(right)


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For every one of ``n`` points the smallest point that links reach."""
    label = np.arange(n)
    while True:
        lowest = label.copy()
        np.minimum.at(lowest, left, label[right])
        np.minimum.at(lowest, right, label[left])
        lowest = lowest[lowest]
        if (lowest == label).all():
            return label
        label = lowest


def _blocks(directions, kind: type):
    """Sorted rows to blocks with their boxes; a block never spans two tasks. Rows of a node become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # nodes, copies, vectors
        size = 0

        def out(node: np.ndarray, copies: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
            spots = _unit(packed, kind) @ directions.value
            columns = {
                "block": pa.array([int(mix(node.view(np.uint64)).sum(dtype=np.uint64).view(np.int64))]),
                "low": pa.array([spots.min(0).tolist()]),
                "high": pa.array([spots.max(0).tolist()]),
                "nodes": pa.array([node.tobytes()], pa.binary()),
                "copies": pa.array([copies.tobytes()], pa.binary()),
                "vectors": pa.array([packed.tobytes()], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            if not batch.num_rows:
                continue
            node, copies = (batch.column(k).to_numpy() for k in (0, 1))
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            copies, packed = np.add.reduceat(copies, first), _bytes(batch.column(2))[first]
            node = node[first]
            if held and held[-1][0][-1] == node[0]:
                held[-1][1][-1] += copies[0]
                node, copies, packed = node[1:], copies[1:], packed[1:]
            if not len(node):
                continue
            held.append((node, copies, packed))
            size += len(node)
            most = max(1, min(BLOCK, BLOCK_BYTES // packed.shape[1]))
            if size > most:  # the last node may have more rows
                whole = [np.concatenate(x) for x in zip(*held)]
                low = 0
                while size - low > most:
                    yield out(*(x[low : low + most] for x in whole))
                    low += most
                held, size = [tuple(x[low:].copy() for x in whole)], size - low
        if size:
            yield out(*(np.concatenate(x) for x in zip(*held)))

    return run


def _open(directions, kind: type, cosine: float, reach: float):
    """Pairs of blocks, a row each, to counts of links and forests."""

    def side(row: dict, which: str) -> tuple[_Side, np.ndarray, np.ndarray]:
        nodes, copies = (np.frombuffer(row[f"{which}_{c}"], np.int64) for c in ("nodes", "copies"))
        unit = _unit(np.frombuffer(row[f"{which}_vectors"], np.uint8).reshape(len(nodes), -1), kind)
        return _Side(unit, unit @ directions.value), nodes, copies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if row["x_block"] != last:
                    last, first = row["x_block"], side(row, "x")
                same = row["y_block"] == last
                a, names, copies = first
                b, other_names, other_copies = first if same else side(row, "y")
                left, right = _join(a, b, cosine, reach, same)
                if not len(left):
                    continue
                n = len(names)
                links = np.bincount(left, weights=other_copies[right], minlength=n)
                if not same:
                    links = np.append(links, np.bincount(right, weights=copies[left], minlength=len(other_names)))
                    names = np.append(names, other_names)
                    right = right + n
                label = _forest(left, right, len(names))
                linked = np.flatnonzero(links)
                columns = [names[linked], links[linked].astype(np.int64), names[label[linked]]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["node", "links", "other"])

    return run


def _near(width: int, reach: float):
    """Whether the boxes of blocks ``x`` and ``y`` are within reach; each pair once."""
    gaps = [
        F.pow(
            F.greatest(
                F.col("x_low")[i] - F.col("y_high")[i], F.col("y_low")[i] - F.col("x_high")[i], F.lit(0.0)
            ),
            2,
        )
        for i in range(width)
    ]
    return (F.col("x_block") <= F.col("y_block")) & (sum(gaps[1:], gaps[0]) <= reach)


def _linked(rows: DataFrame, dim: int, kind: type, cosine: float) -> DataFrame:
    """``(node, links, other)`` of distinct vectors of length ``dim``: counts of links and a forest of them."""
    spark = rows.sparkSession
    reach = (2 - 2 * cosine) * (1 + 1e-9) + 1e-12
    directions = spark.sparkContext.broadcast(principal_directions(rows, dim, kind))
    width = directions.value.shape[1]
    grid = [f"c{i}" for i in range(width)]

    def cells_of(batches):
        whole = np.rint(directions.value * STEPS)
        cell = float(np.sqrt(reach)) * STEPS * STEPS
        for batch in batches:
            node, first, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
            vectors = batch.column(1).take(pa.array(first))
            spots = np.rint(_unit(_bytes(vectors), kind) * STEPS) @ whole  # whole numbers, so equal rows meet
            cells = [pa.array(c) for c in np.floor(spots / cell).astype(np.int32).T]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(copies), vectors, *cells], ["node", "copies", "vector", *grid])

    schema = "node long, copies long, vector binary, " + ", ".join(f"{c} int" for c in grid)
    placed = rows.select("node", "vector").mapInArrow(cells_of, schema)
    order = [*grid, "node"]  # the node splits a cell that holds very many
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ordered = ordered.select("node", "copies", "vector")
    blocks = kept(
        ordered.mapInArrow(
            _blocks(directions, kind),
            "block long, low array<double>, high array<double>, nodes binary, copies binary, vectors binary",
        )
    )
    x, y = (blocks.select([F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in ("x", "y"))
    pairs = x.join(y, _near(width, reach))
    content = [f"{side}_{c}" for side in ("x", "y") for c in ("block", "nodes", "copies", "vectors")]
    found = kept(pairs.select(*content).mapInArrow(_open(directions, kind, cosine, reach), LINKS))
    forget(blocks)
    return found


def similar_vectors(
    vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors link when their cosine in double precision is at least ``cosine`` (more than 0).
    ``n_links`` counts the other rows linked directly, equal vectors included; ``component_id`` is the
    smallest id reachable over links, the row's own included; ``kept`` is whether that is its own.
    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing; others
    link with those of their length. Each length is joined along its own directions.
    Repeated ids are rows of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    types = dict(vectors.dtypes)
    kind = np.float32 if types[vector_column] == "array<float>" else np.float64
    given = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    whole = kept(given.mapInArrow(_nodes(kind), f"vec_id {types[id_column]}, node long, dim int, vector binary"))
    rows = kept(whole.select("vec_id", "node"))
    found = kept(spark.createDataFrame([], LINKS))
    sound = whole.where("dim IS NOT NULL")
    for r in sound.select("dim").distinct().orderBy("dim").collect():  # lengths are few
        found = found.unionByName(_linked(sound.where(F.col("dim") == r["dim"]), r["dim"], kind, cosine))
    forget(whole)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select("node", "other"), "node", "other")
    copies = rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"))
    joined = (
        rows.join(copies, "node", "left")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("smallest"))
    result = joined.join(smallest, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    return result.select(
        "vec_id",
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
