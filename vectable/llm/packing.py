"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Lengths are whole numbers up to the capacity, so best-fit decreasing needs only how many
pieces have each length: that histogram (at most ``capacity`` rows) goes to the driver,
where a segment tree over remaining capacities finds the tightest open sequence in
logarithmic time. Sequences that are equally full are handled as ranges, and a run of
equal pieces fills a whole range at once, so the plan takes a number of steps bounded by
the capacity alone and equals the plan of packing all pieces one by one. Spark numbers the
pieces of each length, and a piece's length and number give its place in the plan.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectable.llm.rolling import Texts, slices
from vectable.llm.scratch import kept
from vectable.llm.worker import give_back, kept_by_worker

CACHED_UNITS = 1_000_000
ENCODED_AT_ONCE = 4096  # units; the tokenizer's answers take a kilobyte each until they are plain ids


class CapacityTree:
    """A segment tree over remaining capacities 0..``top``, marking those that some open sequence has."""

    def __init__(self, top: int) -> None:
        self.leaves = 1 << top.bit_length()
        self.any = bytearray(2 * self.leaves)

    def mark(self, capacity: int, present: bool) -> None:
        node = self.leaves + capacity
        self.any[node] = present
        while node > 1:
            node >>= 1
            self.any[node] = self.any[2 * node] | self.any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest marked capacity of at least ``length``."""
        node = self.leaves + length
        while not self.any[node]:
            while node & 1:  # no right sibling: go up
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs ``(length, first number, pieces per sequence, first sequence, offset)``, by length and number.

    Piece ``k`` of a length lies in the last run with first number <= k, in sequence
    ``first sequence + (k - first number) // per`` at ``offset + (k - first number) % per * length``.
    """
    tree = CapacityTree(capacity)
    open_ranges: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_ranges.setdefault(room, []).append((first, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        placed, total = 0, counts[length]
        while placed < total:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, n = sequences, -(-(total - placed) // (room // length))
                sequences += n
            else:
                first, n = open_ranges[room].pop()
                if not open_ranges[room]:
                    tree.mark(room, False)
            per = room // length
            full = min(n, (total - placed) // per)
            if full:
                runs.append((length, placed, per, first, capacity - room))
                put(room - per * length, first, full)
                placed += full * per
            if full < n:
                rest = total - placed  # fewer than fill the next sequence
                if rest:
                    runs.append((length, placed, rest, first + full, capacity - room))
                    put(room - rest * length, first + full, 1)
                    placed += rest
                    full += 1
                put(room, first + full, n - full)
    plan = np.array(runs, np.int64).reshape(-1, 5)
    return plan[np.lexsort((plan[:, 1], plan[:, 0]))]


class UnitEncoder:
    """Token ids of texts by way of their distinct units, each encoded once.

    The tokenizer drops blanks and never joins over them, nor between an ASCII letter and ASCII
    punctuation other than the apostrophe, so the ids of a text are those of its units in a row.
    Texts that may hold a special token are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would keep memory of their own
        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        if len(self.hashes) + len(hashes) > CACHED_UNITS and len(self.hashes):
            self._clear()
        flat, lengths = [], []
        for first in range(0, len(units), ENCODED_AT_ONCE):
            some = units[first : first + ENCODED_AT_ONCE]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, encoded), np.int64, len(encoded)))
            flat.append(np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths[-1].sum())))
        lengths = np.concatenate(lengths)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.starts = np.insert(self.starts, at, starts)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.ids = np.concatenate([self.ids, *flat])

    def encode(self, texts: Texts) -> list[np.ndarray]:
        lower = texts.lower_ascii()
        data = lower.data
        letter = (data - np.uint8(97)) < 26
        mark = (data > 32) & (data < 127) & ~letter & (data != 39) & ~((data - np.uint8(48)) < 10)
        apart = np.zeros(len(data), bool)
        apart[1:] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
        words = lower.words(apart)
        distinct, sample, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(distinct))
        if len(new):
            if len(self.hashes) + len(new) > CACHED_UNITS:
                new = np.arange(len(distinct))
                self._clear()
            raw = data.tobytes()
            spans = zip(words.starts[sample[new]].tolist(), words.ends[sample[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
        at = np.searchsorted(self.hashes, distinct)
        lengths, starts = self.lengths[at][inverse], self.starts[at][inverse]
        ends = np.cumsum(lengths)
        flat = self.ids[np.arange(int(lengths.sum())) - np.repeat(ends - lengths - starts, lengths)]
        bounds = np.concatenate([[0], ends])[words.bounds].tolist()
        ids = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
        for i in np.unique(np.searchsorted(texts.offsets, special, side="right") - 1).tolist():
            text = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode("utf-8", "replace")
            ids[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return ids

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder for this file."""
    return kept_by_worker(("encoder", path), lambda: UnitEncoder(path))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    end_id: int,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its token ids and ``end_id``. Only one longer than ``capacity`` is cut, into
    pieces of that length; the last may be shorter. A null text is empty: just ``end_id``.
    """
    kind = dict(docs.dtypes)[id_column]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        schema += ", ids array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for texts in slices(batch.column(1)):
                rows, pieces, starts, lengths, crcs, kept_ids = [], [], [], [], [], []
                for i, ids in enumerate(encode(texts)):
                    ids = np.append(ids, np.uint32(end_id))
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append(texts.first_row + i)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(len(part))
                        crcs.append(zlib.crc32(part.astype("<u4").tobytes()))
                        if with_ids:
                            kept_ids.append(part.astype(np.int32))
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept_ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return docs.select(F.col(id_column), F.col(text_column)).mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document with its place: ``token_pieces`` and ``sequence_id, offset``.

    Sequences hold at most ``capacity`` tokens and are filled from 0 without gaps, as best-fit
    decreasing over all pieces fills them. Pieces of equal length are interchangeable and are
    numbered by a hash of their id and then by id; repeated rows are pieces of their own. Null ids
    stay null. Columns other than id and text are not returned. An empty table gives no rows.
    With ``ids``, a sequence's tokens are its rows' ids ordered by ``offset``.
    """
    spark = docs.sparkSession
    pieces = kept(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids, id_column, text_column))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    per_bucket = kept(pieces.groupBy("bucket", "length").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, capacity))

    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select("bucket", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        pieces.withColumn("number", F.row_number().over(within) - 1)
        .join(before, ["bucket", "length"])
        .withColumn("number", F.col("number") + F.col("ahead"))
        .drop("bucket", "ahead")
    )
    out = [c for c in pieces.columns if c != "bucket"]
    schema = ", ".join(f"{c} {kind}" for c, kind in pieces.dtypes if c != "bucket")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                own = runs[np.searchsorted(runs[:, 0], one) : np.searchsorted(runs[:, 0], one, side="right")]
                at = np.flatnonzero(length == one)
                run = own[np.searchsorted(own[:, 1], number[at], side="right") - 1]
                step = number[at] - run[:, 1]
                sequence[at] = run[:, 3] + step // run[:, 2]
                offset[at] = run[:, 4] + step % run[:, 2] * one
            columns = [batch.column(c) for c in out]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], [*out, "sequence_id", "offset"]
            )

    return numbered.select(*out, "number").mapInArrow(place, f"{schema}, sequence_id long, offset long")
