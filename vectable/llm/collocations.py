"""Phrase collocations by relational mining of occurrences, length by length.

The relation of length k holds the occurrences of the frequent phrases of k words, sorted by piece
and position. Merging it with itself on the same piece and the next position gives the occurrences
of all phrases of k + 1 words whose first and last k words are frequent; they are counted by group,
and a semi-join with the frequent groups leaves the relation of length k + 1. Every relation is
written to the shared folder before it is extended, and deleted when the next one is there.

A relation has rows of about ``ROW`` occurrences of a document, with their sorted positions and phrases.
A document is cut only where no two occurrences follow each other, so what meets is never split and the
merge needs no shuffle, and Arrow's batches of rows stay small however long documents are. Counting pre-aggregates
each batch and then shuffles phrases, never occurrences. The semi-join looks the frequent groups up
in a broadcast table where their number is below ``BROADCAST_KEYS``, and in a bitmap of ``2 ** MARK`` bits
beyond. Occurrences that the bitmap leaves in besides cost work, but count nothing: of a phrase of the next length
that is frequent all parts are, and the others go when they are counted.

A word is known by a 64-bit hash of its language and bytes, a longer phrase by its first and last
parts. Whether two words of the corpus share a hash of a frequent one is checked, and so are the
names of all phrases counted, by their first parts, as name and first part give the last one; another
seed is taken then, so counts are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectable.llm.rolling import Texts, mix, slices, unmix
from vectable.llm.scratch import forget, kept
from vectable.llm.worker import give_back

UNKNOWN = "und"
BREAKS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))  # fixed values: ends of pieces
BETWEEN = BREAKS | np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8))
BROADCAST_KEYS = 1 << 20  # frequent groups that are looked up in every task; 24 bytes each
MARK = 27  # bits of a name that are its place in the bitmap, which has 16 MB
MARKS_IN_ROW = 15  # of these, the place in a row of it, fixed by Spark's bitmap functions
AT_ONCE = 1 << 19  # occurrences that a task merges at once, and those of one more row
ROW = 64  # occurrences in a row of a relation, and those that follow the last without a gap
SENT = 1 << 16  # rows in a batch that a task returns
SEEDS = 8
BUCKETS = 64

RELATION = "doc long, at array<int>, phrase array<long>"


@dataclass
class Occurrences:
    """Flat occurrences of some documents, in order: document number, position, phrase."""

    row: np.ndarray
    at: np.ndarray
    phrase: np.ndarray

    def where(self, mask: np.ndarray) -> Occurrences:
        return Occurrences(self.row[mask], self.at[mask], self.phrase[mask])

    def merged(self) -> tuple[Occurrences, np.ndarray, np.ndarray]:
        """The merge-join on the same piece and the next position: first occurrences, and both phrases.

        Positions differ by one only within a piece, and are sorted and unique, so the partner of an
        occurrence can only be the one that follows it.
        """
        n = max(len(self.at) - 1, 0)
        meets = (self.row[1:] == self.row[:n]) & (self.at[1:] == self.at[:n] + 1)
        left, right = self.phrase[:n][meets], self.phrase[1:][meets]
        return Occurrences(self.row[:n][meets], self.at[:n][meets], left), left, right


def phrase_name(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """The 64-bit name of the phrase with these first and last parts."""
    return mix(_first_part(left, seed) + right.view(np.uint64)).view(np.int64)


def _first_part(left: np.ndarray, seed: int) -> np.ndarray:
    return mix(left.view(np.uint64) + np.uint64(2 * seed + 1)) * np.uint64(0x9E3779B97F4A7C15)


def last_part(name: np.ndarray, left: np.ndarray, seed: int) -> np.ndarray:
    """The last part of the phrase with this name and first part."""
    return (unmix(name.view(np.uint64)) - _first_part(left, seed)).view(np.int64)


def _language_keys(languages: list[str], seed: int) -> np.ndarray:
    known = {x: hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest() for x in set(languages)}
    return np.array([int.from_bytes(known[x], "little") for x in languages], np.uint64)


def word_occurrences(texts: Texts, languages: list[str], seed: int) -> tuple[Occurrences, np.ndarray, np.ndarray]:
    """Every word of a slice of texts, and where it begins and ends in the slice's bytes.

    Positions count the words of a document, and one more at every end of a piece.
    """
    data, offsets = texts.data, texts.offsets
    inside = ~BETWEEN[data]
    joined = np.zeros(len(data) + 1, bool)
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    ended = np.cumsum(BREAKS[data])
    at = np.arange(len(starts)) + (ended[starts] if len(starts) else 0)
    first = np.searchsorted(row, np.arange(len(texts)))  # the first word of each text
    if len(starts):
        at = at - at[np.minimum(first, len(starts) - 1)][row]
    sums, shift = texts.prefix_hashes(), texts.inverse_powers()
    raw = (sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64)
    phrase = mix(mix(raw) ^ _language_keys(languages, seed)[row]).view(np.int64)
    return Occurrences(row, at.astype(np.int32), phrase), starts, ends


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Texts, list[str]]]:
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        for texts in slices(batch.column("text")):
            yield texts.lower_ascii(), languages[texts.first_row : texts.first_row + len(texts)]


def _vocabulary(seed: int):
    """Counted words per slice, with their languages and spelling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, languages in _slices(batches):
            words, starts, ends = word_occurrences(texts, languages, seed)
            phrase, first, n = np.unique(words.phrase, return_index=True, return_counts=True)
            starts, sizes = starts[first], (ends - starts)[first]
            bounds = np.append(0, np.cumsum(sizes))
            data = texts.data[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])]
            spelled = pa.StringArray.from_buffers(
                len(phrase), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
            )
            own = pa.array(languages, pa.string()).take(pa.array(words.row[first]))
            yield pa.RecordBatch.from_arrays(
                [own, spelled, pa.array(phrase), pa.array(n)], ["lang", "word", "phrase", "n"]
            )
        give_back()

    return run


Keep = Callable[[np.ndarray, np.ndarray | None, np.ndarray | None], np.ndarray]


def _lookup(table: tuple[np.ndarray, np.ndarray, np.ndarray] | np.ndarray) -> Keep:
    """Which phrases are in a broadcast table of names (sorted) and of their parts, or have their bits in a bitmap."""
    if isinstance(table, np.ndarray):
        return lambda phrase, left, right: _marked(table, phrase)
    names, lefts, rights = table

    def keep(phrase: np.ndarray, left: np.ndarray | None, right: np.ndarray | None) -> np.ndarray:
        if not len(names):
            return np.zeros(len(phrase), bool)
        place = np.minimum(np.searchsorted(names, phrase), len(names) - 1)
        found = names[place] == phrase
        return found if left is None else found & (lefts[place] == left) & (rights[place] == right)

    return keep


def _marked(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    mark = names.view(np.uint64) >> np.uint64(64 - MARK)
    return (bits[mark >> np.uint64(3)] >> (mark & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _as_batch(found: Occurrences, docs: np.ndarray) -> pa.RecordBatch:
    """The documents that have occurrences, with lists of them: rows of about ``ROW``, cut where a gap is."""
    n = len(found.at)
    other, gap = np.ones(n, bool), np.ones(n, bool)
    other[1:] = found.row[1:] != found.row[:-1]
    gap[1:] = other[1:] | (found.at[1:] != found.at[:-1] + 1)
    block = np.maximum.accumulate(np.where(gap, np.arange(n), 0)) // ROW
    other[1:] |= block[1:] != block[:-1]
    first = np.flatnonzero(other)
    bounds = pa.array(np.append(first, n), pa.int32())
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (found.at.astype(np.int32), found.phrase)]
    return pa.RecordBatch.from_arrays([pa.array(docs[found.row[first]]), *lists], ["doc", "at", "phrase"])


def _sent(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns in batches of ``SENT`` rows: Spark holds each outside its heap."""
    for low in range(0, len(columns[0]), SENT):
        yield pa.RecordBatch.from_arrays([pa.array(x[low : low + SENT]) for x in columns], names)


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Occurrences, np.ndarray]]:
    """The relation in runs of whole rows of about ``AT_ONCE`` occurrences, with the numbers of the rows' documents."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("at")).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes) // AT_ONCE
        bounds = np.append(np.unique(run, return_index=True)[1], len(batch))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part = batch.slice(low, high - low)
            row = np.repeat(np.arange(high - low), sizes[low:high])
            at, phrase = (part.column(c).flatten().to_numpy() for c in ("at", "phrase"))
            yield Occurrences(row, at, phrase), part.column("doc").to_numpy()


def _words(seed: int, table) -> Callable:
    """The relation of the single words in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = TaskContext.get().partitionId() << 33
        keep = _lookup(table.value)
        for texts, languages in _slices(batches):
            words = word_occurrences(texts, languages, seed)[0]
            docs = doc + np.arange(len(texts))
            doc += len(texts)
            yield _as_batch(words.where(keep(words.phrase, None, None)), docs)
        give_back()

    return run


def _pairs_counted(seed: int) -> Callable:
    """How often neighbouring phrases meet, per run of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _ in _flat(batches):
            _, left, right = found.merged()
            name = phrase_name(left, right, seed)
            order = np.lexsort((left, name))
            name, left = name[order], left[order]
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (left[1:] != left[:-1])
            start = np.flatnonzero(new)
            n = np.diff(np.append(start, len(name)))
            yield from _sent([name[start], left[start], n], ["phrase", "left", "n"])
        give_back()

    return run


def _with_last(seed: int) -> Callable:
    """Phrases with their last parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, left, n = batch.columns
            right = pa.array(last_part(name.to_numpy(), left.to_numpy(), seed))
            yield pa.RecordBatch.from_arrays([name, left, right, n], ["phrase", "left", "right", "n"])

    return run


def _extended(seed: int, table) -> Callable:
    """The relation one word longer, semi-joined with the table of frequent phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = _lookup(table.value)
        for found, docs in _flat(batches):
            longer, left, right = found.merged()
            longer.phrase = phrase_name(left, right, seed)
            yield _as_batch(longer.where(keep(longer.phrase, left, right)), docs)
        give_back()

    return run


def _merged_rows(seed: int) -> Callable:
    """The relation one word longer, all of it, an occurrence a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, docs in _flat(batches):
            longer, left, right = found.merged()
            columns = [docs[longer.row], longer.at, phrase_name(left, right, seed), left, right]
            yield from _sent(columns, ["doc", "at", "phrase", "left", "right"])
        give_back()

    return run


def _broadcast_table(frequent: DataFrame, bound: int):
    """The frequent phrases, sorted by name, broadcast; a bitmap of their names if there are more than ``bound``."""
    context = frequent.sparkSession.sparkContext
    if frequent.count() > bound:
        return context.broadcast(_bitmap(frequent.select("phrase")))
    table = frequent.select("phrase", "left", "right").toArrow()
    parts = [table.column(k).to_numpy() for k in range(3)]
    order = np.argsort(parts[0])
    return context.broadcast(tuple(x[order] for x in parts))


def _bitmap(names: DataFrame) -> np.ndarray:
    """``2 ** MARK`` bits, those set that are the first bits of a name; at most 4,096 rows come back."""
    mark = F.shiftrightunsigned("phrase", 64 - MARK)
    row, bit = F.shiftright(mark, MARKS_IN_ROW).alias("row"), mark.bitwiseAND((1 << MARKS_IN_ROW) - 1).alias("bit")
    rows = names.select(row, bit).groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros((1 << MARK - MARKS_IN_ROW, (1 << MARKS_IN_ROW) // 8), np.uint8)
    for at, held in zip(rows.column("row").to_pylist(), rows.column("bits").to_pylist(), strict=True):
        bits[at] = np.frombuffer(held, np.uint8)
    return bits.ravel()


def _counted_words(docs: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """All words with their counts, and a seed by which no frequent word shares its hash."""
    for seed in range(SEEDS):
        found = docs.mapInArrow(_vocabulary(seed), "lang string, word string, phrase long, n long")
        words = kept(found.groupBy("lang", "word", "phrase").agg(F.sum("n").alias("n")))
        by_hash = words.groupBy("phrase").agg(F.count("*").alias("words"), F.max("n").alias("most"))
        if by_hash.where((F.col("words") > 1) & (F.col("most") >= min_count)).isEmpty():
            return words, seed
    raise ValueError(f"no seed of {SEEDS} tells the words apart")


def _longer(relation: DataFrame, frequent: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """The frequent phrases one word longer, with the counts of their parts and their text."""
    for seed in range(SEEDS):
        found = relation.mapInArrow(_pairs_counted(seed), "phrase long, left long, n long")
        counted = found.groupBy("phrase").agg(
            F.sum("n").alias("n"), F.min("left").alias("left"), F.max("left").alias("other")
        )
        often = kept(counted.where(F.col("n") >= min_count))
        if often.where("left <> other").isEmpty():  # else phrases share a name
            break
    else:
        raise ValueError(f"no seed of {SEEDS} tells the phrases apart")
    new = often.select("phrase", "left", "n").mapInArrow(
        _with_last(seed), "phrase long, left long, right long, n long"
    )
    first = frequent.select(
        F.col("phrase").alias("left"),
        "lang",
        F.col("words").alias("left_words"),
        F.concat("firsts", F.array("n")).alias("firsts"),
    )
    last = frequent.select(
        F.col("phrase").alias("right"),
        F.element_at("words", -1).alias("last_word"),
        F.concat("lasts", F.array("n")).alias("lasts"),
    )
    joined = new.join(first, "left").join(last, "right")
    words = F.concat("left_words", F.array("last_word")).alias("words")
    return kept(joined.select("lang", "phrase", "left", "right", "n", words, "firsts", "lasts")), seed


def _cut() -> Column:
    """The lowest-scoring cut of a phrase, by ``firsts`` and ``lasts``, the counts of its parts by length."""

    def at(k: Column) -> Column:
        l, r = F.element_at("firsts", k), F.element_at("lasts", -k)
        return F.struct(_score(l, r).alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("firsts")), at))


def _score(l: Column, r: Column) -> Column:
    """``floor(1000000 * n * n / (l * r))``, exactly: counts have 16 digits at most."""
    n, l, r = F.col("n").cast("decimal(16,0)"), l.cast("decimal(16,0)"), r.cast("decimal(16,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", n * n * million, l * r).cast("long")


def _first_relation(docs: DataFrame, frequent: DataFrame, seed: int, bound: int) -> DataFrame:
    return kept(docs.mapInArrow(_words(seed, _broadcast_table(frequent, bound)), RELATION), "zstd")


def _next_relation(relation: DataFrame, frequent: DataFrame, seed: int, bound: int) -> DataFrame:
    longer = kept(relation.mapInArrow(_extended(seed, _broadcast_table(frequent, bound)), RELATION), "zstd")
    forget(relation)
    return longer


def phrases(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    max_words: int = 3,
    min_count: int = 10,
    percent_inside: int = 50,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """The collocations of every language: ``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at blanks and
    tabs into words. ``n`` counts a language's words, ``a`` the occurrences of a phrase of 2 to
    ``max_words`` words within pieces, overlaps included, at least ``min_count``. Cut after any word, a
    phrase scores ``floor(1000000 * a * a / (l * r))`` by the counts of its parts; the lowest-scoring
    cut counts, and the first of these. Phrases inside a longer one that has ``percent_inside`` per
    cent of their occurrences or more are left out.

    A null language is ``und``; null and empty texts have no words. Every row counts, repeated ones
    too, and other columns are ignored. An empty table gives an empty table. Counts are exact up to
    sixteen digits.
    """
    named = docs.select(
        F.coalesce(F.col(f"`{lang_column}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_column}`").alias("text")
    )
    words, seed = _counted_words(named, min_count)
    none = F.array().cast("array<bigint>")
    often = words.where(F.col("n") >= min_count)
    single = [F.col("phrase").alias("left"), F.col("phrase").alias("right")]
    counts = ["n", F.array("word").alias("words"), none.alias("firsts"), none.alias("lasts")]
    levels = [kept(often.select("lang", "phrase", *single, *counts))]
    relation = _first_relation(named, levels[0], seed, broadcast_keys)
    for size in range(2, max_words + 1):
        longer, seed = _longer(relation, levels[-1], min_count)
        levels.append(longer)
        if size < max_words:
            relation = _next_relation(relation, longer, seed, broadcast_keys)
    forget(relation)

    found = []
    for shorter, longer in zip(levels[1:], [*levels[2:], None], strict=True):
        if longer is not None:  # a phrase inside one of two words more is inside the one between, as often at least
            inside = [longer.select(F.col(side).alias("phrase"), F.col("n").alias("most")) for side in ("left", "right")]
            most = inside[0].unionByName(inside[1]).groupBy("phrase").agg(F.max("most").alias("most"))
            shorter = shorter.join(most, "phrase", "left").where(
                F.col("most").isNull() | (100 * F.col("most") < percent_inside * F.col("n"))
            )
        found.append(shorter.select("lang", F.array_join("words", " ").alias("phrase"), "n", _cut().alias("cut")))
    if not found:
        raise ValueError("max_words must be 2 at least")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    scored = every.join(F.broadcast(totals) if totals.count() < BROADCAST_KEYS else totals, "lang")
    return scored.select(
        "lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
    )


def top_phrases(found: DataFrame, top: int) -> DataFrame:
    """Every language's first ``top`` phrases with their ``rank``: by score, count (both falling) and spelling."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))  # so no task ranks what all tasks kept of a language
    some = found.withColumn("bucket", bucket)
    rank = F.row_number()
    some = some.withColumn("rank", rank.over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    some = some.where(F.col("rank") <= top)
    ranked = some.withColumn("rank", rank.over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).drop("bucket")
