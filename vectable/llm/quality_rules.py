"""Quality rules: base counts per text, and a log-likelihood ratio of hashed word n-grams.

Two multinomials over a fixed number of n-gram buckets are counted: one on all trusted documents,
one on the whole corpus. A document's score is the mean over its n-grams of
the log ratio of the two, so it doesn't depend on its length; documents below a fixed threshold
fail. One pass counts the corpus, one the trusted documents, and one scores; each task sends back
one row per bucket. Only texts of trusted documents, and few others, are shuffled, by id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.rolling import Texts, Words, combine, mix, slices

BUCKETS = 1 << 14
GRAMS = 2
MARKS = 1 << 27  # bits of the bitmap of trusted ids
BLOCK_BITS = 1 << 15  # bits of a row of it, fixed by Spark's bitmap functions
THRESHOLD = -0.3
SYMBOLS = b"#*$%&|<>"
RESULT = (
    "struct<n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double>"
)


def gram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every 1- to ``GRAMS``-gram of words, and the text it belongs to.

    Marks at the end of a word are grams of their own, so that a word counts the same with them.
    """
    hashes, text = words.hashes(), words.text_of()
    features, owners = [], []
    for size in range(1, GRAMS + 1):
        found = combine(hashes, size)
        inside = text[: len(found)] == text[size - 1 :]
        features.append((found[inside] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(text[: len(found)][inside])
    return np.concatenate(features), np.concatenate(owners)


def _apart(texts: Texts) -> np.ndarray:
    """Where a run of ASCII punctuation begins or ends."""
    data = texts.data
    folded = (data | np.uint8(32)) - np.uint8(97)
    plain = (data > 32) & (data < 127) & ~(folded < 26) & ~((data - np.uint8(48)) < 10)
    apart = np.zeros(len(data), bool)
    apart[1:] = plain[1:] != plain[:-1]
    return apart


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    return gram_buckets(texts.words(_apart(texts)))


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of every text."""
    data, offsets = texts.data, texts.offsets
    words = texts.words()
    blank = (data == 32) | ((data - np.uint8(9)) < 5)
    within = np.append(0, np.cumsum(~blank & ((data & np.uint8(0xC0)) != 0x80)))
    symbol = np.append(0, np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))))
    counts = {
        "n_words": words.counts,
        "word_chars": within[offsets[1:]] - within[offsets[:-1]],
        "n_symbols": symbol[offsets[1:]] - symbol[offsets[:-1]],
    }
    # Lines: runs of bytes between newlines and text ends.
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(breaks, offsets)) + 1)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = np.where(line_text[1:] == line_text[:-1], starts[1:] - 1, offsets[1:][line_text[:-1]])
    ends[-1:] = offsets[-1]
    sums = texts.prefix_hashes()
    inverse = texts.inverse_powers()
    line = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    has_word = np.append(0, np.cumsum(~blank))
    full = has_word[ends] > has_word[starts]
    line, owner = line[full], line_text[full]
    by = np.lexsort((line, owner))
    again = (line[by][1:] == line[by][:-1]) & (owner[by][1:] == owner[by][:-1])
    counts["n_dup_lines"] = np.bincount(owner[by][1:][again], minlength=len(texts))
    # Words in a window of three that the text has twice or more.
    text = words.text_of()
    window = combine(words.hashes(), 3)
    n = len(window)
    inside = np.flatnonzero(text[:n] == text[2:]) if n else np.zeros(0, int)
    by = inside[np.lexsort((window[inside], text[inside]))]
    same = (window[by][1:] == window[by][:-1]) & (text[by][1:] == text[by][:-1])
    twice = by[np.append(same, False) | np.append(False, same)] if len(by) else by
    covered = np.zeros(len(text), bool)
    for k in range(3):
        covered[twice + k] = True
    counts["n_repeat_words"] = np.bincount(text[covered], minlength=len(texts))
    return counts


def log_ratios(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> np.ndarray:
    """Per bucket the log of its trusted over its corpus probability, one added to each count.

    ``trusted`` has ids in its first column; all documents with one of them count. With no trusted
    document every ratio is 0. Null ids are nobody's; trusted ids are cast to the type of the documents'.
    """
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(given.dtypes)["id"]
    chosen = trusted.select(F.col(trusted.columns[0]).try_cast(kind).alias("id")).where("id IS NOT NULL").distinct()
    likely = _likely(given.where("id IS NOT NULL"), chosen)
    # Ids grow with the corpus. A semi-join would be moved below the bitmap's; ids are distinct here.
    target = _counts(likely.join(chosen.hint("merge"), "id").select("text"))
    if not target.sum():
        return np.zeros(BUCKETS)
    corpus = _counts(given.select("text"))
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((corpus + 1) / (corpus.sum() + BUCKETS))


def _counts(texts: DataFrame) -> np.ndarray:
    """The number of n-grams in each bucket."""

    def count(batches):
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                sums += np.bincount(_grams(part)[0], minlength=BUCKETS)
        parts = [pa.array(np.arange(BUCKETS), pa.int32()), pa.array(sums)]
        yield pa.RecordBatch.from_arrays(parts, ["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(BUCKETS)
    if rows.num_rows:
        found[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return found


def _likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose id is one of ``ids``, and few others: by a bitmap over hashes of the ids.

    So few texts but those wanted cross the network. The bitmap has ``MARKS`` bits, whatever the number
    of ids: at most ``MARKS / BLOCK_BITS`` rows of ``BLOCK_BITS / 8`` bytes are broadcast.
    """
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    block, bit = F.floor(mark / BLOCK_BITS).alias("block"), (mark % BLOCK_BITS).alias("bit")
    bits = ids.select(block, bit).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    met = rows.select("*", block, bit).join(F.broadcast(bits), "block")
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    return met.withColumn("byte", byte).where("shiftright(byte, CAST(bit % 8 AS INT)) & 1 = 1").select(rows.columns)


def with_quality(
    docs: DataFrame,
    ratios: np.ndarray,
    threshold: float = THRESHOLD,
    min_words: int = 50,
    max_repeated_percent: int = 50,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` as a struct ``row``, with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, score, base_failed, kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeated_percent`` of them in
    windows of three words that the text repeats. ``kept``: not ``base_failed`` and ``score`` at
    least ``threshold``. A null text and one without words have counts 0 and score 0 and fail.
    Every row is judged by its text alone; equal texts are judged alike.
    """
    table = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf(RESULT)
    def judge(column: pa.Array) -> pa.Array:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
        parts = {name: [np.zeros(0)] for name in names}
        for texts in slices(column):
            counts = base_counts(texts)
            bucket, owner = _grams(texts)
            n = np.bincount(owner, minlength=len(texts))
            total = np.bincount(owner, weights=table.value[bucket], minlength=len(texts))
            counts["score"] = total / np.maximum(n, 1)
            for name in names:
                parts[name].append(counts[name])
        kinds = [pa.int64()] * 5 + [pa.float64()]
        columns = [np.concatenate(parts[name]) for name in names]
        arrays = [pa.array(c if k == pa.float64() else c.astype(np.int64), k) for c, k in zip(columns, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, names)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = row.withColumn("found", judge(F.col(f"row.`{text_column}`"))).select("row", "found.*")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words")
    )
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
