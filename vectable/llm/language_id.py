"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword; for each bit a binary classifier over hashed byte n-grams
(lengths 1 to 3, square roots of their shares) says which half of the languages a text is like.
Decoding sums over the bits how far each answer is from the codeword's, weighted by how well
the bit did on left-out texts, and takes the nearest codeword. A second codeword nearly as near
makes the text ambiguous.

The classifiers are ridge regressions on a bounded sample of labelled texts, the same number of
each language, solved in one task; prediction is one pass over the whole texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectable.llm.rolling import Texts, slices
from vectable.llm.worker import give_back

FEATURE_BITS = 12
FEATURES = 1 << FEATURE_BITS
SAMPLE = 2400  # texts that the classifiers are fitted on, all languages together
LEAST_TEXTS = 5  # labelled texts of a language that is learnt
BUCKETS = 64  # a language's texts are ranked by buckets first, so no task ranks all of them
AT_ONCE = 256  # texts whose n-grams are counted at once, 32 kilobytes each
BLOCK = 256  # rows of the kernel, and features, that are worked on at once
RIDGE = 3e-3
SHARPNESS = 6.0
UNDETERMINED = "und"


def ngram_shares(texts: Texts) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text, with length 1 unless the text is empty."""
    data = texts.lower_ascii().data
    letter = ((data - np.uint8(97)) < 26) | (data >= 128)
    data = np.where(letter, data, np.uint8(32)).astype(np.uint32)
    sizes = np.diff(texts.offsets)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) << FEATURE_BITS, sizes)
    left = np.repeat(texts.offsets[1:], sizes) - np.arange(len(data))
    counts = np.zeros(len(texts) << FEATURE_BITS)
    gram = np.zeros(len(data), np.uint32)
    for size in (1, 2, 3):
        n = max(len(data) - size + 1, 0)
        gram = gram[:n] * np.uint32(256) + data[size - 1 : size - 1 + n]
        feature = (gram * np.uint32(2654435761) + np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        at = row[:n] + (feature >> np.uint32(32 - FEATURE_BITS))
        if size > 1:
            at = at[left[:n] >= size]
        counts += np.bincount(at, minlength=len(counts))
    counts = counts.reshape(len(texts), FEATURES)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 per language: all splits in two for few languages, else drawn far apart."""
    if languages <= 7:
        splits = np.arange(1, 1 << max(languages - 1, 1))
        rows = np.arange(languages)
        return np.where(splits[None, :] >> rows[:, None] & 1, 1.0, -1.0)
    bits = int(np.ceil(10 * np.log2(languages)))
    draws = [np.random.default_rng(seed).integers(0, 2, (languages, bits)) * 2.0 - 1 for seed in range(20)]
    apart = [np.min(bits - d @ d.T + 4 * bits * np.eye(languages)) for d in draws]
    return draws[int(np.argmax(apart))]


@dataclass
class LanguageModel:
    """Languages, their codewords, and per bit a weight for decoding and a linear classifier."""

    languages: list[str]
    code: np.ndarray
    bit_weight: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def parts(self) -> tuple:
        return self.languages, self.code, self.bit_weight, self.weights, self.bias


def _invert(a: np.ndarray) -> None:
    """A positive definite matrix becomes its inverse, in its own place: Gauss-Jordan elimination by blocks."""
    blocks = [slice(low, min(low + BLOCK, len(a))) for low in range(0, len(a), BLOCK)]
    for pivot in blocks:
        own = np.linalg.inv(a[pivot, pivot])
        across = own @ a[pivot]
        for rows in blocks:
            if rows != pivot:
                down = a[rows, pivot].copy()
                a[rows] -= down @ across
                a[rows, pivot] = -down @ own
        a[pivot] = across
        a[pivot, pivot] = own


def fit_bits(shares: np.ndarray, label: np.ndarray, languages: int) -> tuple[np.ndarray, ...]:
    """Code, bit weights, and the ridge solutions of all bits with their left-out errors."""
    code = codewords(languages)
    target = code[label]
    mean = shares.mean(0)
    middle = target.mean(0)
    blocks = [slice(low, low + BLOCK) for low in range(0, shares.shape[1], BLOCK)]

    def centred(features: slice) -> np.ndarray:
        return (shares[:, features] - mean[features]).astype(np.float64)

    kernel = np.zeros((len(shares), len(shares)))
    for features in blocks:
        part = centred(features)
        for low in range(0, len(part), BLOCK):
            kernel[low : low + BLOCK] += part[low : low + BLOCK] @ part.T
    kernel.flat[:: len(kernel) + 1] += RIDGE * len(kernel)
    _invert(kernel)
    dual = kernel @ (target - middle)
    left_out = target - dual / np.diag(kernel)[:, None]
    del kernel
    right = np.mean(np.sign(left_out) == target, axis=0)
    weight = np.maximum(2 * right - 1, 0.01)
    weights = np.concatenate([centred(features).T @ dual for features in blocks])
    return code, weight / weight.sum(), weights, middle - mean @ weights


def _has_letter(texts: Texts) -> np.ndarray:
    data = texts.data
    ascii_letter = np.append(0, np.cumsum(((data | np.uint8(32)) - np.uint8(97)) < 26))
    found = ascii_letter[texts.offsets[1:]] > ascii_letter[texts.offsets[:-1]]
    for i in np.flatnonzero(~found).tolist():
        text = data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def decode(model: tuple, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the nearest language's number, the score of it (0 to 1), and of the next one."""
    languages, code, bit_weight, weights, bias = model
    answers = np.clip(shares.astype(np.float64) @ weights + bias, -1.5, 1.5)
    loss = np.empty((len(answers), len(code)))
    for i, word in enumerate(code):  # languages may be many
        loss[:, i] = ((answers - word) ** 2 * bit_weight).sum(1)
    score = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
    score /= score.sum(1, keepdims=True)
    best = loss.argmin(1)
    rows = np.arange(len(best))
    top = score[rows, best]
    score[rows, best] = 0
    return best, top, score.max(1)


def fit_languages(
    docs: DataFrame,
    train: Column,
    lang_column: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
    least_texts: int = LEAST_TEXTS,
) -> LanguageModel:
    """A model from rows for which ``train`` holds and whose text and language aren't null.

    Languages with fewer than ``least_texts`` such rows are names given by mistake and aren't learnt; if
    more than ``sample`` languages are left, that is an error. Of every language the same number of texts
    is used, those with the smallest hashes of their ids, ``sample`` in all; of a repeated id one row
    counts. Without such rows the model knows no language and finds every text undetermined.
    """
    spark = docs.sparkSession
    lang = F.col(lang_column)
    labelled = docs.where(train & lang.isNotNull() & F.col(text_column).isNotNull())
    named = labelled.groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).where(F.col("n") >= least_texts)
    languages = sorted(r["lang"] for r in named.limit(sample + 1).collect())
    if len(languages) > sample:
        raise ValueError(f"more than {sample} languages, the number of texts that are used")
    if not languages:
        none = np.zeros((0, 0))
        return LanguageModel([], none, none, none, none)
    per_language = max(1, sample // len(languages))
    number = F.array_position(F.lit(languages), lang) - 1
    keyed = labelled.select(F.col(id_column).alias("id"), number.alias("label")).where("label >= 0")
    keyed = keyed.distinct().withColumn("bucket", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(BUCKETS)))
    for group in (["label", "bucket"], ["label"]):
        lowest = Window.partitionBy(*group).orderBy(F.xxhash64("id"), "id")
        keyed = keyed.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= per_language)
    chosen = keyed.select("id", "label")  # ``sample`` at most
    texts = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), number.alias("label"))
    rows = texts.join(F.broadcast(chosen), ["id", "label"], "left_semi")
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def shares_of(batches):
        for batch in batches:
            for part in slices(batch.column(0), rows=AT_ONCE):
                found = ngram_shares(part).astype(np.float16)
                label = batch.column(1).slice(part.first_row, len(part))
                packed = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([packed, label.cast(pa.int64())], ["shares", "label"])
        give_back()

    known = len(languages)

    def solve(table: pa.Table) -> pa.Table:
        packed = table.column("shares").to_pylist()
        label = table.column("label").to_numpy()
        order = sorted(range(len(packed)), key=lambda i: (label[i], packed[i]))
        shares = np.empty((len(order), FEATURES), np.float32)
        for row, i in enumerate(order):
            shares[row] = np.frombuffer(packed[i], np.float16)
        del packed
        parts = fit_bits(shares, label[order], known)
        del shares
        give_back()
        columns = [np.ascontiguousarray(p, np.float64).tobytes() for p in parts]
        return pa.table({"parts": pa.array([columns], pa.list_(pa.binary()))})

    shares = rows.select("text", "label").mapInArrow(shares_of, "shares binary, label long")
    fitted = shares.groupBy(F.lit(0).alias("all")).applyInArrow(solve, "parts array<binary>").first()["parts"]
    code, bit_weight, weights, bias = (np.frombuffer(bytes(p)) for p in fitted)
    bits = len(bit_weight)
    return LanguageModel(
        languages, code.reshape(-1, bits), bit_weight, weights.reshape(FEATURES, bits), bias
    )


def with_language(
    docs: DataFrame,
    model: LanguageModel,
    text_column: str = "text",
    lang_pred: str = "lang_pred",
    score: str = "score",
    ambiguous: str = "ambiguous",
    margin: float = 0.1,
) -> DataFrame:
    """``docs`` with the predicted language, its score and whether a second language is as near.

    ``lang_pred`` is ``und`` and ``score`` 0 where the text is null or has no letter, or where the
    model knows no language. ``ambiguous`` is true if the second score is within ``margin`` of the
    first. Columns of these names are replaced. Every row is judged by its text alone.
    """
    parts = docs.sparkSession.sparkContext.broadcast(model.parts())

    @F.arrow_udf("struct<lang string, score double, next double>")
    def judge(column: pa.Array) -> pa.Array:
        languages = parts.value[0]
        names, scores, nexts = [], [], []
        for texts in slices(column, rows=AT_ONCE):
            known = _has_letter(texts) & bool(languages)
            name = np.full(len(texts), UNDETERMINED, object)
            top, second = np.zeros(len(texts)), np.zeros(len(texts))
            if languages:
                best, first, following = decode(parts.value, ngram_shares(texts))
                name = np.where(known, np.array(languages, object)[best], name)
                top, second = np.where(known, first, 0.0), np.where(known, following, 0.0)
            names.append(name)
            scores.append(top)
            nexts.append(second)
        flat = [np.concatenate(x) if x else np.zeros(0) for x in (names, scores, nexts)]
        kinds = (pa.string(), pa.float64(), pa.float64())
        columns = [pa.array(x, kind) for x, kind in zip(flat, kinds, strict=True)]
        return pa.StructArray.from_arrays(columns, ["lang", "score", "next"])

    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "found", judge(F.col(f"row.`{text_column}`"))
    )
    new = {
        lang_pred: F.col("found.lang"),
        score: F.col("found.score"),
        ambiguous: F.col("found.score") - F.col("found.next") < margin,
    }
    out = [new.pop(c).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return judged.select(*out, *[value.alias(name) for name, value in new.items()])
