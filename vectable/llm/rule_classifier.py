"""A quality classifier of weighted rules over text statistics, run as Spark columns.

Boosted trees on a bounded sample of labelled documents give candidate rules: every path in a
tree is a conjunction of comparisons. A lasso logistic regression over the rules keeps few of
them. The rules and weights become one Spark expression over the statistics, which are computed
from the whole text in one pass.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.llm.quality_rules import base_counts
from vectable.llm.rolling import Texts, slices
from vectable.llm.trees import fit_trees, sigmoid

SAMPLE = 20_000  # labelled documents that the rules are fitted on
LASSO = 5e-4

STATISTICS = (
    "log_words",
    "mean_word",
    "symbols_per_word",
    "repeated_share",
    "duplicate_lines",
    "capital_share",
    "digit_share",
    "mark_share",
    "bangs_per_word",
    "bars_per_word",
    "beyond_ascii",
    "words_per_line",
    "short_words",
    "long_words",
    "distinct_words",
    "same_as_previous",
    "most_frequent",
    "sentence_ends",
)
STATISTICS_TYPE = T.StructType([T.StructField(name, T.DoubleType()) for name in STATISTICS])


def statistics(texts: Texts) -> np.ndarray:
    """One row of ``STATISTICS`` per text; all are 0 for a text without words, apart from shares of characters."""
    data, offsets = texts.data, texts.offsets
    base = base_counts(texts)

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(mask))
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    n = np.maximum(base["n_words"], 1).astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    folded = ((data | np.uint8(32)) - np.uint8(97)) < 26
    digit = (data - np.uint8(48)) < 10
    capital = (data - np.uint8(65)) < 26
    lines = per_text(data == 10) + 1
    words = texts.words()
    owner, lengths, hashes = words.text_of(), words.ends - words.starts, words.hashes()

    def share_of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=len(texts)) / n

    distinct, most = np.zeros(len(texts)), np.zeros(len(texts))
    if len(owner):
        by = np.lexsort((hashes, owner))
        new = np.append(True, (hashes[by][1:] != hashes[by][:-1]) | (owner[by][1:] != owner[by][:-1]))
        at = np.flatnonzero(new)
        distinct = np.bincount(owner[by][at], minlength=len(texts))
        np.maximum.at(most, owner[by][at], np.diff(np.append(at, len(by))))
    last = data[words.ends - 1] if len(owner) else np.zeros(0, np.uint8)
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))[: len(owner)]
    columns = [
        np.log1p(base["n_words"]),
        base["word_chars"] / n,
        base["n_symbols"] / n,
        base["n_repeat_words"] / n,
        base["n_dup_lines"] / lines,
        per_text(capital) / np.maximum(per_text(folded), 1),
        per_text(digit) / size,
        per_text((data > 32) & (data < 127) & ~folded & ~digit) / size,
        per_text(data == 33) / n,
        per_text(data == 124) / n,
        per_text(data >= 128) / size,
        base["n_words"] / lines,
        share_of_words(lengths <= 3),
        share_of_words(lengths > 12),
        distinct / n,
        share_of_words(again),
        most / n,
        share_of_words(np.isin(last, np.frombuffer(b".!?", np.uint8))),
    ]
    return np.stack([np.asarray(c, float) for c in columns], 1)


@F.arrow_udf(STATISTICS_TYPE)
def text_statistics(column: pa.Array) -> pa.Array:
    """The ``STATISTICS`` of each text; null is the empty text."""
    parts = [np.zeros((0, len(STATISTICS)))] + [statistics(texts) for texts in slices(column)]
    table = np.concatenate(parts)
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(STATISTICS))], list(STATISTICS))


def lasso_logistic(rules: np.ndarray, label: np.ndarray, strength: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept minimising the mean log loss plus ``strength`` times the absolute weights."""
    n, width = rules.shape
    design = np.hstack([rules, np.ones((n, 1))])
    step = 4 * n / max(np.linalg.norm(design.T @ design, 2), 1e-9)
    at = ahead = np.zeros(width + 1)
    pace = 1.0
    penalty = np.append(np.full(width, step * strength), 0.0)
    for _ in range(steps):  # accelerated proximal gradient
        slope = design.T @ (sigmoid(design @ ahead) - label) / n
        moved = ahead - step * slope
        moved = np.sign(moved) * np.maximum(np.abs(moved) - penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = moved + (pace - 1) / faster * (moved - at)
        at, pace = moved, faster
    return at[:-1], float(at[-1])


@dataclass
class RuleEnsemble:
    """Rules as ``(weight, ((statistic, above, threshold), ...))`` and the log odds without any."""

    intercept: float
    rules: list[tuple[float, tuple[tuple[str, bool, float], ...]]]

    def score(self, statistic: str) -> Column:
        """The probability of a good document, from a struct column of statistics."""

        def holds(conditions) -> str:
            return " AND ".join(f"{statistic}.{s} {'>' if up else '<='} {t!r}D" for s, up, t in conditions)

        terms = [f"IF({holds(conditions)}, {weight!r}D, 0D)" for weight, conditions in self.rules]
        total = " + ".join([f"{self.intercept!r}D", *terms])
        return F.expr(f"1D / (1D + exp(-({total})))")


def learn_rules(rows: np.ndarray, label: np.ndarray) -> RuleEnsemble:
    trees, start = fit_trees(rows, label, rounds=40, depth=3)
    paths = dict.fromkeys(path for tree in trees for path in tree.paths())
    columns, kept_paths, known = [], [], set()
    for path in paths:
        holds = np.ones(len(rows), bool)
        for feature, above, threshold in path:
            holds &= (rows[:, feature] > threshold) == above
        key = holds.tobytes()
        if 0 < holds.sum() < len(rows) and key not in known:
            known.add(key)
            columns.append(holds)
            kept_paths.append(path)
    if not columns:
        return RuleEnsemble(start, [])
    weights, intercept = lasso_logistic(np.stack(columns, 1).astype(float), label, LASSO)
    rules = [
        (float(w), tuple((STATISTICS[f], above, t) for f, above, t in path))
        for w, path in zip(weights, kept_paths, strict=True)
        if w
    ]
    return RuleEnsemble(intercept, rules)


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    sample: int = SAMPLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_id: str = "doc_id",
    label_column: str = "quality",
) -> RuleEnsemble:
    """Rules from documents with a label of 0 or 1 whose row of ``labels`` meets ``train``.

    The ``sample`` ids with the smallest hashes are used. Null ids and labels aren't; an id with
    several labels takes the largest, and of a repeated id one row counts, that of the least statistics.
    Every distinct path of the trees is a candidate. Without a usable label the score is 0.5 throughout.
    """
    wanted = labels.where(train & F.col(label_id).isNotNull() & F.col(label_column).isin(0, 1))
    chosen = wanted.groupBy(F.col(label_id).alias("id")).agg(F.max(label_column).cast("double").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(sample)
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    known = given.join(F.broadcast(chosen), "id")  # at most ``sample`` ids
    found = known.select("id", "label", text_statistics("text").alias("found"))
    rows = found.groupBy("id", "label").agg(F.min("found").alias("found")).select("id", "label", "found.*")

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        matrix = np.stack([table.column(s).to_numpy() for s in STATISTICS], 1)
        model = learn_rules(matrix, table.column("label").to_numpy())
        return pa.table({"model": [json.dumps([model.intercept, model.rules])]})

    fitted = rows.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "model string").first()
    if fitted is None:
        return RuleEnsemble(0.0, [])
    intercept, rules = json.loads(fitted["model"])
    return RuleEnsemble(intercept, [(w, tuple(tuple(c) for c in conditions)) for w, conditions in rules])


def with_score(docs: DataFrame, model: RuleEnsemble, text_column: str = "text") -> DataFrame:
    """``docs`` as a struct ``row``, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5).

    Every row is judged by its text alone; a null text is judged as the empty one.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = row.withColumn("found", text_statistics(F.col(f"row.`{text_column}`")))
    scored = judged.select("row", model.score("found").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
