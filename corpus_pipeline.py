"""From raw documents to packed training sequences, by operators of ``vectable.llm``.

``STAGES`` are applied in order. Each takes ``(spark, docs, sf_dir)``; its result is written as
Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm.jaccard_join import one_of_each_class
from vectable.llm.language_id import UNDETERMINED, fit_languages, with_language
from vectable.llm.line_dedup import drop_repeated_lines
from vectable.llm.mixing import mix
from vectable.llm.packing import pack
from vectable.llm.scratch import kept

LEAST_SCORE = 0.4  # texts in two languages pass


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those of which no language is likelier than ``LEAST_SCORE``."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    names = {"lang_pred": "_lang_pred", "score": "_score", "ambiguous": "_ambiguous"}
    judged = with_language(docs, fit_languages(docs, ~held_out), **names)
    known = (F.col("_lang_pred") != UNDETERMINED) & (F.col("_score") >= LEAST_SCORE)
    return judged.where(known).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold go."""
    clean = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast("long"))
    return clean.select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with similar five-word shingles one stays."""
    return one_of_each_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn towards the tempered shares of sources, languages and topics."""
    return mix(docs, languages=None).where("sampled").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get a place in a sequence of at most 4096."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir))
    return docs
