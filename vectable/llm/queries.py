"""The registered queries of the training-data operators, each over its whole table.

``queries`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` has the DuckDB SQL of
those that SQL expresses.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm.collocations import phrases, top_phrases
from vectable.llm.conversation_repair import digests, repair
from vectable.llm.epsilon_join import similar_vectors
from vectable.llm.html_extraction import fit_extractor, main_text
from vectable.llm.jaccard_join import similar_classes
from vectable.llm.language_id import fit_languages, with_language
from vectable.llm.line_dedup import drop_repeated_lines
from vectable.llm.mixing import mix
from vectable.llm.packing import pack
from vectable.llm.quality_rules import log_ratios, with_quality
from vectable.llm.rule_classifier import fit_rules, with_score
from vectable.llm.secret_scan import BASE_KINDS, joined, secret_spans
from vectable.llm.url_filter import mine_rules, path_of, with_verdict

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(_table(spark, sf_dir, "documents"))


def _remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor``: the folds of the labelled operators."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"), max_copies=None)
    return mixed.select("row.doc_id", "source", "lang", "topic", "n_tokens", "weight", "copies", "sampled")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder(4) == 2
    judged = with_language(docs.select("doc_id", "text"), fit_languages(docs, ~held_out))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ratios = log_ratios(docs, labels.where("quality = 1").select("doc_id"))
    judged = with_quality(docs.select("doc_id", "text"), ratios)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "score", "base_failed", "kept")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(_table(spark, sf_dir, "embeddings"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    text = main_text(fit_extractor(pages), F.col("html"))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = _remainder(3) == 1
    scored = with_score(docs.select("doc_id", "text"), fit_rules(docs, labels, ~held_out))
    return scored.select("row.doc_id", "score", "predicted").withColumn("held_out", held_out)


URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def document_of(url: Column) -> Column:
    """The id of the document that a page shows: the number after the language in its URL's path."""
    return F.regexp_extract(path_of(url), "^/[a-z]*/([0-9]+)", 1).try_cast("long")


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _table(spark, sf_dir, "pages").select("page_id", "url"), _table(spark, sf_dir, "labels")
    labelled = pages.withColumn("doc_id", document_of(F.col("url"))).join(labels, "doc_id")
    rules = mine_rules(labelled.select("url", (F.col("quality") == 0).alias("bad")))
    return with_verdict(pages, URL_RULES, rules).select("page.page_id", "host", "path", "rule", "verdict")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_phrases(phrases(_table(spark, sf_dir, "documents")), 2000)
    return top.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults by the checksum of conversation and turn."""
    space = F.lit(" ")
    spaced = {c: F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn", "role", "text")}
    key = F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])
    fault = (F.crc32(key.cast("binary")) % 20).alias("fault")
    kept = rows.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), fault)
    kept = kept.where("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("times"),
    )
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "copy")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    repaired = repair(damaged(given))
    every = given.select(F.col("conv_id").alias("own")).distinct()
    for found in (repaired.summary, digests(repaired)):
        every = every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        F.col("own").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_spans(F.col("text")).alias("found"))

    def of(kind: str) -> Column:
        return F.filter("found", lambda s: s["kind"] == kind)

    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": quality_rules,
    "op2_best_fit_packing": best_fit_packing,
    "op3_embedding_near_dedup": embedding_near_dedup,
    "op4_line_dedup": line_dedup,
    "op5_html_extraction": html_extraction,
    "op6_mixing": mixing,
    "op7_language_id": language_id,
    "op8_quality_classifier": quality_classifier,
    "op9_url_filters": url_filters,
    "op10_ngram_jaccard": ngram_jaccard,
    "op11_phrase_collocations": phrase_collocations,
    "op12_conversation_repair": conversation_repair,
    "op13_secret_scan": secret_scan,
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        repeated AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
        marked AS (
            SELECT k.doc_id, k.line, k.pos, r.key IS NULL AS stays FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    # Vectors in double precision; every pair of them is compared.
    "op3_embedding_near_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x for x in embedding if x <> 0]) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
               AND CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= 0.95),
        reached AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
        linked AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN linked ON vec_id = linked.a
    """,
    # The rules mined from the given pages at sf0.01 are none, so the method allows what no rule fits.
    "op9_url_filters": r"""
        WITH parsed AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        given(rule_host, rule_path, says) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        fitting AS (
            SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   max_by(says, length(rule_host || rule_path)) AS says
            FROM parsed JOIN given
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM parsed LEFT JOIN fitting USING (page_id)
    """,
    "op10_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_distinct([
                array_to_string(w[i:i + 4], ' ')
                for i in range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)]) AS s
            FROM words),
        shingles AS MATERIALIZED (SELECT doc_id, unnest(s) AS shingle FROM sets),
        numbered AS (SELECT shingle, row_number() OVER () AS number FROM shingles GROUP BY shingle HAVING count(*) > 1),
        repeated AS MATERIALIZED (SELECT doc_id, number FROM shingles JOIN numbered USING (shingle)),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM repeated x JOIN repeated y ON x.number = y.number AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sets p ON a = p.doc_id JOIN sets q ON b = q.doc_id
            WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM sets
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN least ON doc_id = a
    """,
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        numbered AS (SELECT lang, row_number() OVER () AS no, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        words AS (SELECT lang, no, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM numbered),
        chains AS (
            SELECT lang, word, lead(word, 1) OVER following AS second, lead(word, 2) OVER following AS third
            FROM words WINDOW following AS (PARTITION BY no ORDER BY pos)),
        grams AS (
            SELECT lang, 1 AS size, word AS phrase FROM chains
            UNION ALL SELECT lang, 2, word || ' ' || second FROM chains WHERE second IS NOT NULL
            UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third FROM chains WHERE third IS NOT NULL),
        f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(c) AS n FROM f WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND c >= 10),
        cuts AS (
            SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
        begun AS MATERIALIZED (
            SELECT cuts.*, f.c AS l FROM cuts JOIN f ON f.lang = cuts.lang AND f.phrase = first),
        parted AS (
            SELECT b.lang, b.size, b.phrase, a, k, l, f.c AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f.c) AS score
            FROM begun b JOIN f ON f.lang = b.lang AND f.phrase = rest),
        scored AS (
            SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        covered AS (
            SELECT DISTINCT s.lang, s.phrase
            FROM (SELECT lang, a, array_to_string(w[pos:pos + 1], ' ') AS part
                  FROM (SELECT lang, a, w, unnest([1, 2]) AS pos FROM candidates WHERE size = 3)) t
            JOIN candidates s ON s.lang = t.lang AND s.phrase = t.part AND 100 * t.a >= 50 * s.a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM scored ANTI JOIN covered USING (lang, phrase))
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
