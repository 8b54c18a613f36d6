"""URL verdicts from given host and path rules, and from mined association rules.

Spark's FP-growth mines which combinations of URL tokens go with a bad label. It is given only the
tokens that can add to a combination: tokens that are rules by themselves, tokens too rare with the
label and all but one of the tokens that occur in the same rows are taken out before. Rules below
the support and confidence asked for are pruned, and so are rules that a shorter one covers, on
Spark and before any is collected. A rule is filed under one of its tokens, the one with the fewest rules; a URL looks up its tokens and
checks only the rules found there.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import product
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.scratch import kept

BAD = "label=bad"
MAX_RULES = 200_000  # what every worker can hold
LEAST_BAD = 5  # bad rows of a rule, whatever share of the labelled rows they are
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, CAPITALS, CAPITALS.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, parts of the path (numbers alike), names in the query."""
    host = F.transform(F.split(host_of(url), r"\."), lambda t: F.concat(F.lit("host="), t))
    parts = F.split(F.regexp_replace(F.lower(path_of(url)), "[0-9]+", "0"), r"[/._-]")
    path = F.transform(parts, lambda t: F.concat(F.lit("path="), t))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1), "&")
    names = F.transform(query, lambda t: F.concat(F.lit("query="), F.substring_index(t, "=", 1)))
    useful = F.filter(F.concat(host, path, names), lambda t: ~F.endswith(t, F.lit("=")))
    return F.array_distinct(useful)


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.002,
    min_confidence: float = 0.7,
    url_column: str = "url",
    bad_column: str = "bad",
    least_bad: int = LEAST_BAD,
) -> list[tuple[str, ...]]:
    """All token combinations that go with ``bad`` and have no smaller part that does.

    Rows with a null url or label aren't used. A combination holds in at least ``min_support`` of the
    labelled rows together with ``bad``, in ``least_bad`` of them however few are labelled, and
    ``min_confidence`` of the rows that have it are bad. No labelled row, no rule. More than
    ``MAX_RULES`` of them are an error: none is left out.
    """
    usable = labelled.where(F.col(url_column).isNotNull() & F.col(bad_column).isNotNull())
    rows = usable.select(F.col(bad_column).alias("bad"), url_tokens(F.col(url_column)).alias("tokens"))
    rows = kept(rows.where(F.col("bad") | (F.size("tokens") > 0)).withColumn("row", F.monotonically_increasing_id()))
    total = rows.count()
    needed = max(math.ceil(min_support * total), least_bad, 1)
    if needed > total:
        return []
    classes = kept(_token_classes(rows, needed, min_confidence))
    alone = classes.where("sure").select(F.explode("members").alias("token"))
    found = [(r["token"],) for r in alone.limit(MAX_RULES + 1).collect()]
    together = _mined_together(rows, classes.where("NOT sure"), needed, min_confidence)
    if together is not None:
        heads = [r["tokens"] for r in together.limit(MAX_RULES + 1).collect()]
        _check_number(len(found) + len(heads))
        named = together.select(F.explode("tokens").alias("head")).distinct()
        members = {r["head"]: r["members"] for r in classes.join(named, "head").collect()}
        choices = [[members[head] for head in rule] for rule in heads]
        _check_number(len(found) + sum(math.prod(len(m) for m in rule) for rule in choices))
        found += [tuple(sorted(each)) for rule in choices for each in product(*rule)]
    _check_number(len(found))
    return sorted(found, key=lambda r: (len(r), r))


def _check_number(rules: int) -> None:
    if rules > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules that no shorter one covers: ask for more support or confidence")


def _surely(n_bad: str, n: str, min_confidence: float) -> Column:
    return F.col(n_bad).cast("double") / F.col(n).cast("double") >= min_confidence


def _token_classes(rows: DataFrame, needed: int, min_confidence: float) -> DataFrame:
    """``head, members, sure``: tokens that are often enough in bad rows, those of the same rows together.

    Two tokens are in the same rows if the sums of two 64-bit hashes of the rows' numbers agree. A
    class is at most as large as one row. ``sure`` ones are rules by themselves.
    """
    marks = [F.xxhash64("row", F.lit(seed)).cast("decimal(38,0)").alias(f"mark{seed}") for seed in (1, 2)]
    each = rows.select("bad", *marks, F.explode("tokens").alias("token"))
    tokens = each.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count_if("bad").alias("n_bad"),
        F.sum("mark1").alias("mark1"),
        F.sum("mark2").alias("mark2"),
    )
    frequent = tokens.where(F.col("n_bad") >= needed)
    same = frequent.groupBy("n", "n_bad", "mark1", "mark2").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return same.select(F.col("members")[0].alias("head"), "members", _surely("n_bad", "n", min_confidence).alias("sure"))


def _mined_together(rows: DataFrame, classes: DataFrame, needed: int, min_confidence: float) -> DataFrame | None:
    """Rules of two or more class heads, as sorted ``tokens``; None if no rows could hold one.

    A token that is a rule by itself covers every combination with it, and of tokens in the same rows
    one stands for all: a shortest rule never has two of them.
    """
    heads = classes.select(F.col("head").alias("token"))
    if heads.count() <= MAX_RULES:
        heads = F.broadcast(heads)
    left = rows.select("row", "bad", F.explode("tokens").alias("token")).join(heads, "token")
    label = F.when(F.first("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    items = left.groupBy("row").agg(F.concat(F.collect_list("token"), label).alias("items")).select("items")
    items = kept(items)
    held = items.count()
    if held < needed:
        return None
    # Spark rounds support times rows up: half a row less is safe from rounding.
    model = FPGrowth(itemsCol="items", minSupport=(needed - 0.5) / held).fit(items)
    sets = kept(model.freqItemsets.select(F.array_sort("items").alias("tokens"), "freq"))
    with_bad = sets.where(F.array_contains("tokens", BAD) & (F.size("tokens") > 1))
    with_bad = with_bad.select(F.array_remove("tokens", BAD).alias("tokens"), F.col("freq").alias("n_bad"))
    # A combination is at least as frequent without the label, so every one has its partner.
    counted = with_bad.join(sets.where(~F.array_contains("tokens", BAD)), "tokens")
    return kept(_shortest(counted.select("tokens", _surely("n_bad", "freq", min_confidence).alias("rule"))))


def _shortest(combinations: DataFrame) -> DataFrame:
    """The ``tokens`` of rules of which no smaller part is a rule.

    ``combinations`` has sorted ``tokens`` and whether they are a ``rule``, and with a combination all
    its parts. A combination is settled if it is a rule or a part of it is settled: level by level, by
    its parts of one token less.
    """
    spark = combinations.sparkSession
    combinations = kept(combinations)
    longest = combinations.agg(F.max(F.size("tokens"))).first()[0] or 0
    shortest = spark.createDataFrame([], "tokens array<string>")
    settled = None
    for size in range(1, longest + 1):
        level = combinations.where(F.size("tokens") == size)
        if settled is None:
            level = level.withColumn("covered", F.lit(False))
        else:
            less = F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t)))
            parts = level.select("tokens", less.alias("part"))
            covered = parts.join(settled.withColumnRenamed("tokens", "part"), "part", "left_semi")
            covered = covered.select("tokens").distinct().withColumn("covered", F.lit(True))
            level = level.join(covered, "tokens", "left").select("tokens", "rule", F.coalesce("covered", F.lit(False)).alias("covered"))
        level = kept(level)
        shortest = shortest.unionByName(level.where("rule AND NOT covered").select("tokens"))
        settled = level.where("rule OR covered").select("tokens")
    return shortest


def inverted(rules: Sequence[tuple[str, ...]]) -> dict[str, list[frozenset]]:
    """Every rule under its token that occurs in the fewest rules."""
    uses = Counter(token for rule in rules for token in rule)
    index: dict[str, list[frozenset]] = {}
    for rule in rules:
        index.setdefault(min(rule, key=lambda t: (uses[t], t)), []).append(frozenset(rule))
    return index


def with_verdict(
    pages: DataFrame,
    given: Sequence[tuple[str, str, str]],
    mined: Sequence[tuple[str, ...]],
    url_column: str = "url",
) -> DataFrame:
    """``pages`` as a struct ``page``, with ``host, path, rule, verdict``.

    ``given`` has ``(host, path, verdict)``; one fits its host and all subdomains if the URL's path
    starts with the rule's, and the longest wins; ``rule`` is its host and path, else null. Without a
    fitting rule a URL is blocked if it has all tokens of a mined rule, else allowed. Null URLs and
    those without ``://`` have an empty host and path, fit no rule and are allowed unless their
    tokens match. Every row is judged by its URL alone.
    """
    index = pages.sparkSession.sparkContext.broadcast(inverted(mined))  # at most MAX_RULES rules

    @F.arrow_udf("boolean")
    def matches(column: pa.Array) -> pa.Array:
        table = index.value
        held = []
        for tokens in column.to_pylist():
            own = set(tokens)
            held.append(any(rule <= own for t in tokens if t in table for rule in table[t]))
        return pa.array(held, pa.bool_())

    page = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"))
    url = F.col(f"page.`{url_column}`")
    parsed = page.select("page", host_of(url).alias("host"), path_of(url).alias("path"), url_tokens(url).alias("tokens"))
    rule = F.lit(None).cast("string")
    verdict = F.when(matches("tokens"), "block").otherwise("allow") if mined else F.lit("allow")
    for host, path, says in sorted(given, key=lambda r: len(r[0]) + len(r[1])):
        own = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
        fits = own & F.startswith("path", F.lit(path))
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return parsed.select("page", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
