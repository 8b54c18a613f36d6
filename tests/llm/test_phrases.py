"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER
from llm_fixtures import none, odd, sf  # noqa: F401

from vectable.llm import collocations
from vectable.llm.collocations import phrases, top_phrases
from vectable.llm.queries import QUERIES
from vectable.llm.scratch import kept


def mined(rows, max_words=3, min_count=10, percent=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    candidates = {p for p, a in counts.items() if a >= min_count and len(p[1]) > 1}
    inside = set()
    for lang, words in candidates:
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = lang, words[i : i + size]
                if 100 * counts[lang, words] >= percent * counts[part]:
                    inside.add(part)
    found = []
    for lang, words in candidates - inside:
        a, cuts = counts[lang, words], []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.append((lang, " ".join(words), a, l, r, totals[lang], score))
    return found


def ranked(found, top):
    out = []
    for lang in {f[0] for f in found}:
        own = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))
        out += [(lang, k, *f[1:]) for k, f in enumerate(own[:top], 1)]
    return sorted(out)


def rows_of(found, top=10**6):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in top_phrases(found, top).collect())


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "b", "cé", "d-d", "e e", "日本", "x'"]
    for _ in range(n):
        yield "".join(
            rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", ""]) for _ in range(40)
        )


@pytest.mark.parametrize(("max_words", "bound"), [(2, 0), (4, 0), (4, collocations.BROADCAST_KEYS)])
def test_every_phrase_is_counted(spark, max_words, bound):
    """Looked up in a broadcast table, and by the shuffled join beyond its bound."""
    rows = [(random.Random(i).choice(["en", "de", None, "und"]), t) for i, t in enumerate(texts(3, 60))]
    rows += [("en", "tick tock " * 300), ("en", "tick tock " * 300), ("de", ""), (None, None)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = phrases(df, max_words=max_words, broadcast_keys=bound)
    assert rows_of(found, 50) == ranked(mined(rows, max_words), 50)


def test_occurrences_are_never_shuffled(spark, monkeypatch):
    """Beyond the bound of the broadcast table every occurrence was shuffled twice."""
    plans = []

    def spied(df, *codec):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return kept(df, *codec)

    monkeypatch.setattr(collocations, "kept", spied)
    monkeypatch.setattr(collocations, "MARK", 15)  # 32,768 bits: some that no phrase of three set are met
    rows = [("en", t) for t in texts(5, 60)]
    found = phrases(spark.createDataFrame(rows, "lang string, text string"), max_words=3, broadcast_keys=0)
    assert rows_of(found, 50) == ranked(mined(rows, 3), 50)
    relations = [plan for columns, plan in plans if "at" in columns]
    assert len(relations) == 2 and not any("Exchange" in plan for plan in relations)


def test_phrases_that_share_a_name_get_another_seed(spark, monkeypatch):
    plain, calls = collocations.phrase_name, []

    def weak(left, right, seed):
        calls.append(seed)
        return plain(left, right, seed) & (-1 if seed else 3)

    rows = [("en", "so it is " * 20), ("en", "but we are not " * 4)]
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "phrase_name", weak)
    assert rows_of(phrases(df, broadcast_keys=0)) == ranked(mined(rows), 10**6)


def test_name_and_first_part_give_the_last_part():
    left, right = np.random.default_rng(1).integers(-(2**63), 2**63, (2, 1000))
    for seed in (0, 5):
        name = collocations.phrase_name(left, right, seed)
        assert (collocations.last_part(name, left, seed) == right).all()


def test_rows_of_a_relation_are_short_and_cut_at_gaps_only():
    """One row a document made batches of all words of 10,000 documents, however long they are."""
    rng = np.random.default_rng(0)
    at = np.cumsum(rng.choice([1, 1, 1, 1, 2], 5000)).astype(np.int32)
    flow = np.arange(at[-1] + 2, at[-1] + 302, dtype=np.int32)  # a piece of 300 words
    row = np.repeat([0, 1, 2, 3], [2000, 3000, 300, 1])
    words = collocations.Occurrences(row, np.concatenate([at, flow, [7]]), rng.integers(0, 9, 5301))
    found = collocations._as_batch(words, np.array([5, 6, 7, 8]))
    sizes = [len(x) for x in found.column("at")]
    assert sorted(sizes)[-1] == 300 and sorted(sizes)[-2] < 2 * collocations.ROW
    assert len(sizes) <= 4 + 5301 / (collocations.ROW / 2)
    (again, docs), = collocations._flat([found])
    assert (docs[again.row] == np.array([5, 6, 7, 8])[row]).all()
    assert (again.at == words.at).all() and (again.phrase == words.phrase).all()
    for x, y in zip(again.merged()[1:], words.merged()[1:], strict=True):
        assert (x == y).all()
    nothing = collocations._as_batch(words.where(np.zeros(5301, bool)), docs)
    assert nothing.num_rows == 0 and list(collocations._flat([nothing])) == []


def test_counted_pairs_are_sent_in_small_batches():
    phrase = pa.array([list(range(200_000))], pa.list_(pa.int64()))
    at = pa.array([list(range(200_000))], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), at, phrase], ["doc", "at", "phrase"])
    for run in (collocations._pairs_counted(0), collocations._merged_rows(0)):
        sizes = [x.num_rows for x in run([batch])]
        assert sum(sizes) == 199_999 and max(sizes) <= 1 << 16


def test_odd_texts(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(phrases(odd, min_count=2)) == ranked(mined(rows, min_count=2), 10**6)
    assert phrases(none).count() == 0
    empty = phrases(spark.createDataFrame([("en", " . "), ("en", None)], "lang string, text string"))
    assert top_phrases(empty, 5).count() == 0


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    plain = collocations._language_keys
    calls = []

    def weak(languages, seed):
        calls.append(seed)
        return plain(["same"] * len(languages), 0) if seed == 0 else plain(languages, seed)

    rows = [("en", "so it is " * 20), ("de", "so it was " * 20)]
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "_language_keys", weak)  # both languages' "so" share a hash
    assert rows_of(phrases(df)) == ranked(mined(rows), 10**6)


def test_scores_pass_64_bits(spark):
    a, l, r = 9_007_199_254_740_993, 9_007_199_254_740_997, 9_007_199_254_740_995
    row = spark.createDataFrame([(a, [l], [r])], "n long, firsts array<long>, lasts array<long>")
    assert row.select(collocations._cut().alias("cut")).first().cut.score == 1_000_000 * a * a // (l * r)


def test_the_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = QUERIES["op11_phrase_collocations"](spark, sf).collect()
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in columns) for r in found) == ranked(mined([(r.lang, r.text) for r in docs]), 2000)
