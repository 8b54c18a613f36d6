"""Line dedup, the Jaccard join and the vector join against plain versions."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard_classes, line_dedup, similar_vectors
from llm_fixtures import none, odd  # noqa: F401
from pyspark.sql import functions as F

from vectable.llm import epsilon_join, jaccard_join
from vectable.llm.components import components
from vectable.llm.line_dedup import LineRuns, drop_repeated_lines, merge_runs, ordered_scans
from vectable.llm.scratch import forget, kept


def some(rows):
    return sorted(rows, key=repr)


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 5), (9, 8), (7, 8), (3, 1), (None, 4)] + [(i, i + 1) for i in range(100, 160)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert some(map(sorted, groups.values())) == some([[1, 2, 3], [7, 8, 9], list(range(100, 161))])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines_of_odd_texts(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = drop_repeated_lines(odd, min_docs=3, n_lines="before", n_dropped="gone")
    assert some((r.doc_id, r.text, r.before, r.gone) for r in found.collect()) == some(line_dedup(rows, 3))
    assert found.columns[: len(odd.columns)] == odd.columns
    named = drop_repeated_lines(odd, min_docs=3)  # n_lines is a column of the input, and replaced
    assert named.columns == [*odd.columns, "n_dropped"] and dict(named.dtypes)["n_lines"] == "bigint"


def test_lines_of_an_empty_table(none):
    assert drop_repeated_lines(none).count() == 0


def test_lines_by_batches_and_levels(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(f"Line {rng.randint(0, 40) ** 2 // 40} " for _ in range(6))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = some(line_dedup(rows))
    for batches, fan_in in ((1, 2), (5, 2), (7, 3)):
        found = drop_repeated_lines(df, batches=batches, fan_in=fan_in).collect()
        assert some((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found) == expected


def test_runs_are_merged_by_level(spark):
    runs = LineRuns(spark, enough=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(i, 0), (100, 0)], "h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [r.h1 for r in runs.repeated().collect()] == [100]
    with pytest.raises(ValueError):
        LineRuns(spark, 2, fan_in=1)


def family(rng, n, words, change):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    for _ in range(n):
        yield " ".join(w if rng.random() > change else f"x{rng.randint(0, 10**6)}" for w in base)


def test_jaccard_of_odd_texts(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = jaccard_join.similar_classes(odd).collect()
    assert some((r.doc_id, r.n_shingles, r.component_id) for r in found) == some(jaccard_classes(rows))


def test_jaccard_of_an_empty_table(none):
    assert jaccard_join.similar_classes(none).count() == 0
    assert jaccard_join.one_of_each_class(none).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_of_families(spark, monkeypatch, small):
    """Copies, chains, pairs near the bound, families that share passages and short texts."""
    if small:  # many lists are long, and groups are cut
        monkeypatch.setattr(jaccard_join, "SHORT_LIST", 3)
        monkeypatch.setattr(jaccard_join, "TOKENS_IN_GROUP", 300)
        monkeypatch.setattr(jaccard_join, "TOKENS_AT_ONCE", 2000)
    rng = random.Random(7)
    texts = []
    for change in (0.0, 0.005, 0.01, 0.03, 0.06):
        texts += family(rng, 25, 80, change)
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{passage} " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(k)) for k in range(0, 40, 2)]
    texts += [f"{rng.randint(0, 3)} {rng.randint(0, 2)}" for _ in range(20)] + [None, "", "Ab ab"]
    chain = [f"c{i}" for i in range(100)]
    texts += [" ".join(chain[k : k + 60]) for k in range(0, 40, 3)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard_join.similar_classes(df).collect()
    expected = jaccard_classes(rows)
    assert some((r.doc_id, r.n_shingles, r.component_id) for r in found) == some(expected)
    stay = [r.doc_id for r in jaccard_join.one_of_each_class(df).collect()]
    assert sorted(stay) == sorted(i for i, _, c in expected if i == c)


def test_jaccard_in_small_buckets_and_batches(spark, monkeypatch):
    """Families whose lists, pairs and texts are worked on a few at once."""
    small = {"LISTED_AT_ONCE": 900, "TOKENS_IN_BUCKET": 500, "TOKENS_IN_BATCH": 40, "PAIRS_AT_ONCE": 60, "TEXT_AT_ONCE": 700}
    for name, value in (small | {"SHORT_LIST": 4, "TOKENS_AT_ONCE": 3000}).items():
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(11)
    texts = [text for change in (0.0, 0.01, 0.04) for text in family(rng, 30, 70, change)]
    texts += [" ".join(f"t{rng.randint(0, 10**6)}" for _ in range(50)) for _ in range(20)] + [None, "", "a"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard_join.similar_classes(df).collect()
    assert some((r.doc_id, r.n_shingles, r.component_id) for r in found) == some(jaccard_classes(rows))


def test_tokens_seen_often():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 1000):
        tokens = rng.integers(0, 1 + n // 3, n).astype(np.uint64)
        values, counts = np.unique(tokens, return_counts=True)
        often = counts >= jaccard_join.MIN_SEEN
        found, seen = jaccard_join._often(tokens)
        assert found.tolist() == values[often].tolist() and seen.tolist() == counts[often].tolist()


def peak_mb(work):
    tracemalloc.start()
    try:
        found = work()
        return found, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_first_tokens_do_not_hold_their_sets():
    order = jaccard_join.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    prefix, _ = order.first(np.arange(1000, dtype=np.uint64), 75)
    assert len(prefix) < 300 and prefix.base is None


def test_lists_are_sent_a_few_at_once():
    tokens = np.arange(200_000, dtype=np.uint64)
    sent = list(jaccard_join._packed([(tokens, 5, 5, len(tokens), 0)], 400, False))
    assert len(sent) > 1 and max(batch.nbytes for batch in sent) < 3e6
    assert sum(len(x) for batch in sent for x in batch.column("token").to_pylist()) == 8 * len(tokens)


def test_pairs_of_a_bucket_are_summed_as_they_are_found():
    """Half a million entries in lists of sixteen show 3.75 million pairs of the same 16 documents."""
    lists = 500_000 // jaccard_join.SHORT_LIST
    held = [(np.arange(lists, dtype=np.uint64), k, k, lists, 0) for k in range(jaccard_join.SHORT_LIST)]
    table = pa.Table.from_batches(list(jaccard_join._packed(held, 1, False)))
    found, peak = peak_mb(lambda: jaccard_join._stars(75)(table))
    assert set(found.column("shared").to_pylist()) == {lists} and found.num_rows == 16 * 15 // 2
    assert peak < 200


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def as_rows(df):
    return some((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0])]
    rows += [(8, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [2.0, 4.0]), (10, [-1.0, -2.0]), (11, [1e200, 2e200]), (12, [1.0, 2.0, 3.0])]
    rows += [(13, [1e-200, 2e-200]), (14, [0.0, 1.0]), (15, [-0.0, 1.0])]
    plain = [r for r in rows if r[0] not in (11, 13)]
    assert as_rows(epsilon_join.similar_vectors(vectors_of(spark, plain))) == some(similar_vectors(plain))
    found = {r.vec_id: r for r in epsilon_join.similar_vectors(vectors_of(spark, rows).withColumn("n_links", F.lit(0))).collect()}
    assert found[11].n_links == found[13].n_links == 5 and found[13].component_id == 7
    assert epsilon_join.similar_vectors(vectors_of(spark, [])).count() == 0


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(epsilon_join, "BLOCK", 40)
    monkeypatch.setattr(epsilon_join, "LEAF", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 10))
    points = centres[rng.integers(0, 12, 260)] + rng.normal(size=(260, 10)) * rng.choice([0.05, 0.25], (260, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[5][1]) for i in range(90)]  # a third are copies
    assert as_rows(epsilon_join.similar_vectors(vectors_of(spark, rows))) == some(similar_vectors(rows))


def test_blocks_are_not_shuffled_for_the_blocks_that_they_meet(spark, monkeypatch):
    """Copies meet in one node over batches and tasks; floats stay floats."""
    monkeypatch.setattr(epsilon_join, "BLOCK", 8)
    plans = {}

    def spied(df):
        plans[tuple(df.columns)] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df)

    monkeypatch.setattr(epsilon_join, "kept", spied)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 6))
    points = (centres[rng.integers(0, 5, 60)] + rng.normal(size=(60, 6)) * 0.1).astype(np.float32).astype(float)
    points = np.vstack([points, points[:7].repeat(5, 0)])
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    few = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(few)
    spark.conf.set(few, "3")
    try:
        found = as_rows(epsilon_join.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    finally:
        spark.conf.set(few, before)
    assert found == some(similar_vectors(rows))
    assert "Exchange hashpartitioning" not in plans["node", "links", "other"]
    assert "Exchange rangepartitioning" in plans["block", "low", "high", "nodes", "copies", "vectors"]


def test_scratch_tables_can_be_forgotten(spark):
    table = kept(spark.range(3).groupBy("id").count())
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    forget(table)
    assert not folder.exists()


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(5)
    rows = []
    for dim, n in ((3, 30), (8, 40), (5, 20), (1, 4)):
        centres = rng.normal(size=(4, dim))
        points = centres[rng.integers(0, 4, n)] + rng.normal(size=(n, dim)) * 0.1
        rows += [(len(rows) + i, p.tolist()) for i, p in enumerate(points)]
    rows += [(500, rows[0][1]), (501, rows[75][1]), (502, None), (503, [0.0] * 8)]
    expected = similar_vectors(rows)
    assert sum(n > 0 for _, n, _, _ in expected) > 60
    assert as_rows(epsilon_join.similar_vectors(vectors_of(spark, rows))) == some(expected)


def test_runs_are_neither_sorted_nor_shuffled_where_they_are_read(spark):
    runs = LineRuns(spark, enough=2)
    for i in range(3):
        runs.add(spark.createDataFrame([(i, 0), (100, 0), (7, i)], "h1 long, h2 long"))
    first, second = runs.runs()
    batch = spark.createDataFrame([(1, 1), (2, 0)], "h1 long, h2 long")
    with ordered_scans(spark):
        unseen = runs.unseen(batch)._jdf.queryExecution().executedPlan().toString()
        merged = merge_runs([first, second])._jdf.queryExecution().executedPlan().toString()
    assert unseen.count("SortMergeJoin") == 2 and unseen.count("Sort [") == unseen.count("Exchange ") == 1  # the batch
    assert "SortMergeJoin" in merged and "Sort [" not in merged and "Exchange " not in merged
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    assert spark.conf.get(name) == "false"


def test_a_line_of_every_document_is_not_shuffled_to_one_task(spark):
    rows = [(i, f"always\nline {i % 9}\nonly {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = drop_repeated_lines(df)
    assert some((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()) == some(line_dedup(rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2


@pytest.mark.parametrize("room", [0, 1, 5, 60, 10**6])
def test_the_frequent_tokens_are_bounded_and_the_most_frequent(spark, monkeypatch, room):
    monkeypatch.setattr(jaccard_join, "FREQUENT_TOKENS", room)
    rng = random.Random(2)
    seen = {rng.getrandbits(63) - 2**62: 1 + i // 10 for i in range(100)}
    rows = spark.createDataFrame([(t, n) for t, n in seen.items()] + [(None, None)], "token long, seen long")
    token, count = jaccard_join._order(spark, rows).value
    assert len(token) <= room and len(token) >= min(room, 100) - 2
    assert all(seen[t] == n for t, n in zip(token.view(np.int64).tolist(), count.tolist(), strict=True))
    assert not len(token) or min(count) >= sorted(seen.values())[-len(token)]


def test_copies_and_components_of_a_third_of_the_rows(spark):
    rng = random.Random(3)
    rows = [(i, "one text that most of the rows hold as it is") for i in range(60)]
    rows += [(100 + i, text) for i, text in enumerate(family(rng, 60, 60, 0.01))]
    rows += [(200 + i, " ".join(f"a{i}b{k}" for k in range(9))) for i in range(60)]
    rows += [(300 + i, "") for i in range(20)] + [(None, None)] * 20 + [(7, rows[0][1]), (7, "another"), (7, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similar_classes(df).collect()
    assert some((r.doc_id, r.n_shingles, r.component_id) for r in found) == some(jaccard_classes(rows))
    stay = jaccard_join.one_of_each_class(df).collect()
    assert some((r.doc_id, r.text) for r in stay if r.doc_id == 7) == some(
        [(7, "another"), (7, None), (7, rows[0][1])]
    )
    assert sum(r.doc_id is None for r in stay) == 1 and sum(r.doc_id == 0 for r in stay) == 1
