"""Packing, mixing, the stages and the registered queries."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import best_fit_count
from llm_fixtures import none, odd, sf  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from oracle import differences, duck
from vectable.llm import queries
from vectable.llm.mixing import _unit, _word_counts, fit_topics, mix, reached, tempered
from vectable.llm.packing import CapacityTree, UnitEncoder, best_fit_plan, pack
from vectable.llm.queries import ORACLES, QUERIES
from vectable.llm.rolling import slices
from vectable.llm.worker import give_back

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            yield i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def check_packing(found, capacity):
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) == best_fit_count([r.length for r in found], capacity)


@pytest.mark.parametrize("capacity", [7, 64, 4096])
def test_packing_of_odd_texts(odd, capacity):
    found = pack(odd, PATH, capacity, with_ids=True).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    expected = sorted(plain_pieces(rows, capacity), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == expected
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    check_packing(found, capacity)


def test_units_are_encoded_in_bounded_runs_by_one_thread(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    encoder, runs = UnitEncoder(PATH), []
    plain = encoder.tokenizer

    class Counting:
        def encode_batch_fast(self, units, **options):
            runs.append(len(units))
            return plain.encode_batch_fast(units, **options)

    encoder.tokenizer = Counting()
    text = " ".join(f"w{i}" for i in range(10_000))
    [ids] = encoder.encode(next(slices(pa.array([text]))))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert sum(runs) == 10_000 and max(runs) <= 4096 and os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_a_worker_gives_freed_memory_back():
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024

    blocks = [bytes(1000) for _ in range(200_000)]
    last = bytes(1000)  # what lies behind them stays
    full = held()
    del blocks
    give_back()
    assert last and held() < full - 150


def test_packing_of_documents(spark, sf, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    expected = sorted(plain_pieces([(r.doc_id, r.text) for r in docs.collect()], 4096))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    check_packing(found, 4096)
    assert pack(none, PATH).count() == 0


def test_plan_equals_one_by_one():
    rng = np.random.default_rng(0)
    for _ in range(200):
        capacity = int(rng.integers(2, 50))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 90)))
        counts = dict(zip(*np.unique(lengths, return_counts=True), strict=True))
        plan = best_fit_plan({int(k): int(v) for k, v in counts.items()}, capacity)
        taken = set()
        for length, count in counts.items():
            own = plan[plan[:, 0] == length]
            for number in range(count):
                _, first, per, sequence, offset = own[np.searchsorted(own[:, 1], number, side="right") - 1]
                step = number - first
                at = offset + step % per * length
                cells = {(sequence + step // per, at + k) for k in range(length)}
                assert not cells & taken and at + length <= capacity
                taken |= cells
        assert len({s for s, _ in taken}) == best_fit_count(lengths.tolist(), capacity)


def test_capacity_tree():
    tree = CapacityTree(10)
    assert tree.tightest(1) is None
    tree.mark(4, True)
    tree.mark(10, True)
    assert [tree.tightest(n) for n in (1, 4, 5, 10)] == [4, 4, 10, 10]
    tree.mark(4, False)
    assert tree.tightest(1) == 10


def raked(sums, powers):
    """Weights per cell of a token table of any dimensions, fitted margin by margin."""
    table = sums / sums.sum()
    fitted = table.copy()
    for _ in range(2000):
        for axis, power in enumerate(powers):
            others = tuple(k for k in range(table.ndim) if k != axis)
            factor = tempered(table.sum(others), power) / fitted.sum(others)
            fitted = fitted * factor.reshape([-1 if k == axis else 1 for k in range(table.ndim)])
    return np.divide(fitted, table, out=np.zeros_like(table), where=table > 0)


def test_mixture_meets_its_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mix(docs, 0.5, 0.7, 0.8, max_copies=50).cache()
    rows = mixed.select("row.doc_id", "source", "lang", "topic", "n_tokens", "weight", "copies", "sampled").toPandas()
    total = rows.n_tokens.sum()
    weighted = rows.n_tokens * rows.weight
    assert np.isclose(weighted.sum(), total)
    for column, power in (("source", 0.5), ("lang", 0.7), ("topic", 0.8)):
        share = rows.groupby(column).n_tokens.sum() / total
        assert np.allclose(weighted.groupby(rows[column]).sum() / total, tempered(share, power), atol=1e-5)
        drawn = {r[column]: r for r in reached(mixed, column).collect()}
        for name, part in rows.groupby(column):
            assert np.isclose(drawn[name].corpus, share[name])
            assert np.isclose(drawn[name].target, (part.n_tokens * part.weight).sum() / total)
            assert np.isclose(drawn[name].drawn, (part.n_tokens * part.copies).sum() / (rows.n_tokens * rows.copies).sum())
    cells = [rows[c].astype("category").cat for c in ("source", "lang", "topic")]
    sums = np.zeros([len(c.categories) for c in cells])
    np.add.at(sums, tuple(c.codes.to_numpy() for c in cells), rows.n_tokens)
    plain = raked(sums, (0.5, 0.7, 0.8))
    assert np.allclose(plain[tuple(c.codes.to_numpy() for c in cells)], rows.weight, rtol=1e-3)
    assert (rows.copies - rows.weight).abs().max() < 1 and (rows.sampled == (rows.copies > 0)).all()
    assert abs(rows.copies.mean() - rows.weight.mean()) < 0.1
    once = mix(docs, 0.5, 0.7, 0.8).select("row.doc_id", "copies").toPandas()
    assert dict(once.values) == {i: min(c, 1) for i, c in zip(rows.doc_id, rows.copies, strict=True)}
    half = mix(docs, 0.5, 0.7, 0.8, rate=0.5, max_copies=50).agg(F.sum(F.col("copies") * F.col("n_tokens"))).first()[0]
    assert abs(half / total - 0.5) < 0.15
    mixed.unpersist()


@pytest.mark.parametrize("power", [0.95, 0.5])
def test_a_tiny_class_leaves_the_others_alone(spark, power):
    rows = [(i, "some equal words", "big", "en") for i in range(2000)]
    docs = spark.createDataFrame([*rows, (2000, "one", "tiny", "xx")], "doc_id long, text string, source string, lang string")
    found = mix(docs, power, power, power).select("row.doc_id", "weight", "sampled").toPandas().set_index("doc_id")
    tiny = tempered([6000, 1], power)[1]
    assert found.sampled[2000] and found.sampled[:2000].mean() > 1 - tiny - 0.01
    assert np.isclose(found.weight[0], (1 - tiny) / (6000 / 6001), atol=1e-4)


def test_the_query_draws_as_often_as_weights_say(spark, tmp_path, monkeypatch):
    """Documents that need more than four copies were drawn four times."""
    rows = [(i, "some equal words", "big", "en") for i in range(400)] + [(400, "one", "tiny", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "mix", lambda docs, **given: mix(docs, 0.5, 0.5, 0.5, **given))
    found = QUERIES["op6_mixing"](spark, str(tmp_path)).toPandas().set_index("doc_id")
    assert found.weight[400] > 10 and (found.copies - found.weight).abs().max() < 1


def test_topics_are_what_texts_are_about(spark):
    draw = np.random.default_rng(3)
    kinds, rows = {}, []
    for i in range(400):
        lang, kind = ("en", "de")[i % 2], (i // 2) % 3
        own = [f"{lang}{x}" for x in draw.integers(0, 30, 40)]  # words of the language, in all its texts
        about = [f"name{kind}_{x}" for x in draw.integers(0, 20, 40)]  # names and numbers, alike in both
        kinds[i] = kind
        rows.append((i, " ".join(draw.permutation(own + about)), "s", lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    topic = {r.doc_id: r.topic for r in mix(docs, topics=3).select("row.doc_id", "topic").collect()}
    assert len({(kinds[i], topic[i]) for i in kinds}) == 3 == len(set(topic.values()))
    part = {r.doc_id: r.topic for r in mix(docs, topics=3, topic_sample=150).select("row.doc_id", "topic").collect()}
    assert len({(kinds[i], part[i]) for i in kinds}) == 3  # all rows get a topic, learnt from some
    equal = docs.withColumn("text", F.lit("the same words"))
    assert {r.topic for r in mix(equal).collect()} == {0}


def test_topics_of_a_repeated_id(spark):
    rows = [(7, f"copy {i % 5} of a row", "s", "en") for i in range(300)] + [(i, f"other text {i}", "s", "en") for i in range(600, 1200)]
    texts = spark.createDataFrame(rows, "id long, text string, source string, lang_class string")
    whole = fit_topics(texts, sample=10_000)
    once = fit_topics(texts.dropDuplicates(["id"]), sample=10_000)
    assert whole.weights.shape == once.weights.shape and len(whole.centres) == len(once.centres) == 8
    assert fit_topics(texts.where("false")) is None and fit_topics(texts.withColumn("text", F.lit(" "))) is None


def test_topics_are_learnt_from_all_documents(spark):
    n, draw = 12_000, np.random.default_rng(5)
    lists = [[f"{kind}{j}" for j in range(6)] for kind in "abc"]
    rows = [(i, " ".join(draw.choice(lists[i % 100 % 3 if i % 100 else 2], 5)), "en" if i % 2 else "de") for i in range(n)]
    rows.append((None, "single words of a row without an id", "en"))
    texts = spark.createDataFrame(rows, "id long, text string, lang_class string")
    model = fit_topics(texts, topics=3)
    texts = next(slices(pa.array([text for _, text, _ in rows])))
    counts = _word_counts(texts)[1]
    assert np.allclose(model.weights, np.log((n + 2) / ((counts > 0).sum(0) + 1)))
    apart = _unit(np.log1p(counts) * model.weights)
    langs = np.array([lang for *_, lang in rows])
    for lang in ("en", "de"):
        apart[langs == lang] -= apart[langs == lang].mean(0)
    topic = model.of(np.log1p(counts), langs.tolist())
    assert (topic == (apart @ model.centres.T - (model.centres**2).sum(1) / 2).argmax(1)).mean() > 0.999
    size = texts.words().counts
    for k, centre in enumerate(model.centres):
        own = topic == k
        assert np.allclose(centre, (apart[own] * size[own, None]).sum(0) / size[own].sum(), atol=1e-3)


def test_topics_of_texts_with_a_very_frequent_word(spark):
    rows = [(i, "often " * (0, 3, 400)[i % 3] + f"w{i % 2}", "en") for i in range(60)]
    model = fit_topics(spark.createDataFrame(rows, "id long, text string, lang_class string"))
    apart = _unit(np.log1p(_word_counts(next(slices(pa.array([text for _, text, _ in rows]))))[1]) * model.weights)
    near = ((apart - apart.mean(0))[:, None] - model.centres) ** 2
    assert len(model.centres) == 6 and near.sum(2).min(1).max() < 1e-6


def test_mixing_of_odd_rows(odd, none):
    spare = odd.withColumn("source", F.when(F.col("doc_id") != 6, F.col("source"))).withColumn("lang", F.when(F.col("doc_id") == 9, "xx"))
    for name in ("weight", "sampled", "copies", "topic", "tokens", "id", "source_class"):
        spare = spare.withColumn(name, F.lit("x"))
    found = mix(spare, languages=("en",)).collect()
    assert len(found) == odd.count() and all(r.row.doc_id is None or r.n_tokens == len((r.row.text or "").split(None)) or r.row.doc_id == 10 for r in found)
    assert {r.lang for r in found} == {None, "other"} and {r.row.weight for r in found} == {"x"}
    bare = [r for r in found if not r.n_tokens]
    assert len(bare) == 3 and all(r.sampled and r.weight == r.copies == 1 and r.topic == 0 for r in bare)
    assert mix(none).count() == 0 and mix(odd.where("doc_id < 4")).where("sampled").count() == 3
    with pytest.raises(ValueError, match="positive"):
        mix(odd, rate=0)


def test_mixing_takes_the_languages_of_the_data(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    other = F.element_at(F.lit(["it", "pl", "nl", "pt", "sv", "de"]), (F.pmod(F.xxhash64("doc_id"), F.lit(6)) + 1).cast("int"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 9 > 0, other))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op6_mixing"](spark, str(tmp_path)).toPandas().fillna({"lang": "-"})
    assert set(rows.lang) == {"it", "pl", "nl", "pt", "sv", "de", "-"}
    share = rows.groupby("lang").n_tokens.sum() / rows.n_tokens.sum()
    weighted = (rows.n_tokens * rows.weight).groupby(rows.lang).sum() / rows.n_tokens.sum()
    assert np.allclose(weighted, tempered(share, 0.97), atol=1e-5)
    sampled = rows[rows.sampled].doc_id.tolist()
    staged = corpus_pipeline.mixing(spark, docs, str(tmp_path)).select("doc_id").collect()
    assert sorted(r.doc_id for r in staged) == sorted(sampled)


def test_mixing_of_very_many_languages(spark):
    rows = [(i, "a b c " * (1 + i % 5), f"s{i % 3}", f"l{i % 500}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = mix(docs, 1, 0.5, 1, languages=None).select("lang", "n_tokens", "weight").toPandas()
    share = found.groupby("lang").n_tokens.sum() / found.n_tokens.sum()
    weighted = (found.n_tokens * found.weight).groupby(found.lang).sum() / found.n_tokens.sum()
    assert len(share) == 500 and np.allclose(weighted, tempered(share, 0.5), atol=1e-5)


def test_stages_keep_columns_and_take_odd_rows(spark, odd, none, sf):
    docs = odd.select("doc_id", "text", "lang", "source", F.lit(0).cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf)
        assert found.columns == docs.columns, name
        found.count()
        assert stage(spark, docs.where("false"), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= odd.count()


def test_pipeline(spark, sf):
    found = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.5 * docs < len({r.doc_id for r in found}) <= docs
    check_packing(found, 4096)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), duck(sf), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_a_row_each(spark, sf, name):
    found = QUERIES[name](spark, sf)
    table = {"op3_embedding_near_dedup": "embeddings", "op5_html_extraction": "pages", "op9_url_filters": "pages"}.get(name, "documents")
    rows = spark.read.parquet(f"{sf}/{table}.parquet").count()
    assert found.count() >= rows if name == "op2_best_fit_packing" else found.count() == rows
