import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import language, registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return language.train(docs.where(~language.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.op8_language(spark, SF).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def test_held_out_rows_are_not_learned_from(spark):
    """Wrong labels on held-out rows change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = language.held_out(F.col("doc_id"))
    wrong = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    a, b = (language.train(d.where(~held), sample_docs=200) for d in (docs, wrong))
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights) and np.array_equal(a.moves, b.moves)


def test_sample_is_bounded(spark):
    """Repeated ids and texts, null ids, and a text larger than the bound: the bounds hold, and texts come whole."""
    rows = [(1, f"one {'same'} text of ten words that comes again ok", "en")] * 2000 + [(None, f"text number {'abcdefghij'[i % 10]}{'klmnop'[i % 6]} " * 5, "fr") for i in range(300)] + [(2, "z " * 50000, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = language.sample_spans(docs, sample_docs=10, sample_words=50_000)
    assert len([x for x in few if x[0] == "en"]) == 1 and sum(len(w) for lang, w in few if lang == "fr") <= 5 * 15
    some = language.sample_spans(docs, sample_words=400)
    assert 150 < sum(len(w) for lang, w in some if lang == "fr") <= 200 and all(len(w) <= language.SPAN for _, w in some)
    assert sum(len(w) for _, w in language.sample_spans(docs, sample_words=10**6)) == 10 + 30 * 15 + 50000


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    crf = language.Crf(["a", "b", "c"], np.zeros((1, 3)), {}, rng.normal(size=3), rng.normal(size=(3, 3)))
    seqs = [np.exp(rng.normal(size=(n, 3))).astype(np.float32) for n in (4, 1, 0, 6, 4)]
    whole = crf.marginals(seqs, True)
    for e, got, total in zip(seqs, whole, crf.marginals(seqs), strict=True):
        want = np.zeros((len(e), 3))
        for path in itertools.product(range(3), repeat=len(e)):
            if path:
                s = crf.start[path[0]] + sum(crf.moves[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(np.log(e[t, y]) for t, y in enumerate(path))
                for t, y in enumerate(path):
                    want[t, y] += np.exp(s)
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(got, want, atol=1e-4) and np.allclose(total, want.sum(axis=0), atol=1e-4)


def test_code_switched_text(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(language.held_out(F.col("doc_id")) & (F.col("n_chars") > 400))
    text = {r["lang"]: r["text"][:240] for r in docs.collect()}
    parts = [("en", text["en"]), ("de", text["de"]), ("fr", text["fr"])]
    mixed = spark.createDataFrame([(" 12 | ".join(t for _, t in parts),)], "text string")
    spans = language.labelled(mixed, model, spans=True).first()["language"]["spans"]
    gold = [lang for lang, t in parts for _ in language.words_of(t)]
    tags = [s["lang"] for s in spans for _ in range(s["words"])]
    assert sum(a == b for a, b in zip(gold, tags, strict=True)) / len(gold) > 0.95


def test_cache_may_be_cleared(model, monkeypatch):
    texts = ["the word and another", None, "", "der die das und ein Haus", "42 | 17"] * 3
    want = model.label(texts)
    monkeypatch.setattr(language, "CACHE_WORDS", 2)
    monkeypatch.setattr(language, "GROUP_WORDS", 3)
    again = model.label(texts)
    assert [x[0] for x in again] == [x[0] for x in want] and np.allclose([x[1] for x in again], [x[1] for x in want], atol=1e-5)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (None, "123 --- ½ ² !!"), (3, "the and of " * 50000 + "q" * 40000), (3, "the and of " * 50000 + "q" * 40000), (4, "Ж")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("language", F.lit("x")).withColumn("lang", F.lit("fr")).withColumn("score", F.lit(5))
    out = language.labelled(docs, model)
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), r["language"]["lang"], r["language"]["score"] > 0) for r in out.collect())
    assert [x[:2] for x in got if x[0] != "4"] == [("1", "und"), ("2", "und"), ("3", "en"), ("3", "en"), ("None", "und")]
    assert language.labelled(docs.limit(0), model).collect() == []
    nothing = language.train(docs.limit(0))
    assert nothing.langs == [] and {r["language"]["lang"] for r in language.labelled(docs, nothing).collect()} == {"und"}
    one = language.train(docs)
    assert one.langs == ["fr"] and language.labelled(docs, one).where("doc_id = 3").first()["language"]["lang"] == "fr"
    assert language.train(docs.withColumn("lang", F.lit(None).cast("string"))).langs == []
