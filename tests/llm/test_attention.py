import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import attention, registry

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    return (order[y == 1].mean() - order[y == 0].mean()) / len(y) + 0.5


def test_held_out_accuracy(spark):
    got = registry.op9_attention(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["score"], r["predicted"], quality[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in quality]
    s, p, y = map(np.array, zip(*held, strict=True))
    assert auc(s, y) > 0.97 and (p == y).mean() > 0.95


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, attention.N_FEATURES)) for n in (3, 1, 5)]
    y = np.array([1.0, 0.0, 1.0])
    m = attention.fit([b[:1] for b in bags], [1, 0, 1], epochs=1)
    m.mean, m.scale = m.mean * 0, m.scale * 0 + 1
    b = attention.Bags.of(bags)
    loss = lambda: -np.mean(y * np.log(m.forward(b)["score"]) + (1 - y) * np.log(1 - m.forward(b)["score"]))
    for name, g in m.gradients(b, y).items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(4)]:
            keep = m.p[name][at]
            m.p[name][at] = keep + 1e-5
            up = loss()
            m.p[name][at] = keep - 1e-5
            down = loss()
            m.p[name][at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_finds_the_telling_passage():
    """Documents differ in one passage of many; only documents have labels."""
    rng = np.random.default_rng(2)
    plain = lambda: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(64))
    bags, y, where = [], [], []
    for i in range(300):
        parts, k = [plain() for _ in range(6)], int(rng.integers(0, 6))
        if i % 2:
            parts[k] = " ".join(w + "###" for w in parts[k].split())
        bags.append(attention.passages(" ".join(parts)))
        y.append(1 - i % 2)
        where.append(k)
    m = attention.fit(bags[:200], y[:200])
    score, weights = m.score(bags[200:])
    assert ((score > 0.5) == np.array(y[200:])).all()
    marked = [w.argmax() == k for w, k, label in zip(weights, where[200:], y[200:], strict=True) if label == 0]
    assert np.mean(marked) > 0.9 and all(abs(w.sum() - 1) < 1e-6 for w in weights)


def test_long_texts_are_cut_alike(monkeypatch):
    text = "some words, and | more\n" * 500
    want = attention.passages(text)
    monkeypatch.setattr(attention, "CUT", 100)
    assert np.array_equal(attention.passages(text), want) and len(want) == -(-2500 // 64)


def plain_scores(bags, model):
    """The scores one passage at a time, by the formulas alone."""
    p, out = model.p, []
    for bag in bags:
        codes, weights = [], []
        for x in bag:
            h = np.tanh(np.clip((x - model.mean) / model.scale, -6, 6) @ p["w"] + p["b"])
            codes.append(h)
            weights.append(np.exp(np.dot(np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"]))), p["a"])))
        z = sum(w * h for w, h in zip(weights, codes, strict=True)) / sum(weights)
        out.append(1 / (1 + np.exp(-(z @ p["c"] + p["c0"][0]))))
    return out


def test_query_equals_brute_force(spark):
    """The registered query's rows from the documents it may learn from, encoded and scored one by one without Spark."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    text, quality = {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    for r in labels.collect():
        quality.setdefault(r["doc_id"], []).append(r["quality"])
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in text}
    learn = sorted(i for i in quality if i in text and not held[i])
    assert len(learn) <= attention.SAMPLE_DOCS and sum(len(attention.passages(text[i])) for i in learn) <= attention.SAMPLE_PASSAGES
    model = attention.fit([attention.passages(text[i]) for i in learn], [int(np.mean(quality[i]) >= 0.5) for i in learn])
    ids = sorted(text)
    want = dict(zip(ids, plain_scores([attention.passages(text[i]) for i in ids], model), strict=True))
    for r in registry.op9_attention(spark, sf).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6) and r["held_out"] == held[r["doc_id"]]


def test_sample_is_bounded(spark):
    """Repeated ids, null ids, many labels and a text larger than the bound: the bounds hold, and texts come whole."""
    rows = [(i % 50, f"w{i % 50} " * (10 + 64 * (i % 50 % 4))) for i in range(4000)] + [(None, "x")] * 30 + [(60, "y " * 100000)] * 3 + [(7, "another text")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i % 61, i % 2) for i in range(3000)] + [(None, 1)] * 20, "doc_id long, quality int")
    assert len(attention.sample(docs, labels, sample_docs=1)) == 1
    some = attention.sample(docs, labels, sample_docs=30, sample_passages=40)
    assert len(some) <= 30 and 30 < sum(len(x) for x, _ in some) <= 40
    every = attention.sample(docs, labels)
    assert len(every) == 51 and max(len(x) for x, _ in every) == -(-100000 // 64)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, " \n"), (3, "word " * 300000 + "z" * 100000), (3, "word " * 300000 + "z" * 100000), (4, "ok")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("x")).withColumn("score", F.lit(1)).withColumn("__y", F.lit(0))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (3, 1, None), (3, 0, 0), (None, 1, 1), (4, 0, 0), (4, 0, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    model = attention.train(docs, labels)
    out = attention.scored(docs, model, attention=True)
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), r["quality"]["score"], len(r["quality"]["attention"])) for r in out.collect())
    assert len(got) == 6 and all(0 < s < 1 for _, s, _ in got) and [n for _, _, n in got] == [1, 1, 4688, 4688, 1, 1]
    assert got[0][1] == got[1][1] == got[5][1]
    assert attention.scored(docs.limit(0), model).collect() == []
    none = attention.train(docs, labels.limit(0))
    assert {r["quality"]["score"] for r in attention.scored(docs, none).collect()} == {0.5}
