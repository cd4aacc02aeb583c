import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from kinmatch.llm import pieces, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def own():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def odd_texts(n=1500):
    rng = random.Random(2)
    letters = list("aaabbcdeé   \t\n_.,▁ßñ漢字🙂12xyzthein gionABC'\"") + ["the", "ing", "  ", "ation"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(n)]


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.op6_pieces(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["piece_ids"] == library.encode(docs[r["doc_id"]]) and r["n_pieces"] == len(r["piece_ids"]) and r["round_trip"]


def test_odd_texts_equal_the_library(library, own):
    for t in odd_texts():
        ids = own.encode(t)
        assert ids == library.encode(t), t
        assert own.decode(ids) == library.decode(ids)


def test_commits_are_early_and_whole_texts_agree(own, library):
    """Also without the cut into words: one stream over the whole text, whose groups stay short."""
    for t in [*odd_texts(200), "the" * 3000 + "a" * 3000 + "🙂 x" * 500]:
        marked = "▁" + t.replace(" ", "▁")
        groups = list(own.stream(marked))
        assert "".join(p for g in groups for p in g) == marked
        if t:
            assert [i for g in groups for p in g for i in own._ids(p)] == library.encode(t)
        assert max(map(len, groups)) <= 4 * own.longest


def test_every_character_goes_through_the_streaming_pass(library, monkeypatch):
    """With nothing remembered, the pass sees each character once; with a memory, it sees each new stretch once."""
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() if t]
    with open(pieces.MODEL, "rb") as f:
        model = f.read()
    p = pieces.Pieces(model)
    monkeypatch.setattr(pieces, "KEPT", 0)
    for t in texts[:60]:
        before = p.seen
        assert p.encode(t) == library.encode(t)
        assert p.seen - before == len(t) + 1
    monkeypatch.undo()
    p = pieces.Pieces(model)
    p.encode(texts[0])
    first = p.seen
    assert 0 < first <= len(texts[0]) + 1
    p.encode(texts[0])
    assert p.seen == first


def test_unigram_paths_have_the_best_score(own):
    with open(pieces.MODEL, "rb") as f:
        uni = pieces.Pieces(f.read(), bpe=False)
    rng = random.Random(4)
    uni.score = [-rng.random() * 5 - 1 for _ in uni.score]  # scores of a unigram model
    uni.worst = -20

    def best(s):
        at = [0.0]
        for i in range(1, len(s) + 1):
            at.append(max(at[j] + (uni.score[uni.id[s[j:i]]] if s[j:i] in uni.id else uni.worst) for j in range(max(0, i - uni.longest), i) if s[j:i] in uni.id or i - j == 1))
        return at[-1]

    for t in odd_texts(150):
        got = [p for g in uni.stream(t) for p in g]
        assert "".join(got) == t
        assert sum(uni.score[uni.id[p]] if p in uni.id else uni.worst for p in got) == pytest.approx(best(t))


def test_odd_rows(spark, library):
    long = "lorem ipsum " * 60000 + "x" * 50000
    docs = spark.createDataFrame([(1, None), (2, ""), (None, " "), (3, long), (3, long)], "doc_id long, text string").withColumn("piece_ids", F.lit("mine")).withColumn("decoded", F.lit(0)).withColumn("a.b", F.lit(1))
    out = pieces.decoded(pieces.encoded(docs))
    got = sorted(((str(r["doc_id"]), r["piece_ids"], r["decoded"]) for r in out.collect()), key=lambda x: x[0])
    ids = library.encode(long)
    assert got == [("1", [], ""), ("2", [], ""), ("3", ids, long), ("3", ids, long), ("None", library.encode(" "), " ")]
    assert set(out.columns) == set(docs.columns)
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_uncut_words_are_remembered_once():
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    own.encode("Plain words, unlike 漢字かなxyz mixed ones")
    assert own.words and own.parts and not set(own.words) & set(own.parts)


def test_other_stages_let_go_of_the_words():
    from kinmatch.llm.base import let_go

    with open(pieces.MODEL, "rb") as f:
        pieces.load(f.read()).encode("some words")
    let_go()
    assert not pieces._loaded
