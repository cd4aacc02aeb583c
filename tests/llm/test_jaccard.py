import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinmatch.llm import jaccard, simhash


def plain_shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def plain_components(texts):
    """All pairs by Jaccard similarity alone: id -> the smallest id of its group."""
    ids, sets = sorted(texts), {i: plain_shingles(t) for i, t in texts.items()}
    holders = {}
    for i in ids:
        for s in sets[i] or {()}:
            holders.setdefault(s, []).append(i)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    met = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in met:
        if similarity(sets[a], sets[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def variants():
    """Pairs (kind, text, other) that differ by a tail, a block, a moved passage or single words, at similarities around 0.8."""
    rng = np.random.default_rng(11)
    word = lambda: "w" + str(min(int(rng.pareto(0.6) * 3), 10**9)) + "x" + str(rng.integers(0, 40))
    out = []
    for n in (80, 150, 300, 700):
        for share in (0.02, 0.08, 0.12, 0.16, 0.19, 0.22, 0.25, 0.35):
            w = [word() for _ in range(n)]
            k = max(1, int(n * share))
            new, at = [word() for _ in range(k)], int(rng.integers(10, n - k - 5))
            spots = set(np.linspace(2, n - 3, max(1, k // 5)).astype(int).tolist())
            cases = {"tail added": w + new, "tail dropped": w[: n - k], "block inserted": w[:at] + new + w[at:], "block dropped": w[:at] + w[at + k :], "moved": w[:at] + w[at + k :] + w[at : at + k], "words": [word() if i in spots else x for i, x in enumerate(w)]}
            out += [(kind, " ".join(w), " ".join(v)) for kind, v in cases.items()]
    w = [f"e{i}" for i in range(104)]  # 100 shingles
    return out + [("exactly 0.8", " ".join(w), " ".join(w[:84])), ("just below", " ".join(w), " ".join(w[:83]))]


@pytest.mark.parametrize("long_list", [2, jaccard.LONG_LIST])
def test_pairs_at_eight_tenths_link_and_no_others(spark, long_list):
    pairs = variants()
    texts = {2 * k + j: t for k, p in enumerate(pairs) for j, t in enumerate(p[1:])}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, long_list=long_list).collect()}
    assert got == plain_components(texts)
    above = {kind: 0 for kind, _, _ in pairs}
    for kind, a, b in pairs:
        above[kind] += 0.8 <= similarity(plain_shingles(a), plain_shingles(b)) < 0.9
    assert above.pop("just below") == 0 and all(above.values())


def test_stage_keeps_what_is_under_eight_tenths(spark):
    pairs = [p for p in variants() if p[0] != "moved"]
    rows = [(2 * k + j, t) for k, p in enumerate(pairs) for j, t in enumerate(p[1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == {i for i, c in plain_components(texts).items() if i == c}


@pytest.mark.parametrize("long_list", [2, jaccard.LONG_LIST])
def test_documents_equal_all_pairs(spark, long_list, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 300)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, long_list=long_list).collect()}
    assert got == plain_components({r["doc_id"]: r["text"] for r in docs.collect()})


def test_simhash_proposes_links_that_are_checked(spark, monkeypatch):
    """Pairs of near fingerprints are linked first, if they are similar enough; the index by prefixes doesn't see them again."""
    w = [f"word{i}" for i in range(3000)]
    same = "a " * 1500
    texts = {0: " ".join(w), 1: " ".join([*w[:-1], "last"]), 2: same + " ".join(f"u{i}" for i in range(20)), 3: same + " ".join(f"v{i}" for i in range(20)), 4: " ".join(w[:2600]), 5: "of its own"}
    fps = {i: simhash.fingerprint(t) for i, t in texts.items()}
    assert (fps[0] ^ fps[1]).bit_count() <= 4 and (fps[2] ^ fps[3]).bit_count() <= 4 and (fps[0] ^ fps[4]).bit_count() > 4
    seen, links = [], jaccard.links

    def spy(prefixes, load, long_list, first):
        seen.append(first.count())
        return links(prefixes, load, long_list, first)

    monkeypatch.setattr(jaccard, "links", spy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert seen == [1] and got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 0, 5: 5} == plain_components(texts)


def test_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, " \t\n"), (None, "one two"), (7, "One TWO"), (9, "x y " * 70000), (9, "x y " * 70000), (4, "solo")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("mine")).withColumn("row", F.lit(1))
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in jaccard.near_duplicates(docs).collect())
    assert got == sorted([("1", 1), ("2", 1), ("3", 1), ("None", 7), ("7", 7), ("9", 9), ("9", 9), ("4", 4)])
    kept = jaccard.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "7", "9", "None"]
    assert jaccard.near_duplicates(docs.limit(0)).collect() == jaccard.first_of_groups(docs.limit(0)).collect() == []
