import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinmatch.llm import decontaminate, registry
from tests.llm.helpers import same

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    want = same(registry.op2_decontaminate(spark, SF), registry.oracle_sql()["op2_decontaminate"], SF, "documents", "benchmark")
    assert len(want) > 5


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    items = [[word() for _ in range(30)] for _ in range(20)]
    noise = lambda n: [word() for _ in range(n)]
    rows, want = [], set()
    for i, it in enumerate(items):
        rows.append((i, " ".join(noise(50) + it + noise(50))))
        rows.append((100 + i, ", ".join(w.upper() for w in noise(5) + [w if k % 7 else word() for k, w in enumerate(it)] + noise(5))))  # a substitution in seven
        rows.append((200 + i, " ".join(it[12:] + noise(9))))  # cut off
        rows.append((300 + i, " ".join(noise(30) + it[3:8] + noise(30))))  # too little
        rows.append((400 + i, " ".join(rng.sample(it, 30))))  # the same words
        want |= {(i, i), (100 + i, i), (200 + i, i)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(it)) for i, it in enumerate(items)], "item_id long, text string")
    return docs, bench, want


def test_substituted_and_cut_copies(planted):
    docs, bench, want = planted
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == want
    left = {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_shuffled_join_finds_the_same(planted, monkeypatch):
    docs, bench, want = planted
    monkeypatch.setattr("kinmatch.llm.base.BROADCAST_BYTES", 0)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == want


def test_odd_rows(spark):
    it = "one two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(None, it), (1, None), (2, ""), (3, "short item"), (4, it), (4, it)], "item_id long, text string")
    rows = [(None, it), (1, None), (2, ""), (3, "short item"), (4, "x " * 8190 + it), (4, "x " * 8190 + it), (5, "!!! ...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(9)).withColumn("h", F.lit(0)).withColumn("key", F.lit(0))
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["doc_start"], r["n_equal"]) for r in decontaminate.overlaps(docs, bench).collect())
    assert got == [("4", "4", 8190, 13), ("4", "None", 8190, 13), ("None", "4", 0, 13), ("None", "None", 0, 13)]
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 5]
    assert decontaminate.overlaps(docs.limit(0), bench).collect() == decontaminate.overlaps(docs, bench.limit(0)).collect() == []
    assert decontaminate.clean(docs, bench.limit(0)).count() == 7


@pytest.mark.parametrize("n", range(decontaminate.TOLERANT, decontaminate.WINDOW + 1))
def test_masks_lose_nothing(n):
    """Whatever verification accepts holds a seed: all places for as many substitutions as it allows, on items of each length."""
    masks = decontaminate.MASKS[max(at for at in decontaminate.MASKS if at <= n)]
    changed = n - -(-n * decontaminate.MATCHED // 100)
    for subs in itertools.combinations(range(n), changed):
        assert any(not any(m[p - at] == "1" for p in subs if at <= p < at + len(m)) for m in masks for at in range(n - len(m) + 1))


def plain_overlaps(docs, items):
    """All documents against all items on all diagonals, without seeds."""
    out = set()
    for (d, t), (i, it) in itertools.product(docs, items):
        w = min(decontaminate.WINDOW, len(it))
        least = w if w < decontaminate.TOLERANT else -(-w * decontaminate.MATCHED // 100)
        for o in range(-len(it), len(t)):
            start = max(0, o)
            e = [t[k] == it[k - o] for k in range(start, min(len(t), len(it) + o))]
            if len(it) >= decontaminate.LEAST and len(e) >= w and max(sum(e[k : k + w]) for k in range(len(e) - w + 1)) >= least:
                out.add((d, i))
    return out


def test_equals_all_pairs_without_seeds(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcd", k=3))
    items = [(n * 10 + k, [word() for _ in range(n)]) for n in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20) for k in range(4)]
    docs = []
    for i, it in items:
        for c in range(8):
            t = list(it)
            for p in rng.sample(range(len(t)), min(len(t), rng.choice([0, 1, 2, 2, 3, 3, 4]))):
                t[p] = word()
            docs.append((i * 100 + c, [word() for _ in range(rng.randrange(12))] + t + [word() for _ in range(rng.randrange(12))]))
    frame = lambda rows, name: spark.createDataFrame([(i, " ".join(t)) for i, t in rows], f"{name} long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    want = plain_overlaps(docs, items)
    assert got == want and {i // 10 for _, i in want} == {n for n in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20)}


def test_scripts_without_spaces_and_short_items(spark):
    zh = "北京是中华人民共和国的首都也是全国的政治中心"
    bench = spark.createDataFrame([(1, zh), (2, "Wer war Goethe wirklich"), (3, "only two")], "item_id long, text string")
    rows = [(1, "前面的话。" + zh + "后面"), (2, zh.replace("首", "古")), (3, "北京很大,我们在那里住过"), (4, "ich frage: wer war goethe wirklich?"), (5, "wer war schiller wirklich"), (6, "only two")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1), (2, 1), (4, 2)}
