import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kinmatch.llm import registry, simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.op5_simhash(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in docs]
    comps = plain_components([r["doc_id"] for r in docs], fps)
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(docs, fps, comps, strict=True)}
    assert len({c for _, c in got.values()}) < len(got)


def test_spark_hash_is_the_same(spark):
    x = "çà et là | the 4 words"
    got = spark.range(1).select(F.xxhash64(F.lit(x))).first()[0] & (1 << 64) - 1
    assert got == xxhash.xxh64_intdigest(x.encode(), seed=42)


@pytest.mark.parametrize("max_list", [32, 4096])
def test_links_of_crowded_lists(spark, max_list):
    """A few centres with many close neighbours, and numbers that agree in three bytes: lists are split, no link is lost."""
    rng = np.random.default_rng(1)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in rng.integers(0, 1 << 63, 5) for _ in range(80)]
    same = [int(x) << 24 | 0xABCDEF for x in rng.integers(0, 1 << 36, 200)]
    fps = sorted({*near, *same, 0, 1, (1 << 64) - 1})
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, max_list=max_list)).collect()}
    want = plain_components([simhash._signed(f) for f in fps], fps)
    assert [roots.get(simhash._signed(f), simhash._signed(f)) for f in fps] == want


def test_odd_rows(spark):
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t\n", "x"), (None, "one two", "x"), (7, "One TWO", None), (9, "Ünïque " * 70000, "x"), (9, "Ünïque " * 70000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit("mine")).withColumn("least", F.lit(1))
    got = sorted((str(r["doc_id"]), r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    fp = [simhash._signed(plain_fingerprint(t)) for t in ("one two", "Ünïque " * 70000)]
    assert got == sorted([("1", 0, 1), ("2", 0, 1), ("3", 0, 1), ("None", fp[0], 7), ("7", fp[0], 7), ("9", fp[1], 9), ("9", fp[1], 9)])
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "7", "9", "None"]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.first_of_groups(docs.limit(0)).collect() == []
