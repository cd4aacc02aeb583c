import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import registry, tokencount

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    with open(tokencount.RANKS, "rb") as f:
        return tokencount.Counter(f.read())


def apply(text, edits):
    for s, e, new in edits:
        s = max(0, min(s, len(text)))
        text = text[:s] + (new or "") + text[max(s, min(e, len(text))) :]
    return text


def test_query_equals_full_encoding(spark, counter):
    rows = spark.read.parquet(f"{SF}/documents.parquet").withColumn("edits", tokencount.revision(F.col("doc_id"), F.col("text"))).collect()
    got = {r["doc_id"]: r for r in registry.op4_tokens(spark, SF).collect()}
    assert len(got) == len(rows)
    full = lambda t: len(counter.encoding.encode_ordinary(t))
    for r in rows:
        x = got[r["doc_id"]]
        after = apply(r["text"], [(e["start"], e["end"], e["new"]) for e in r["edits"]])
        assert (x["n_tokens"], x["n_tokens_after"]) == (full(r["text"]), full(after))
        assert x["n_reencoded"] <= 60  # a few pre-tokens for each edit, however long the text is


def test_random_edits(counter):
    rng = random.Random(9)
    bits = list("ab1 '\n\t.!é漢  ") + ["'re", "'s", "  \n ", "the", " word", "'ll", "\x1c", "　", "🙂"]
    for n in (0, 1, 5, 40, 3000):
        for _ in range(60 if n < 100 else 6):
            text = "".join(rng.choices(bits, k=n))
            tree = tokencount.TokenTree(text, *counter.leaves(text))
            for _ in range(25):
                s = rng.randint(0, len(tree.text))
                e = min(len(tree.text), s + rng.choice([0, 0, 1, 2, 9, 300]))
                new = "".join(rng.choices(bits, k=rng.choice([0, 1, 2, 6, 400])))
                want = tree.text[:s] + new + tree.text[e:]
                tree.edit(s, e, new, counter)
                assert tree.text == want
                lens, counts = counter.leaves(want)
                got = tree.leaves()
                assert np.array_equal(got[0], lens) and np.array_equal(got[1], counts)
                assert tree.n_tokens == counts.sum() == len(counter.encoding.encode_ordinary(want))
                assert tree.chars[1] == len(want)


def test_odd_rows(spark, counter):
    long = "some words " * 80000 + "y" * 30000
    edits = [(0, 0, "x"), None, (10**6 * 5, 10**6 * 9, None), (-5, 2, "zz")]
    rows = [(1, None, edits), (2, "", edits), (None, "a b", None), (3, long, edits), (3, long, edits), (4, "kept", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,end:int,new:string>>").withColumn("token_tree", F.lit(1)).withColumn("edited", F.lit(1)).withColumn("lens", F.lit("l"))
    out = tokencount.edited(tokencount.trees(docs))
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), r["edited"]["text"], r["edited"]["n_tokens"], r["edited"]["n_tokens_after"]) for r in out.collect())
    full = lambda t: len(counter.encoding.encode_ordinary(t))
    after = apply(long, [e for e in edits if e])
    want = [("1", None, 0, 0), ("2", "zz", 0, full("zz")), ("3", after, full(long), full(after)), ("3", after, full(long), full(after)), ("4", "kept", 1, 1), ("None", "a b", 2, 2)]
    want[4] = ("4", "kept", full("kept"), full("kept"))
    assert got == want
    assert tokencount.edited(tokencount.trees(docs.limit(0))).collect() == []
