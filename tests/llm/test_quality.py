import random

from pyspark.sql import functions as F

from kinmatch.llm import quality, registry
from tests.llm.helpers import same

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    want = same(registry.op7_quality(spark, SF), registry.oracle_sql()["op7_quality"], SF, "documents")
    assert 0.6 < sum(r[1 + sorted(["doc_id", "base_failed", "kept", *quality.COUNTS]).index("kept") - 1] for r in want) / len(want) < 0.95


def test_verdicts_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q"))
    out = quality.judged(docs).where("NOT base_failed").join(labels, "doc_id")
    good, bad = (out.where(f"q = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.99 and bad < 0.1


def test_counts():
    assert quality.counts_of(None) == quality.counts_of("") == (0,) * len(quality.COUNTS)
    n, chars, symbols, dup, rep, lines, capitals, shouts = quality.counts_of("a b c\n \na b c\nX é|!\xa0z")
    assert (n, chars, symbols, dup, rep, lines, capitals, shouts) == (8, 12, 1, 1, 6, 3, 1, 1)


def test_bucket_and_back(spark):
    x = [*range(0, 300), 999, 1000, 1 << 20, (1 << 20) - 1, 123456789]
    got = spark.createDataFrame([(v,) for v in x], "x long").select("x", quality.bucket(F.col("x")).alias("b")).select("x", "b", quality.bucket_low(F.col("b")).alias("low")).collect()
    for r in got:
        assert r["low"] <= r["x"] <= r["low"] * 17 / 16 + 1
    assert len({r["b"] for r in got if r["x"] < 32}) == 32


def test_thresholds_follow_the_group(spark):
    """Many symbols are usual in one source and stand out in another; a hot source doesn't set the others' limits."""
    rng = random.Random(3)

    def text(symbols):
        return " ".join(f"word{rng.randrange(10**6)}" + "#" * (i < symbols) for i in range(100))

    rows = [(i, text(60 if s == "code" else 0), "en", s) for i, s in enumerate(["code"] * 300 + ["prose"] * 900)]
    rows += [(5000, text(60), "en", "prose"), (5001, text(60), "en", "code"), (5002, text(60), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert kept[5001] and not kept[5000] and not kept[5002]
    assert all(kept[i] for i in range(1200))


def test_one_document_more_changes_little(spark):
    """The limits of a source move with its size by small steps, from its language's to its own."""
    rng = random.Random(4)
    word = lambda: f"word{rng.randrange(10**6)}"
    prose = [(i, " ".join(word() for _ in range(100)), "en", "prose") for i in range(1000)]
    code = [(5000 + i, " ".join(word() + "#" * (k < 60) for k in range(100)), "en", "code") for i in range(420)]
    most = []
    for n in (0, 50, 100, 150, 199, 200, 201, 250, 300, 350, 420):
        docs = spark.createDataFrame(prose + code[: max(n, 1)], "doc_id long, text string, lang string, source string")
        f = quality.fences(quality.sketches(quality._measured(docs))).where("source_key = '=code'").first()
        most.append(f["symbol_rate_most"])
    assert most[4] == most[5] == most[6], "no switch at a size"
    assert most == sorted(most) and most[0] == 50 and most[-1] >= 300


def test_repeats_out_of_the_group_are_rejected(spark):
    rng = random.Random(5)
    word = lambda: f"word{rng.randrange(10**6)}"
    rows = [(i, " ".join(word() for _ in range(200)), "en", "a") for i in range(300)]
    rows += [(900 + i, " ".join([*(word() for _ in range(200 - n)), *["one", "two", "three"] * (n // 3 + 1)][:200]), "en", "a") for i, n in enumerate((30, 60, 78, 90, 96))]
    got = {r["doc_id"]: (r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [got[900 + i][2] for i in range(5)] == [True, True, False, False, False]
    assert not any(got[900 + i][1] for i in range(5)) and all(got[i][2] for i in range(300))


def test_odd_rows(spark):
    fine = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "en", "a"), (2, "", None, None), (None, fine, None, None), (3, fine, "en", "a"), (3, fine, "en", "a"), (4, "x " * 300000, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("?")).withColumn("n_words", F.lit(-1)).withColumn("c", F.lit(0))
    got = sorted((str(r["doc_id"]), r["n_words"], r["base_failed"], r["kept"]) for r in quality.judged(docs).collect())
    assert got == [("1", 0, True, False), ("2", 0, True, False), ("3", 60, False, True), ("3", 60, False, True), ("4", 300000, True, False), ("None", 60, False, True)]
    kept = quality.filtered(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "None"]
    assert quality.judged(docs.limit(0)).collect() == quality.filtered(docs.limit(0)).collect() == []
