import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from kinmatch.llm import base, decontaminate, pieces, pii, quality
from tests.llm.helpers import rows_of
from tests.llm.test_jaccard import plain_components

SF = "/root/testdata/sf0.01"


def plain_run(sf_dir):
    """The pipeline by plain means: SQL for rules, decontamination and pseudonyms, all pairs by similarity, the library's encoder."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE all_docs AS SELECT * FROM '{sf_dir}/documents.parquet'")
    con.execute(f"CREATE TABLE benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    con.execute("CREATE VIEW documents AS SELECT * FROM all_docs")
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality.sql()}) WHERE kept").fetchall()}
    docs = {r[0]: r for r in con.sql("SELECT doc_id, text, lang, source FROM documents").fetchall() if r[0] in kept}
    ids = [i for i, r in plain_components({i: d[1] for i, d in docs.items()}).items() if i == r]
    con.execute("CREATE TABLE left_docs AS SELECT * FROM all_docs WHERE list_contains(?, doc_id)", [ids])
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM left_docs")
    bad = {r[0] for r in con.sql(f"SELECT DISTINCT doc_id FROM ({decontaminate.sql()})").fetchall()}
    texts = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, text FROM ({pii.sql()})").fetchall() if r[0] not in bad}
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    return {i: (t, *docs[i][2:], len(t), sp.encode(t), True) for i, t in texts.items()}


def test_run_equals_brute_force(spark):
    want = plain_run(SF)
    got = {r["doc_id"]: (r["text"], r["lang"], r["source"], r["n_chars"], r["piece_ids"], r["round_trip"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
    assert 300 < len(want) < 900


def test_only_the_result_stays_in_the_shared_folder(spark):
    import glob

    before = set(glob.glob(f"{base.shared_dir(spark)}/kinmatch/*"))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    new = set(glob.glob(f"{base.shared_dir(spark)}/kinmatch/*")) - before
    assert len(new) == 1 and "pipeline-result" in new.pop() and out.count() > 0


@pytest.fixture(scope="module")
def odd(spark):
    fine = " ".join(f"word{i} number{i}" for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, fine + " q", "en", "a", None), (3, fine, "en", None, 1), (3, fine, "en", None, 1), (4, fine + " 4111111111111111", "en", "a", 3), (5, "long " + fine * 400, "en", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("mine") for c in ("fp", "component_id", "kept", "c", "n_words", "found", "__first", "first", "row", "bad", "a.b")})


def test_stages_on_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        if name != "pieces":
            assert out.columns == odd.columns
        out.collect()
        assert stage(spark, odd.limit(0), SF).collect() == []
    kept = corpus_pipeline.quality_rules(spark, odd, SF)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "4", "None"]
    once = corpus_pipeline.near_dedup(spark, kept, SF)
    assert {str(r["doc_id"]) for r in once.collect()} <= {"3", "4", "None"} and once.where("doc_id = 3").count() == 1
    assert rows_of(corpus_pipeline.decontamination(spark, once, SF)) == rows_of(once)


def test_clean_documents_stay(spark):
    """Of labelled good documents none is lost but copies, leaks and those that fail the base rules."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    m = quality.judged(docs).join(good, "doc_id").where("NOT base_failed")
    assert m.where("kept").count() >= 0.99 * m.count()
