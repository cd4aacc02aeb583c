"""Units of the engine that no SQL covers: files, restart, streams, models, invariants."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinmatch.functions import sums
from kinmatch.operators import blockers, blocking, ensemble, evaluate, rules
from kinmatch.operators import features as ft
from kinmatch.operators import records as r
from kinmatch.plans import fixture as fx
from kinmatch.plans import match
from kinmatch.sources import files
from kinmatch.streaming import incremental

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rec(spark):
    return fx.records(spark, SF).cache()


def lists(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, ids array<string>")


def test_f05_vectors(spark):
    true = lists(spark, [("a", ["S2-47", "S3-812"]), ("b", []), ("c", []), ("d", ["S2-1"])])
    pred = lists(spark, [("a", ["S2-47", "S2-193", "S3-812"]), ("c", ["S2-1"])])
    got = {x["s1_id"]: x["f05"] for x in evaluate.per_entity(true, pred).collect()}
    assert got["a"] == pytest.approx(0.714, abs=5e-4) and got["b"] == 1 and got["c"] == 0 and got["d"] == 0
    three = evaluate.per_entity(true.where("s1_id <> 'd'"), pred)
    assert evaluate.macro(three).first()["macro_f05"] == pytest.approx(0.5714, abs=1e-4)
    assert evaluate.macro(three.limit(0)).first()["macro_f05"] == 0


def test_a_match_scores_above_a_stranger(spark):
    rows = [("S1-1", "Moran Staffing LLC", "1902 Shamrock Road, Dothan, AL", "US"), ("S2-1", "Moran Seaffng LLC", "1902 Shamrock Rd, Dothan, Alabama", "US"), ("S3-1", "Totally Different Corp", "999 Other Street, NYC, NY", "US")]
    rec = r.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    found = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1")], "s1_id string, cand_id string")
    got = {x["cand_id"]: x for x in ft.featurized(ft.pairs(found, rec)).collect()}
    for f in ("name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "addr_jaccard", "addr_number_match"):
        assert got["S2-1"][f] > got["S3-1"][f]
    assert len(ft.FEATURE_NAMES) == 25 and len(set(ft.FEATURE_NAMES) | set(ft.EXTRA_NAMES)) == 28


def test_records_with_missing_values(spark):
    rows = [("S1-1", None, None, "US"), ("S2-1", "null", "", "US"), (None, "x", "y", "US"), ("S3-1", "x", "y", None), ("S3-x", "x", "y", " US ")]
    got = {x["entity_id"]: x for x in r.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")).collect()}
    assert set(got) == {"S1-1", "S2-1", "S3-x"} and got["S1-1"]["norm_name"] == got["S2-1"]["norm_name"] == "" and got["S2-1"]["name_tokens"] == [] and got["S3-x"]["country"] == "US"


def test_blocking_invariants(spark, rec):
    out = blocking.candidates(r.anchors(rec), r.pool(rec), blockers.IDF_TOP15)
    assert out.where("rank > 15 OR score < 1.5").isEmpty()
    assert out.count() == out.select("s1_id", "cand_id").distinct().count()
    assert out.join(rec.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c")), "s1_id").where("c <> country").isEmpty()
    assert blocking.with_all_anchors(r.anchors(rec), out).count() == r.anchors(rec).count()


def test_results_do_not_depend_on_partitions(spark, rec):
    a = {tuple(x) for x in blocking.candidates(r.anchors(rec), r.pool(rec), blockers.INTEGER_TOP15).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = {tuple(x) for x in blocking.candidates(r.anchors(rec.repartition(7)), r.pool(rec.repartition(3)), blockers.INTEGER_TOP15).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_a_hot_key_costs_its_cap(spark):
    """A third of the pool shares a word: the list is cut before the join."""
    rows = [(f"S1-{i}", "acme", f"{i} way", "US") for i in range(20)] + [(f"S2-{i}", "acme" if i % 3 == 0 else f"firm{i}", f"{i} way", "US") for i in range(3000)]
    rec = r.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    spec = blocking.Spec((blocking.Postings("name", ("name_word",), cap=50),), (blocking.Probe("name", "name_word", blocking.Weight(1)),), None)
    assert blocking.index(r.pool(rec), spec).where("key = 'acme'").count() == 50
    out = blocking.candidates(r.anchors(rec), r.pool(rec), spec)
    assert out.count() == 20 * 50 and out.agg(F.max("cand_ord")).first()[0] == 147
    for s in (spec, blockers.IDF_TOP15, blockers.INTEGER_TOP50, blockers.RULE_V3):
        plan = blocking.index(r.pool(rec), s)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") >= 1, "parts of a list are limited before they are shuffled"


def test_pairs_are_summed_where_they_meet(spark, rec, monkeypatch):
    """No shuffle has a row for each pair, and parts of anchors and blocks of candidates don't change the result."""
    run = lambda: blocking.candidates(r.anchors(rec), r.pool(rec), blockers.INTEGER_TOP15)
    plan = run()._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(s1_id#\d+, cand_id#", plan)
    want = {tuple(x) for x in run().collect()}
    for name, v in (("CELL", 2000), ("MOST_PROBES", 500), ("LEAST_PROBES", 40)):
        monkeypatch.setattr(blocking, name, v)
    parts, blocks = blocking.cells(1000, 5000, 100)
    assert parts > 1 and blocks > 1
    assert {tuple(x) for x in run().collect()} == want


def test_sums_of_lists():
    lists = pa.table({"country": ["x"] * 3, "name": ["n"] * 3, "key": ["a", "b", "a"], "source": ["S2", "S2", "S3"], "df": [3, 9, 1], "idf": [2.0, 1.0, 0.5], "nos": [[7, 5, 5], [9, 5], [4]]})
    row = {"s1_id": "A", "s1_ord": 1, "country": "x", "name": "n", "factor": 1.5, "over": None}
    probes = pa.Table.from_pylist([row | {"key": "a", "by_idf": True}, row | {"key": "b", "by_idf": False}, row | {"key": "none", "by_idf": True}, row | {"key": "b", "by_idf": False, "over": 8}])
    got = lambda *a: [(x["no"], x["source"], x["score"], x["rank"]) for x in sums.best_sums(probes, lists, *a).to_pylist()]
    assert got(2, None, None, True) == [(5, "S2", 7.5, 1), (7, "S2", 3.0, 2), (4, "S3", 0.75, 1)]
    assert got(9, None, None, False) == [(5, "S2", 7.5, 1), (7, "S2", 3.0, 2), (9, "S2", 1.5, 3), (4, "S3", 0.75, 4)]
    assert got(9, 1.0, 2, True) == [(5, "S2", 7.5, 1)] and sums.best_sums(probes[:0], lists, 9, None, None, True).num_rows == 0


def test_files_round_trip(spark, rec, tmp_path):
    raw = fx.entities(spark, SF).select("entity_id", "business_name", "business_address", "country")
    path = str(tmp_path / "in")
    raw.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    back = files.read_records(spark, path)
    assert back.count() == raw.count() == files.count_rows(spark, path) and files.read_records(spark, path, limit=5).count() == 5
    assert files.read_records(spark, path, columns=("entity_id",), from_header=True).columns == ["entity_id"]
    files.write_partitions(back, str(tmp_path / "parts"))
    us = files.read_partition(spark, str(tmp_path / "parts"), "US", "s1")
    assert us.count() == back.where("country = 'US' AND entity_id LIKE 'S1-%'").count()
    own, found = r.anchors(rec), blocking.candidates(r.anchors(rec), r.pool(rec), blockers.INTEGER_TOP15)
    files.write_results(own, found.where("score >= 20"), found, str(tmp_path / "out"))
    m, k = (files.read_results(spark, str(tmp_path / "out" / n)) for n in ("matching_results", "candidate_pairs"))
    order = own.orderBy("ord").select("entity_id").toPandas()["entity_id"].tolist()
    assert m.orderBy("ord").toPandas()["s1_id"].tolist() == order
    ids = spark.createDataFrame(list(enumerate(order)), "ord long, s1_id string")
    assert evaluate.audit(ids, m, k).first()["passed"]
    assert not evaluate.audit(ids, k, m).first()["subset"]
    assert not evaluate.audit(ids, m.where("ord > 0"), k).first()["passed"]
    assert files.headers(spark, str(tmp_path / "out"))
    spark.range(1).withColumn("x", F.lit("y")).write.mode("overwrite").option("sep", "\t").option("header", True).csv(str(tmp_path / "out" / "candidate_pairs"))
    assert not files.headers(spark, str(tmp_path / "out"))


def test_bad_lines(spark, tmp_path):
    (tmp_path / "x.tsv").write_bytes(b"entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA\"b\t\tUS\nS1-2\tcaf\xff\t1 way\tUS\nS1-3\tno country\t2 way\t\n\tno id\t3\tUS\nshort\n")
    got = {x["entity_id"]: x for x in files.read_records(spark, str(tmp_path / "x.tsv")).collect()}
    assert set(got) == {"S1-1", "S1-2"} and got["S1-1"]["business_name"] == 'A"b' and got["S1-1"]["business_address"] == ""
    (tmp_path / "t.tsv").write_text("s1\tids\nS1-1\tS2-1, S3-2,,S2-1\nS1-2\t\nS1-3\n")
    assert {x["s1_id"]: x["ids"] for x in files.read_lists(spark, str(tmp_path / "t.tsv")).collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}


def test_restart_and_stream(spark, rec, tmp_path):
    own = r.anchors(rec)
    done = own.where("ord % 2 = 0").select(F.col("entity_id").alias("s1_id"))
    left = incremental.remaining(own, done)
    assert left.count() + done.count() == own.count() and incremental.finished_countries(own, own.select(F.col("entity_id").alias("s1_id"))).count() == 3
    raw = own.select("entity_id", "business_name", "business_address", "country").repartition(3)
    folder = str(tmp_path / "arrivals")
    raw.write.option("sep", "\t").option("header", True).option("quote", "").csv(folder)
    pool = r.pool(rec)

    def run(rows):
        return blocking.candidates(r.anchors(r.normalised(rows)), pool, blockers.INTEGER_TOP15)

    for _ in range(2):  # the second run finds nothing new
        incremental.stream_matches(spark, folder, str(tmp_path / "out"), str(tmp_path / "cp"), run, 2)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert {tuple(x) for x in got.collect()} == {tuple(x) for x in run(raw).collect()}


def test_gate_loses_nothing(spark, rec, tmp_path):
    with pytest.raises(ValueError, match="gate"):
        ensemble.check_gate(0.45)
    ensemble.check_gate(0.82)
    truth = evaluate.listed(r.anchors(rec), fx.true_pairs(spark, SF))
    small = ensemble.Settings(iterations=5, depth=3, trees=5)
    bundle = match.train(rec, truth, str(tmp_path / "rows"), small, blockers.INTEGER_TOP15)
    assert set(bundle.thresholds) <= {"US", "France", "India"} and bundle.of("Peru") == "US"
    rows = spark.read.parquet(str(tmp_path / "rows"))
    gated, full = (ensemble.score(rows, bundle, g) for g in (0.2, None))
    keep = lambda d: {(x["s1_id"], x["cand_id"]) for x in d.where("p >= 0.66").collect()}
    assert gated.count() == rows.count() and keep(gated) == keep(full) and gated.where("p < 0 OR p > 1").isEmpty()
    bundle.save(spark, str(tmp_path / "model"))
    again = ensemble.Bundle.load(spark, str(tmp_path / "model"))
    assert again.thresholds == bundle.thresholds
    assert ensemble.score(rows, again).agg(F.round(F.sum("p"), 6)).first() == gated.agg(F.round(F.sum("p"), 6)).first()
    assert len(ensemble.importances(bundle.models["US"][0])) == 10
    bundle.thresholds = {k: max(v, 0.82) for k, v in bundle.thresholds.items()}
    sources = fx.entities(spark, SF)
    check = match.predict(spark, sources, bundle, str(tmp_path / "out"), str(tmp_path / "work"), blockers.INTEGER_TOP15).first()
    assert check["passed"] and check["n"] == r.anchors(rec).count()


def test_baseline_and_profile(spark, rec):
    from kinmatch.plans import profile

    truth = evaluate.listed(r.anchors(rec), fx.true_pairs(spark, SF))
    rows = match.training_matrix(rec.where("country = 'France'"), truth, blockers.INTEGER_TOP15).cache()
    model = ensemble.baseline(rows, ensemble.Settings(iterations=3, depth=3))
    assert len(ensemble.importances(model)) == 10 and "probability" in model.transform(rows).columns
    got = profile.timed(rec, [("anchors", r.anchors), ("names", lambda d: d.select("norm_name").distinct())])
    assert [x[0] for x in got] == ["anchors", "names"] and got[0][2] == r.anchors(rec).count() and all(x[1] > 0 for x in got)


def test_training_sample_and_split(spark, rec):
    truth = evaluate.listed(r.anchors(rec), fx.true_pairs(spark, SF))
    some, kept = ensemble.training_rows(r.anchors(rec), r.pool(rec), truth, n_anchors=100, distractors=0.1)
    need = truth.join(some.select(F.col("entity_id").alias("s1_id")), "s1_id").select(F.explode("ids").alias("entity_id")).distinct()
    assert 60 < some.count() < 140 and need.join(kept, "entity_id", "left_anti").isEmpty() and kept.count() < r.pool(rec).count()
    rows = truth.select("s1_id")
    a, b = ensemble.split(rows)
    assert a.count() + b.count() == rows.count() and 0.08 < b.count() / rows.count() < 0.25


def test_rules_tables(spark):
    rows = [(n, a, m, x) for n in (10.0, 25.0, 35.0, 57.0, 72.0, 90.0) for a in (0.0, 61.0, 66.0, 71.0, 76.0, 81.0, 86.0) for m, x in ((True, False), (False, True), (False, False))]
    df = spark.createDataFrame(rows, "n double, a double, m boolean, x boolean")
    cols = [F.col(c) for c in ("n", "a", "m", "x")]
    got = {(r_["n"], r_["a"], r_["m"], r_["x"]): (r_["v2"], r_["v3"]) for r_ in df.select("*", rules.score_v2(*cols).alias("v2"), rules.score_v3(*cols).alias("v3")).collect()}
    assert got[90.0, 0.0, False, True] == (0, 95) and got[72.0, 61.0, False, False] == (90, 90) and got[72.0, 0.0, True, False] == (85, 88) and got[72.0, 0.0, False, False] == (65, 68)
    assert got[57.0, 71.0, False, False] == (0, 82) and got[57.0, 76.0, False, False] == (80, 82) and got[35.0, 66.0, True, False] == (60, 0) and got[25.0, 71.0, True, False] == (0, 70)
    assert got[35.0, 86.0, False, False] == (50, 65) and got[10.0, 81.0, True, False] == (85, 85) and got[10.0, 86.0, False, True] == (0, 0)


def test_completion_keeps_the_best_of_a_source(spark, monkeypatch):
    """Places are counted among the other source's candidates only, and no row is made for each pair."""
    rows = [("S1-1", "acme roofing supply", "12 elm way", "US")]
    rows += [(f"S2-{i}", "acme roofing supply", "12 elm way", "US") for i in range(2, 12)]
    rows += [(f"S3-{i}", "acme roofing supply", "12 elm way" if i > 22 else "elm way", "US") for i in range(20, 30)]
    rec = r.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    own, pool = r.anchors(rec), r.pool(rec)
    matched = spark.createDataFrame([("S1-1", "S2-2")], "s1_id string, cand_id string")
    monkeypatch.setattr(blocking, "_all_pairs", lambda *a: pytest.fail("a row for each pair"))
    run = lambda: sorted(x["cand_id"] for x in rules.complete_sources(own, pool, rec, matched).collect())
    assert run() == ["S3-23", "S3-24", "S3-25"]
    for name, v in (("CELL", 8), ("MOST_PROBES", 2), ("LEAST_PROBES", 1)):
        monkeypatch.setattr(blocking, name, v)
    assert run() == ["S3-23", "S3-24", "S3-25"]


def test_closure_is_idempotent(spark):
    rows = [("a", "S2-1", "S2", 0.9, "x", "p"), ("a", "S3-1", "S3", 0.1, "x", "p"), ("a", "S3-2", "S3", 0.1, "x", ""), ("a", "S3-3", "S3", 0.1, "x", "q"), ("b", "S3-1", "S3", 0.1, "x", "p"), ("a", "S2-2", "S2", 0.7, "y", "r"), ("a", "S3-4", "S3", 0.1, "y", "r")]
    s = spark.createDataFrame(rows, "s1_id string, cand_id string, source string, p double, b_norm_name string, b_norm_addr string")
    ok = s.where("p >= 0.7")
    more = rules.closure(s, ok)
    assert {x["cand_id"] for x in more.collect()} == {"S3-1", "S3-2"}
    assert {x["cand_id"] for x in rules.closure(s, ok, strict=True).collect()} == {"S3-1"}
    assert {x["cand_id"] for x in rules.closure(s, ok, None).collect()} == {"S3-1", "S3-2", "S3-4"}
    assert rules.closure(s, blocking.union(ok, more)).isEmpty()


def test_rule_gate(spark, rec):
    truth = evaluate.listed(r.anchors(rec), fx.true_pairs(spark, SF))
    assert match.match_by_rules(rec, 3).count() == truth.count()
    with pytest.raises(ValueError, match="under"):
        match.match_by_rules(rec, 2, truth, least=1.01)


def test_truth_by_classes_equals_its_pairs(spark):
    """Counts, hits and missed pairs by class against all pairs, with repeated rows, null classes and an id in two classes."""
    ids = [(f"S{1 + i % 3}-{i}", f"g{i % 5}" if i % 7 else None) for i in range(60)]
    ids += ids[:9] + [("S1-3", "g1"), ("S1-3", "g4"), ("S2-4", "g0"), ("S3-5", "g2")]
    members = spark.createDataFrame([(e, e[:2], "US", g) for e, g in ids], "entity_id string, source string, country string, gk string")
    true = sorted({(a, b) for a, g in ids for b, h in ids if a[:2] == "S1" and b[:2] != "S1" and g is not None and g == h})
    names = sorted({e for e, _ in ids})
    records = spark.createDataFrame([(e, e[:2], f"n{e}", f"a{e}") for e in names], "entity_id string, source string, business_name string, business_address string")
    own = records.where("source = 'S1'")
    found = spark.createDataFrame([*((a, b, 1 + i % 30) for i, (a, b) in enumerate(true) if i % 3), ("S1-0", "S2-1", 2), ("S1-6", "S9-9", 1)], "s1_id string, cand_id string, rank int")
    classes = evaluate.Classes.of(members, ("country", "gk"))
    assert classes.mixed.count() >= 2
    lists, pred = evaluate.listed(own, spark.createDataFrame(true, "s1_id string, cand_id string")), evaluate.listed(own, found)
    rows = lambda df: sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    assert rows(evaluate.per_entity_by_class(own, classes, found)) == rows(evaluate.per_entity(lists, pred))
    assert rows(evaluate.recall_by_class(classes, found)) == rows(evaluate.recall(lists, found))
    assert rows(evaluate.recall_at_by_class(classes, found)) == rows(evaluate.recall_at(lists, found))
    want = rows(evaluate.missed(lists, pred, records))
    cells, evaluate.CELL_PAIRS = evaluate.CELL_PAIRS, 4  # classes are dealt into squares
    try:
        assert rows(evaluate.missed_by_class(classes, found, records)) == want and want
    finally:
        evaluate.CELL_PAIRS = cells
    assert not evaluate.recall_at_by_class(evaluate.Classes.of(members.where("false"), ("country", "gk")), found).collect()
