import pytest
from pyspark.sql import functions as F

from kinmatch.llm import registry, shards
from tests.llm.helpers import rows_of, same

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    want = same(registry.op3_shards(spark, SF), registry.oracle_sql()["op3_shards"], SF, "documents")
    assert len(want) == 1000


def test_tiers_versions_and_files(spark, tmp_path):
    store = shards.ShardStore(spark, str(tmp_path / "s"), target_bytes=400_000, fan_in=3)
    part = lambda k: spark.range(k * 1000, (k + 1) * 1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(2)
    merges = []
    for k in range(9):
        assert store.append(part(k)) == store.manifest()["version"]
        merges.append(store.compact())
    assert merges[:3] == [0, 0, 1] and sum(merges) >= 3
    m = store.manifest()
    assert m["version"] == 9 + sum(merges) and sum(r["rows"] for r in m["runs"]) == 9000
    assert all(len(t) < 3 for t in store.tiers(m["runs"]))
    merged = [f["bytes"] for r in m["runs"] if store.sealed(r) for f in r["files"]]
    assert merged and all(200_000 <= b < 800_000 for b in merged)
    assert store.read().orderBy("id").select("id").toPandas()["id"].tolist() == list(range(9000))
    assert store.read(2).count() == 2000  # an older state can still be read
    assert store.vacuum(keep=1) > 0 and store.versions() == [m["version"]] and store.read().count() == 9000


def test_a_taken_version_is_not_overwritten(spark, tmp_path):
    store = shards.ShardStore(spark, str(tmp_path / "s"))
    store.append(spark.range(10))
    m = store.manifest()
    with pytest.raises(shards.Conflict):
        store._commit(m | {"runs": []})
    assert store.manifest() == m and store.read().count() == 10
    with pytest.raises(shards.Conflict):
        store._change([], ["gone"])
    with pytest.raises(ValueError, match="schema"):
        store.append(spark.range(3).select(F.col("id").cast("string")))


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "long " * 200000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bytes int").withColumn("version", F.lit("v")).withColumn("a=b", F.lit(None).cast("string"))
    store = shards.in_arrivals(docs, str(tmp_path / "s"), n_arrivals=5)
    assert rows_of(store.read()) == rows_of(docs)
    assert shards.in_arrivals(docs.limit(0), str(tmp_path / "e"), n_arrivals=5).read().collect() == []
    with pytest.raises(ValueError, match="arrivals"):
        store.stage(docs.withColumn("k", F.lit(9)), "k", range(3))


def test_a_column_named_like_the_arrivals_is_kept(spark, tmp_path):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), (F.col("id") * 2).alias("__arrival"))
    store = shards.in_arrivals(docs, str(tmp_path / "clash"), 4)
    assert store.read().columns == docs.columns and {tuple(r) for r in store.read().collect()} == {tuple(r) for r in docs.collect()}
