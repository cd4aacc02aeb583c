import os
import zlib

from pyspark.sql import functions as F

from kinmatch.llm import base


def test_tables_in_the_shared_folder(spark):
    df = spark.range(10)
    t = base.written(df, "numbers")
    assert t.count() == 10 and t.dtypes == df.dtypes
    root = base.shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir") and os.listdir(f"{root}/kinmatch")
    assert base.written(df.limit(0), "none").collect() == []
    base.cleared(spark)
    assert not os.path.exists(f"{root}/kinmatch")


def test_broadcast_only_what_fits(spark, monkeypatch):
    t = base.written(spark.range(100), "hundred")
    plan = lambda d: d._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(base.small(t, 16))
    monkeypatch.setattr(base, "BROADCAST_BYTES", 100 * 16 - 1)
    assert "broadcast" not in plan(base.small(t, 16))


def test_folds(spark):
    row = spark.createDataFrame([(5, None)], "i long, j long").select(base.crc_fold(F.col("i"), 4).alias("f"), base.crc_fold(F.col("j"), 4).alias("g")).first()
    assert row["f"] == zlib.crc32(b"5") % 4 and row["g"] == 0
