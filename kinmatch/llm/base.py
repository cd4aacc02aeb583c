"""What the corpus operators share: shared-folder tables, shipping the package to executors, reading tables."""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.sources import shared
from kinmatch.sources.shared import shared_dir

#: Bytes a broadcast table may have before it is joined by a shuffle instead.
BROADCAST_BYTES = 64 << 20


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/kinmatch/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    for paths in _open:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that written() has made inside of it."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.remove(paths)
        for p in paths:
            _delete(spark, p)


def cleared(spark: SparkSession) -> None:
    """Deletes what the operators have written to the shared folder, through Hadoop's file system layer. Only for when no
    result of theirs is still to be read."""
    _delete(spark, f"{shared_dir(spark)}/kinmatch")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, marked for a broadcast if its counted rows are proven to fit; else as it is, for a join by shuffle. df should
    be a written table, as its rows are counted here."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ship(spark: SparkSession, small_batches: bool = False) -> None:
    """Makes this package importable in the executors' Python workers, once for each application. ``small_batches``: a
    thousand texts go to a worker at a time, if the session leaves Spark's own number unchanged."""
    if small_batches and spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    shared.ship(spark)


def let_go() -> None:
    """For a Python worker at the start of a task: drops what an encoder remembers between its own tasks. Workers serve one
    stage after another, and its words would take room beside the next stage's work."""
    pieces = sys.modules.get("kinmatch.llm.pieces")
    if pieces is not None and pieces._loaded:
        pieces._loaded.clear()
        gc.collect()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
