"""Incremental matching: what is done already is skipped, and new files flow through the matcher.

``remaining`` is the restart rule: an anti join with what has been written. ``stream_matches`` reads a folder as a stream,
takes all files that are there (``availableNow``), and hands each micro-batch to a matcher; the checkpoint remembers the
files, so a restart goes on where the last run ended, and a batch that runs again replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.sources.files import RECORDS


def remaining(anchors: DataFrame, done: DataFrame, key: str = "entity_id") -> DataFrame:
    """Anchors that no written result (s1_id) has."""
    return anchors.join(done.select(F.col("s1_id").alias(key)).distinct(), key, "left_anti")


def finished_countries(anchors: DataFrame, done: DataFrame) -> DataFrame:
    """Countries of which every anchor has a result."""
    seen = done.select(F.col("s1_id").alias("entity_id"), F.lit(1).alias("seen")).distinct()
    both = anchors.select("entity_id", "country").join(seen, "entity_id", "left")
    return both.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.count("seen").alias("n_done")).where("n = n_done").select("country", "n")


def stream_matches(spark: SparkSession, folder: str, out: str, checkpoint: str, match: Callable[[DataFrame], DataFrame], files_per_batch: int = 8) -> None:
    """Runs ``match`` over the anchors of all new files in ``folder`` and writes what it returns as Parquet."""

    def batch(rows: DataFrame, number: int) -> None:
        match(rows).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(RECORDS).option("sep", "\t").option("header", True).option("quote", "").option("maxFilesPerTrigger", files_per_batch).csv(folder)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
