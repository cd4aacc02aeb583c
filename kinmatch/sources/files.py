"""Delimited sources and sinks: records, truth and predictions, partitions by country, ordered result files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinmatch.operators.records import SOURCE_COLUMNS, ordinal

RECORDS = StructType([StructField(x, StringType()) for x in SOURCE_COLUMNS])


def read_records(spark: SparkSession, path: str | list[str], limit: int | None = None, columns: tuple[str, ...] = SOURCE_COLUMNS, from_header: bool = False) -> DataFrame:
    """Tab-separated records. Bytes that are no UTF-8 are replaced, quotes are text. ``from_header``: columns are found by
    the header's names; else they are taken by place. Rows without an id or country don't count; an empty address does."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    df = reader.csv(path) if from_header else reader.schema(RECORDS).option("enforceSchema", True).csv(path)
    df = df.select(*[F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c) for c in SOURCE_COLUMNS])
    df = df.where((F.col("entity_id") != "") & (F.col("country") != "")).select(*columns)
    return df.limit(limit) if limit is not None else df


def count_rows(spark: SparkSession, path: str) -> int:
    """Lines behind the header."""
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(RECORDS).csv(path).count()


def ids_of(x: Column) -> Column:
    """The ids of a comma list: trimmed, each once, none for null or empty."""
    parts = F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda v: F.trim(v))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda v: v != "")))


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids) of a truth, prediction or candidate file: an id and a comma list, which may be empty or missing."""
    schema = StructType([StructField("s1_id", StringType()), StructField("list", StringType())])
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(schema).csv(path)
    return df.where(F.trim(F.coalesce("s1_id", F.lit(""))) != "").select(F.trim("s1_id").alias("s1_id"), ids_of(F.col("list")).alias("ids"))


def write_partitions(records: DataFrame, path: str) -> None:
    """Records in a folder for each country and side (anchors, pool). No shuffle: each task writes to the folders it has
    rows for; a country that holds most rows is written by all tasks."""
    side = F.when(F.col("entity_id").startswith("S1-"), "s1").otherwise("pool")
    records.withColumns({"side": side, "partition_country": F.col("country")}).write.partitionBy("partition_country", "side").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").mode("overwrite").csv(path)


def read_partition(spark: SparkSession, path: str, country: str, side: str) -> DataFrame:
    return read_records(spark, f"{path}/partition_country={country}/side={side}")


def aligned(anchors: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """(ord, source1_entity_id, <name>): every anchor once, its ids sorted and joined by commas, empty for none."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias(name))
    own = anchors.select("ord" if "ord" in anchors.columns else ordinal(F.col("entity_id")).alias("ord"), "entity_id")
    out = own.join(lists, own["entity_id"] == lists["s1_id"], "left")
    return out.select("ord", F.col("entity_id").alias("source1_entity_id"), F.coalesce(name, F.lit("")).alias(name))


def write_results(anchors: DataFrame, matches: DataFrame, candidates: DataFrame, path: str) -> None:
    """Two tab-separated tables in the anchors' order, one file each: ``matching_results`` and ``candidate_pairs``."""
    for pairs, folder, name in ((matches, "matching_results", "matched_entity_ids"), (candidates, "candidate_pairs", "candidate_entity_ids")):
        rows = aligned(anchors, pairs, name).orderBy("ord", "source1_entity_id").drop("ord")
        rows.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(f"{path}/{folder}")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(ord, s1_id, ids) of a written result, ``ord`` its row's place."""
    schema = StructType([StructField("s1_id", StringType()), StructField("list", StringType())])
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(schema).csv(path)
    return df.select(F.monotonically_increasing_id().alias("ord"), F.coalesce("s1_id", F.lit("")).alias("s1_id"), ids_of(F.col("list")).alias("ids"))


def headers(spark: SparkSession, path: str) -> bool:
    """Whether both written result tables have the columns that they must have, in order."""
    want = {"matching_results": ["source1_entity_id", "matched_entity_ids"], "candidate_pairs": ["source1_entity_id", "candidate_entity_ids"]}
    return all(spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(f"{path}/{folder}").columns == names for folder, names in want.items())


def package(spark: SparkSession, path: str, about: dict) -> str:
    """Writes a description beside the results; the folder is the package. Returns its path."""
    spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path
