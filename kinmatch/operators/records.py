"""Normalised records: what blocking, features and rules work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.functions import text as t

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")


def ordinal(entity_id):
    """A record's place among the others, from its id and not from partitions: the digits after the source's mark."""
    return F.coalesce(F.regexp_extract(entity_id, r"(\d+)$", 1).try_cast("long"), F.xxhash64(entity_id))


def normalised(sources: DataFrame) -> DataFrame:
    """entity_id, ord, source, country, the raw name and address, and the normalised forms and tokens, for rows with an id
    and a country. Empty values are empty texts, never null. Names and addresses of any script are read in ASCII, both in
    one trip to Python; texts that are ASCII but for marked Latin letters don't make it."""
    raw = sources.select(*[t.text_or_empty(F.col(c)).alias(c) for c in SOURCE_COLUMNS])
    raw = raw.where((F.trim("entity_id") != "") & (F.trim("country") != ""))
    raw = raw.select("*", t.in_ascii(F.col("business_name")).alias("n"), t.in_ascii(F.col("business_address")).alias("a"))
    out = raw.select(
        F.trim("entity_id").alias("entity_id"), F.trim("country").alias("country"), "business_name", "business_address",
        t.norm_name(F.col("n"), False).alias("norm_name"), t.norm_addr(F.col("a"), False).alias("norm_addr"),
        t.light_text(F.col("n"), True, False).alias("light_name"), t.light_text(F.col("a"), False, False).alias("light_addr"),
    )
    return out.select(
        "*", ordinal(F.col("entity_id")).alias("ord"), F.left("entity_id", F.lit(2)).alias("source"),
        t.name_tokens(F.col("norm_name")).alias("name_tokens"), t.tokens(F.col("norm_addr")).alias("addr_tokens"), t.numbers(F.col("business_address")).alias("addr_numbers"),
    )


def anchors(records: DataFrame) -> DataFrame:
    return records.where(F.col("source") == "S1")


def pool(records: DataFrame) -> DataFrame:
    return records.where(F.col("source") != "S1")


def by_country(records: DataFrame) -> dict[str, DataFrame]:
    """A frame for each country; countries are few and known from a distinct."""
    names = sorted(r["country"] for r in records.select("country").distinct().collect())
    return {n: records.where(F.col("country") == n) for n in names}
