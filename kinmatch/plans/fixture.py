"""Business records for the registered queries, drawn from the table documents, which has noisy and repeated texts.

Each document gives one record: its id's remainder by three is the source, its first words the name, the length of its
first line and the next words the address, its language the country. Truth: anchors and pool records of one country whose
texts begin with the same forty characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.operators import records as r
from kinmatch.operators.evaluate import Classes
from kinmatch.sources.shared import written

_SPARK = r"""
select concat(case when doc_id % 3 = 0 then 'S1-' when doc_id % 3 = 1 then 'S2-' else 'S3-' end, cast(doc_id as string)) entity_id,
  concat_ws(' ', slice(w, 1, 4)) business_name, concat(cast(length(split(text, '\n')[0]) as string), ' ', concat_ws(' ', slice(w, 5, 4))) business_address,
  case lang when 'en' then 'US' when 'fr' then 'France' else 'India' end country, left(regexp_replace(text, '[ \n\t]+', ' '), 40) gk
from (select *, split(trim(regexp_replace(text, '[ \n\t]+', ' ')), ' ') w from {documents})"""

#: The same in DuckDB, for the queries' SQL.
ENTITIES_SQL = r"""ents AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'S1-' WHEN doc_id % 3 = 1 THEN 'S2-' ELSE 'S3-' END || CAST(doc_id AS VARCHAR) AS entity_id,
  array_to_string(w[1:4], ' ') AS business_name, CAST(length(string_split(text, chr(10))[1]) AS VARCHAR) || ' ' || array_to_string(w[5:8], ' ') AS business_address,
  CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'France' ELSE 'India' END AS country, left(regexp_replace(text, '[ \n\t]+', ' ', 'g'), 40) AS gk
  FROM (SELECT *, string_split(trim(regexp_replace(text, '[ \n\t]+', ' ', 'g')), ' ') AS w FROM documents))"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return spark.sql(_SPARK, documents=docs)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised once and written, as the engine does it: the key families, frequencies and features read their own columns."""
    return written(r.normalised(entities(spark, sf_dir)), "records")


def classes(spark: SparkSession, sf_dir: str) -> Classes:
    """The truth of true_pairs() by its classes, which are no larger than the table."""
    return Classes.of(entities(spark, sf_dir).select("entity_id", F.left("entity_id", F.lit(2)).alias("source"), "country", "gk"), ("country", "gk"))


def true_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir).select("entity_id", "country", "gk")
    a = e.where("entity_id like 'S1-%'").selectExpr("entity_id as s1_id", "country", "gk")
    b = e.where("entity_id not like 'S1-%'").selectExpr("entity_id as cand_id", "country", "gk")
    return a.join(b, ["country", "gk"]).select("s1_id", "cand_id")
