"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

  quality        rows that fail the base rules or lie beyond their language's and source's thresholds go
  near_dedup     one document of each group of near duplicates (SimHash, completed by an index of prefixes; links have a
                 Jaccard similarity of the five-word shingles of 0.8 or more, exact) stays, the one with the smallest id
  decontaminate  documents that hold a benchmark item go
  pii            validated numbers, dates and addresses in the texts become pseudonyms; n_chars follows
  pieces         piece ids of each text, and whether they decode to it

All stages but the last return the columns of documents. Each handles null and empty texts, repeated rows, empty tables
and further columns as its operator says; null and empty texts fail the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import decontaminate, jaccard, pieces, pii, quality
from kinmatch.llm.base import new_path, scratch, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.pseudonymised(docs, key=pii.published_or_own(spark))
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in out.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pieces.encoded(docs, check_col="round_trip")
    return out.select("doc_id", "text", "lang", "source", "n_chars", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontamination), ("pii", pseudonyms), ("pieces", encoding)]

#: The pieces need a tokenizer, which DuckDB's SQL has not; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, as a table in the shared folder; what the stages wrote on the way is deleted."""
    docs = table(spark, sf_dir, "documents")
    result = new_path(spark, "pipeline-result")
    with scratch(spark):
        for k, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = written(docs, f"pipeline-{name}")
        docs.write.parquet(result)
    return spark.read.schema(docs.schema).parquet(result)
