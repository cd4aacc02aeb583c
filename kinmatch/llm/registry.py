"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import attention, chat, decontaminate, language, pieces, pii, quality, shards, simhash, tokencount
from kinmatch.llm.base import new_path, table


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key=pii.published_or_own(spark), found_col="found")
    return out.select("doc_id", F.size(F.filter("found", lambda x: x["value"].isNotNull())).cast("long").alias("n_values"), "text")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.formatted(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last version of a store that documents came to in arrivals."""
    store = shards.in_arrivals(table(spark, sf_dir, "documents"), new_path(spark, "shards"))
    return store.read().select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "n_chars")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives the text back."""
    out = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), check_col="round_trip")
    return out.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text and of a revision of it, the second from the first's tree."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("edits", tokencount.revision(F.col("doc_id"), F.col("text")))
    return tokencount.recounted(docs).select("doc_id", "counted.*")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    out = language.labelled(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op9_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~attention.held_out(F.col("doc_id"))
    model = attention.train(docs.where(learn), table(spark, sf_dir, "labels").select("doc_id", "quality").where(learn))
    out = attention.scored(docs, model)
    return out.select("doc_id", attention.held_out(F.col("doc_id")).alias("held_out"), "quality.score", "quality.predicted")


def queries() -> dict:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run, "op9_attention": op9_attention, "op8_language": op8_language, "op4_tokens": op4_tokens, "op6_pieces": op6_pieces, "op3_shards": op3_shards, "op1_chat": op1_chat, "op2_decontaminate": op2_decontaminate, "op10_pii": op10_pii, "op5_simhash": op5_simhash, "op7_quality": op7_quality}


def oracle_sql() -> dict[str, str]:
    return {"op3_shards": shards.SQL, "op1_chat": chat.sql(), "op2_decontaminate": decontaminate.sql(), "op10_pii": pii.sql(), "op7_quality": quality.sql()}
