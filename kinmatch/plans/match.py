"""End to end: block, score, decide, close, write. One plan for training and inference, with one blocker for both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.functions import constants as c
from kinmatch.operators import blockers, blocking, ensemble, evaluate, rules
from kinmatch.operators import features as ft
from kinmatch.operators import records as r
from kinmatch.operators.blocking import Spec
from kinmatch.sources import files
from kinmatch.streaming.incremental import remaining


def normalised_once(sources: DataFrame, path: str) -> DataFrame:
    """Normalised records, written by country and read again."""
    records = r.normalised(sources)
    columns = records.columns
    records.withColumn("part", F.col("country")).write.partitionBy("part").mode("overwrite").parquet(path)
    return sources.sparkSession.read.parquet(path).select(*columns)


def scored_pairs(records: DataFrame, bundle: ensemble.Bundle, spec: Spec = blockers.IDF_TOP15, gate: float | None = c.GATE) -> DataFrame:
    """Candidate pairs with the ensemble's ``p``."""
    found = blocking.candidates(r.anchors(records), r.pool(records), spec)
    return ensemble.score(ft.matrix(ft.pairs(found, records)), bundle, gate)


def matched(scored: DataFrame, thresholds: dict[str, float], rescue: float | None = None) -> DataFrame:
    """(s1_id, cand_id): accepted pairs and their closure."""
    ok = ensemble.accepted(scored, thresholds, rescue)
    more = rules.closure(scored, ok, None if rescue is not None else c.CLOSURE_FLOOR, strict=rescue is not None)
    return blocking.union(ok, more)


def predict(spark: SparkSession, sources: DataFrame, bundle: ensemble.Bundle, out: str, work: str, spec: Spec = blockers.IDF_TOP15, done: DataFrame | None = None) -> DataFrame:
    """Matches the anchors that aren't done yet and writes both result tables; one row of checks.

    ``work``, a folder that all executors share, gets the normalised records, by country, so that each key family reads
    its own columns of them and nothing is normalised twice; and the scores, since matches, closure and candidates all
    read them. Both survive the loss of executors."""
    ensemble.check_gate(min([*bundle.thresholds.values(), c.CLOSURE_FLOOR]))
    records = normalised_once(sources, f"{work}/records")
    own = r.anchors(records)
    if done is not None:
        own = remaining(own, done).select(*records.columns)
        records = own.unionByName(r.pool(records))
    scored_pairs(records, bundle, spec).write.mode("overwrite").parquet(f"{work}/scores")
    scored = spark.read.parquet(f"{work}/scores")
    pairs = matched(scored, bundle.thresholds)
    candidates = rules.superset(scored.select("s1_id", "cand_id"), pairs)
    files.write_results(own, pairs, candidates, out)
    ids = own.select("entity_id", "ord")
    ranked = files.aligned(ids, pairs, "list").select("ord", F.col("source1_entity_id").alias("s1_id"), files.ids_of(F.col("list")).alias("ids"))
    all_c = files.aligned(ids, candidates, "list").select("ord", F.col("source1_entity_id").alias("s1_id"), files.ids_of(F.col("list")).alias("ids"))
    return evaluate.audit(ids.select("ord", F.col("entity_id").alias("s1_id")), ranked, all_c)


def training_matrix(records: DataFrame, truth: DataFrame, spec: Spec = blockers.IDF_TOP15) -> DataFrame:
    found = ft.labelled(blocking.candidates(r.anchors(records), r.pool(records), spec), truth)
    return ft.matrix(ft.pairs(found, records))


def train(records: DataFrame, truth: DataFrame, work: str, settings: ensemble.Settings = ensemble.Settings(), spec: Spec = blockers.IDF_TOP15) -> ensemble.Bundle:
    """Models and thresholds; the feature rows are written to ``work`` once."""
    spark = records.sparkSession
    training_matrix(records, truth, spec).write.mode("overwrite").parquet(work)
    return ensemble.train(spark.read.parquet(work), truth, settings)


def match_by_rules(records: DataFrame, version: int = 3, truth: DataFrame | None = None, least: float = 0.6) -> DataFrame:
    """(s1_id, ids) by the rule matcher. With a truth, refuses where the macro F0.5 stays under ``least``."""
    own = r.anchors(records)
    out = evaluate.listed(own, rules.matches(own, r.pool(records), records, version))
    if truth is not None:
        got = evaluate.macro(evaluate.per_entity(truth, out)).first()["macro_f05"]
        if got < least:
            raise ValueError(f"macro F0.5 of {got} is under {least}")
    return out
