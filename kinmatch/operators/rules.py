"""Rule scorers and the steps after matching: rescue, completion, closure, scrub."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.functions import constants as c
from kinmatch.functions import similarity as sim
from kinmatch.functions import text as t
from kinmatch.operators import blockers, blocking
from kinmatch.operators import features as ft
from kinmatch.sources.shared import written

MATCH_SCORE, MOST = 60, 4


def score_v2(n: Column, a: Column, shared: Column, conflict: Column) -> Column:
    """Score of a pair by name and address similarity (0 to 100) and its numbers; the first rule that holds."""
    out = F.when(n >= 85, F.when(conflict, 0).otherwise(95)).when((n >= 70) & (a >= 60), F.when(conflict, 0).otherwise(90))
    out = out.when(n >= 70, F.when(conflict, 0).when(shared, 85).otherwise(65))
    out = out.when((n >= 55) & (a >= 75), F.when(conflict, 0).otherwise(80)).when((a >= 80) & shared, 85)
    out = out.when((a >= 75) & ~conflict, F.when(shared, 75).otherwise(50)).when((n >= 55) & shared, 70)
    return out.when((a >= 65) & shared & (n >= 30), 60).otherwise(0)


def score_v3(n: Column, a: Column, shared: Column, conflict: Column) -> Column:
    """As score_v2, with a veto of conflicting numbers for names below 85 only."""
    out = F.when(conflict & (n < 85), 0).when(n >= 85, 95).when((n >= 70) & (a >= 60), 90).when((n >= 70) & shared, 88).when(n >= 70, 68)
    out = out.when((n >= 55) & (a >= 70), 82).when((n >= 55) & shared, 75).when((a >= 80) & shared, 85)
    return out.when((a >= 70) & shared & (n >= 20), 70).when((a >= 85) & (n >= 30), 65).otherwise(0)


def scored(paired: DataFrame, version: int) -> DataFrame:
    """pairs() with ``rule_score``."""
    r = sim.rule_ratios(F.col("a_light_name"), F.col("b_light_name"), F.col("a_light_addr"), F.col("b_light_addr"))
    x, y = t.long_numbers(F.col("a_light_addr")), t.long_numbers(F.col("b_light_addr"))
    rule = {2: score_v2, 3: score_v3}[version]
    out = paired.withColumns({"r": r, "shared": F.arrays_overlap(x, y), "conflict": ft.conflict(x, y)})
    return out.withColumn("rule_score", rule(F.col("r.n"), F.col("r.a"), F.col("shared"), F.col("conflict"))).drop("r", "shared", "conflict")


def matches(anchors: DataFrame, pool: DataFrame, records: DataFrame, version: int) -> DataFrame:
    """(s1_id, cand_id, source, rule_score): candidates of the rule blocker that the rules accept."""
    spec = {2: blockers.RULE_V2, 3: blockers.RULE_V3}[version]
    found = scored(ft.pairs(blocking.candidates(anchors, pool, spec), records), version)
    return found.where(F.col("rule_score") >= MATCH_SCORE).select("s1_id", "cand_id", "source", "rule_score")


def _raw_pairs(found: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with what rescue looks at: ``ratio`` of the lower-cased names, ``shared`` and ``conflict`` of house numbers,
    ``common``: a clean word in common."""
    p = ft.pairs(found, records)
    x, y = t.house_numbers(F.col("a_business_address")), t.house_numbers(F.col("b_business_address"))
    r = sim.token_sort(F.lower("a_business_name"), F.lower("b_business_name"))
    common = F.arrays_overlap(t.clean_words(F.col("a_business_name")), t.clean_words(F.col("b_business_name")))
    return p.withColumns({"ratio": r, "shared": F.arrays_overlap(x, y), "conflict": ft.conflict(x, y), "common": common})


def _rescued(p: DataFrame) -> DataFrame:
    return p.where(~F.col("conflict") & F.when(F.col("shared"), F.col("ratio") >= 72).otherwise((F.col("ratio") >= 85) & F.col("common")))


def _best_ratio(p: DataFrame, most: Column) -> DataFrame:
    order = Window.partitionBy("s1_id").orderBy(F.desc(F.round("ratio", 6)), "cand_ord", "cand_id")
    return p.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("s1_id", "cand_id", "source", F.round("ratio", 6).alias("ratio"))


def rescue_empty(anchors: DataFrame, pool: DataFrame, records: DataFrame, matched: DataFrame) -> DataFrame:
    """New matches of anchors that have none: the ten best by the rescue blocker, at least 12, four at most by name."""
    empty = anchors.join(matched.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_anti")
    return _best_ratio(_rescued(_raw_pairs(blocking.candidates(empty, pool, blockers.RESCUE_A), records)), F.lit(MOST))


def rescue_few(anchors: DataFrame, pool: DataFrame, records: DataFrame, matched: DataFrame) -> DataFrame:
    """New matches of anchors that have less than two: any candidate of 10 or more, filled up to four."""
    have = matched.groupBy("s1_id").agg(F.count(F.lit(1)).alias("have"))
    full = have.where("have >= 2").select(F.col("s1_id").alias("entity_id"))
    found = blocking.candidates(anchors.join(full, "entity_id", "left_anti"), pool, blockers.RESCUE_B)
    found = found.join(matched.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
    p = _rescued(_raw_pairs(found, records)).join(have, "s1_id", "left")
    return _best_ratio(p, MOST - F.coalesce("have", F.lit(0)))


def complete_sources(anchors: DataFrame, pool: DataFrame, records: DataFrame, matched: DataFrame) -> DataFrame:
    """New matches from the other source, for anchors with less than four matches, all from one source: the five best by
    the blocker, at least 15, in their order until there are four."""
    have = matched.groupBy("s1_id").agg(F.count(F.lit(1)).alias("have"), F.min(F.left("cand_id", F.lit(2))).alias("lo"), F.max(F.left("cand_id", F.lit(2))).alias("hi"))
    one = written(have.where("have < 4 AND lo = hi").select("s1_id", "have", F.when(F.col("lo") == "S2", "S3").otherwise("S2").alias("other")), "one_source")  # read twice
    some = anchors.join(one.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    by_source = replace(blockers.COMPLETION, rank_per_source=True)  # the five best of each source, so also of the other one
    found = blocking.candidates(some, pool, by_source).join(one, "s1_id").where(F.col("source") == F.col("other"))
    p = _raw_pairs(found, records).where(~F.col("conflict") & ((F.col("shared") & (F.col("ratio") >= 75)) | (F.col("ratio") >= 88)))
    order = Window.partitionBy("s1_id").orderBy("rank")
    p = p.withColumn("place", F.row_number().over(order)).where(F.col("place") <= MOST - F.col("have"))
    return p.select("s1_id", "cand_id", "source", F.round("ratio", 6).alias("ratio"))


def closure(scored_pairs: DataFrame, matched: DataFrame, floor: float | None = c.CLOSURE_FLOOR, strict: bool = False) -> DataFrame:
    """(s1_id, cand_id): S3 candidates that aren't matched, of anchors with a matched S2 record of the same normalised
    name, and the same address or one that is empty (``strict``: the same address). One step, from S2 to S3 only.
    scored_pairs: s1_id, cand_id, source, p, b_norm_name, b_norm_addr; only S2 matches with p from ``floor`` on count."""
    key = ["s1_id", "cand_id"]
    two = scored_pairs.where(F.col("source") == "S2").join(matched.select(*key), key, "left_semi")
    if floor is not None:
        two = two.where(F.col("p") >= floor)
    two = two.select("s1_id", "b_norm_name", F.col("b_norm_addr").alias("addr2")).distinct()
    three = scored_pairs.where(F.col("source") == "S3").join(matched.select(*key), key, "left_anti")
    both = three.join(two, ["s1_id", "b_norm_name"])
    same = F.col("b_norm_addr") == F.col("addr2")
    return both.where(same if strict else same | (F.col("b_norm_addr") == "") | (F.col("addr2") == "")).select(*key).distinct()


def scrub(matched: DataFrame, records: DataFrame) -> DataFrame:
    """matched (s1_id, cand_id) without pairs whose numbers conflict, or whose first words differ, neither begins the
    other, and that share no word. Pairs whose candidate isn't known stay."""
    side = lambda p: (t.any_numbers(F.col("business_address")).alias(f"{p}_nums"), t.scrub_tokens(F.col("business_name")).alias(f"{p}_toks"))
    a = records.where(F.col("source") == "S1").select(F.col("entity_id").alias("s1_id"), *side("x"))
    b = records.where(F.col("source") != "S1").select(F.col("entity_id").alias("cand_id"), *side("y"))
    p = matched.select("s1_id", "cand_id").join(a, "s1_id", "left").join(b, "cand_id", "left")
    first1, first2 = t.first_token(F.col("x_toks")), t.first_token(F.col("y_toks"))
    apart = (first1 != "") & (first2 != "") & (first1 != first2) & ~F.startswith(first1, first2) & ~F.startswith(first2, first1) & ~F.arrays_overlap("x_toks", "y_toks")
    drop = ft.conflict(F.col("x_nums"), F.col("y_nums")) | apart
    return p.where(~F.coalesce(drop, F.lit(False))).select("s1_id", "cand_id")


def superset(candidates: DataFrame, matched: DataFrame) -> DataFrame:
    """Candidates with every match among them."""
    return blocking.union(candidates, matched)
