"""Features of candidate pairs: 28 values, of which the models take 25."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.functions import similarity as sim
from kinmatch.functions import text as t

#: The model's features, in its order.
FEATURE_NAMES = (
    "name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_partial_ratio", "name_jaccard",
    "name_common_token_ratio", "name_len_diff", "addr_token_sort_ratio", "addr_jaccard", "addr_levenshtein_ratio", "addr_number_match",
    "addr_number_jaccard", "addr_has_any", "addr_both_empty", "combined_score", "name_addr_product", "country_match", "name_exact_match",
    "addr_exact_match", "first_token_ratio", "first_token_match", "pincode_match", "pincode_conflict", "initials_match",
)
EXTRA_NAMES = ("name_containment_ratio", "name_char_3gram_jaccard", "addr_containment_ratio")
SIDE = ("norm_name", "norm_addr", "name_tokens", "addr_tokens", "addr_numbers", "light_name", "light_addr", "business_name", "business_address")


def pairs(found: DataFrame, records: DataFrame) -> DataFrame:
    """Candidate pairs with both records' columns, the anchor's as ``a_``, the candidate's as ``b_``. Two equi-joins on ids."""
    own = ["entity_id", "country", *SIDE]
    a = records.where(F.col("source") == "S1").select(*[F.col(c).alias(f"a_{c}") for c in own])
    b = records.where(F.col("source") != "S1").select(*[F.col(c).alias(f"b_{c}") for c in own])
    keep = [c for c in found.columns if c != "country"]
    return found.select(*keep).join(a, F.col("s1_id") == F.col("a_entity_id")).join(b, F.col("cand_id") == F.col("b_entity_id")).drop("a_entity_id", "b_entity_id")


def _flag(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit(False)), 1.0).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def common_share(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def same_set(a: Column, b: Column) -> Column:
    return (F.size(a) > 0) & (F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b)))


def overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def conflict(a: Column, b: Column) -> Column:
    """Both sides have some, and none in common."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def containment(a: Column, b: Column) -> Column:
    inside = (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    return F.when(inside, F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))).otherwise(0.0)


def native(p: str = "a_", q: str = "b_") -> dict[str, Column]:
    """The features that built-in functions express."""
    n1, n2, d1, d2 = F.col(f"{p}norm_name"), F.col(f"{q}norm_name"), F.col(f"{p}norm_addr"), F.col(f"{q}norm_addr")
    t1, t2, u1, u2 = F.col(f"{p}name_tokens"), F.col(f"{q}name_tokens"), F.col(f"{p}addr_tokens"), F.col(f"{q}addr_tokens")
    m1, m2 = F.col(f"{p}addr_numbers"), F.col(f"{q}addr_numbers")
    long1, long2 = (F.filter(t.tokens(x), lambda w: F.length(w) >= 2) for x in (n1, n2))
    pin1, pin2, i1, i2 = t.pin_code(m1), t.pin_code(m2), t.initials(n1), t.initials(n2)
    return {
        "name_jaccard": jaccard(t1, t2), "name_common_token_ratio": common_share(t1, t2), "name_len_diff": F.abs(F.length(n1) - F.length(n2)).cast("double"),
        "addr_jaccard": jaccard(u1, u2), "addr_number_match": _flag(same_set(m1, m2)), "addr_number_jaccard": jaccard(m1, m2),
        "addr_has_any": _flag((d1 != "") | (d2 != "")), "addr_both_empty": _flag((d1 == "") & (d2 == "")), "country_match": _flag(F.col(f"{p}country") == F.col(f"{q}country")),
        "name_exact_match": _flag((n1 != "") & (n1 == n2)), "addr_exact_match": _flag((d1 != "") & (d1 == d2)), "first_token_match": _flag(F.get(long1, F.lit(0)) == F.get(long2, F.lit(0))),
        "pincode_match": _flag(pin1 == pin2), "pincode_conflict": _flag(pin1 != pin2), "initials_match": _flag((F.length(i1) >= 2) & (i1 == i2)),
        "name_containment_ratio": containment(n1, n2), "name_char_3gram_jaccard": jaccard(t.char_grams(n1), t.char_grams(n2)), "addr_containment_ratio": containment(d1, d2),
    }


def featurized(paired: DataFrame) -> DataFrame:
    """pairs() with the 28 features as doubles: one trip to Python for the string kernels, the rest in the JVM."""
    k = sim.kernels(F.col("a_norm_name"), F.col("b_norm_name"), F.col("a_norm_addr"), F.col("b_norm_addr"))
    out = paired.withColumn("kernels", k).withColumns(native())
    out = out.select("*", "kernels.*").drop("kernels")
    return out.withColumns({"combined_score": 0.6 * F.col("name_token_sort_ratio") + 0.4 * F.col("addr_jaccard"), "name_addr_product": F.col("name_jaro_winkler") * F.col("addr_jaccard")})


def matrix(paired: DataFrame) -> DataFrame:
    """Ids and the model's 25 features, at single precision."""
    f = featurized(paired)
    keys = [c for c in ("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord", "score", "rank", "label") if c in f.columns]
    country = [] if "country" in keys else [F.col("a_country").alias("country")]
    return f.select(*keys, *country, "a_norm_name", "a_norm_addr", "b_norm_name", "b_norm_addr", *[F.col(c).cast("float").alias(c) for c in FEATURE_NAMES])


def labelled(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidate pairs with ``label`` 1 if the truth (s1_id, ids) has them, else 0."""
    true = truth.select(F.col("s1_id"), F.explode("ids").alias("cand_id")).distinct().withColumn("label", F.lit(1))
    return found.join(true, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
