"""Cosine search over TF-IDF weighted character n-grams, as a sparse product: join on n-grams, sum, best k.

No matrix is built. Vocabulary, document frequencies and norms are aggregates by country; the product's rows are the
anchors' n-grams times the n-grams' postings. ``max_share`` bounds that product at scale: n-grams in a larger share of
the pool's records are left out of it (they carry the least weight); without it the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.functions import text as t
from kinmatch.operators.blocking import best


def word_grams(x: Column, least: int, most: int) -> Column:
    """n-grams inside each word with a space on both sides, repeats kept. A padded word that is no longer than n gives
    itself, once, and no longer n-grams."""

    def of(word: Column) -> Column:
        w = F.concat(F.lit(" "), word, F.lit(" "))
        parts = []
        for n in range(least, most + 1):
            every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), _cut(w, n))
            parts.append(every if n == least else F.when(F.length(w) >= n, every).otherwise(F.array().cast("array<string>")))
        return F.concat(*parts)

    return F.flatten(F.transform(t.tokens(F.lower(x)), of))


def _cut(w: Column, n: int):
    return lambda i: F.substr(w, i, F.lit(n))


def _counts(records: DataFrame, column: str, least: int, most: int) -> DataFrame:
    """(country, source, entity_id, ord, gram, tf): counted inside each record, so nothing is shuffled."""
    grams = records.select("country", "source", "entity_id", "ord", word_grams(F.col(column), least, most).alias("g"))
    each = F.transform(F.array_distinct("g"), lambda x: F.struct(x.alias("gram"), F.size(F.filter("g", lambda y: y == x)).alias("tf")))
    return grams.select("country", "source", "entity_id", "ord", F.inline(each))


def cosine_top_k(anchors: DataFrame, pool: DataFrame, column: str = "norm_name", grams: tuple[int, int] = (2, 4), k: int = 20, max_features: int = 80_000, max_share: float | None = None, least: float = 0.01) -> DataFrame:
    """Candidates as ``blocking.candidates`` gives them, the cosine as score. Fitted on each country's pool: smooth idf,
    unit length, the ``max_features`` n-grams that are most frequent (ties by n-gram). Pairs at ``least`` or below go,
    where the pool has more than k records; else those without a common n-gram.

    The vocabulary is broadcast: it has ``max_features`` short rows at most for each country. A record's n-grams come from
    one row, so weights and length need one shuffle of each side by record; the product is one join and one sum."""
    p, a = _counts(pool, column, *grams), _counts(anchors, column, *grams)
    sizes = pool.groupBy("country").agg(F.count(F.lit(1)).alias("n"))  # a row for each country
    frequent = Window.partitionBy("country").orderBy(F.desc("total"), "gram")
    vocabulary = p.groupBy("country", "gram").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocabulary = vocabulary.withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= max_features).join(F.broadcast(sizes), "country")
    vocabulary = F.broadcast(vocabulary.select("country", "gram", F.xxhash64("gram").alias("g"), (F.col("df") / F.col("n")).alias("share"), (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")))

    def weighted(rows: DataFrame) -> DataFrame:
        rows = rows.join(vocabulary, ["country", "gram"]).withColumn("w", F.col("tf") * F.col("idf"))
        one = F.struct("g", "w") if max_share is None else F.when(F.col("share") <= max_share, F.struct("g", "w"))
        vectors = rows.groupBy("country", "source", "entity_id", "ord").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(one).alias("v"))
        return vectors.select("country", "source", "entity_id", "ord", F.inline(F.transform("v", lambda x: F.struct(x["g"].alias("g"), (x["w"] / F.col("norm")).alias("w")))))

    left = weighted(a).select("country", "g", F.col("entity_id").alias("s1_id"), F.col("ord").alias("s1_ord"), F.col("w").alias("w1"))
    right = weighted(p).select("country", "g", "source", F.col("entity_id").alias("cand_id"), F.col("ord").alias("cand_ord"), F.col("w").alias("w2"))
    pairs = left.join(right, ["country", "g"]).groupBy("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord").agg(F.round(F.sum(F.col("w1") * F.col("w2")), 6).alias("score"))
    pairs = pairs.join(F.broadcast(sizes), "country").where(F.col("score") > F.when(F.col("n") <= k, 0.0).otherwise(least))
    return best(pairs, k, False)
