"""Scores against the truth, threshold search, and diagnostics.

Truth and predictions are (s1_id, ids): an array for each anchor, empty for a singleton; ``listed`` makes them from pairs.
Where the truth is that an anchor and a record are of one class, its pairs grow with the square of a class: ``Classes`` counts
them by class, looks up predicted pairs by the classes of their two records, and makes no row for a true pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.operators import features as ft
from kinmatch.operators.blocking import KEYS
from kinmatch.sources.shared import written

#: Pairs of a class that one task makes, about, where the pairs are the result.
CELL_PAIRS = 1 << 20


def _empty() -> Column:
    return F.array().cast("array<string>")


def listed(anchors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s1_id, ids) of all anchors (entity_id) from pairs (s1_id, cand_id)."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))
    out = anchors.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return out.select("s1_id", F.coalesce("ids", _empty()).alias("ids"))


def f05(pred: Column, true: Column) -> Column:
    """F0.5 of one anchor; a right singleton scores 1, a wrong one 0."""
    tp = F.size(F.array_intersect(pred, true)).cast("double")
    p, r = tp / F.size(pred), tp / F.size(true)
    value = F.when(tp == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))
    return F.when(F.size(true) == 0, F.when(F.size(pred) == 0, 1.0).otherwise(0.0)).when(F.size(pred) == 0, 0.0).otherwise(value)


def per_entity(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """s1_id, n_true, n_pred, n_hit and f05 of every anchor of the truth; one without a prediction is a singleton."""
    both = truth.join(predicted.select("s1_id", F.col("ids").alias("pred")), "s1_id", "left")
    both = both.select("s1_id", F.array_distinct("ids").alias("true"), F.coalesce(F.array_distinct("pred"), _empty()).alias("pred"))
    return both.select("s1_id", F.size("true").alias("n_true"), F.size("pred").alias("n_pred"), F.size(F.array_intersect("pred", "true")).alias("n_hit"), F.round(f05(F.col("pred"), F.col("true")), 9).alias("f05"))


@dataclass(frozen=True)
class Classes:
    """A truth by classes. ``anchors`` (id, class...) and ``others`` (id, source, class...), each row once, in tables; the
    class is one of the columns ``key``, without nulls. An anchor's true matches are the others of its class.

    Ids of one class only are counted by class. Those that stand in several ("mixed": an id that repeats with other
    contents) may meet in more than one, so their pairs are made, once each."""

    anchors: DataFrame
    others: DataFrame
    mixed: DataFrame
    key: tuple[str, ...]

    @classmethod
    def of(cls, members: DataFrame, key: tuple[str, ...]) -> Classes:
        """``members``: entity_id, source and the columns ``key``; source S1 marks anchors."""
        each = members.where(" AND ".join(f"`{k}` IS NOT NULL" for k in key)).select(F.col("entity_id").alias("id"), "source", *key)
        each = written(each.distinct(), "classes")
        mixed = written(each.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "mixed")
        return cls(each.where("source = 'S1'").drop("source"), each.where("source <> 'S1'"), mixed, key)

    def _pure(self, side: DataFrame) -> DataFrame:
        return side.join(self.mixed, "id", "left_anti")

    def _mixed_pairs(self) -> DataFrame:
        """(s1_id, cand_id, source): true pairs of which a record is mixed, each once."""
        a, b = self.anchors.withColumnRenamed("id", "s1_id"), self.others.withColumnRenamed("id", "cand_id")
        one = a.join(self.mixed.withColumnRenamed("id", "s1_id"), "s1_id", "left_semi").join(b, [*self.key])
        two = a.join(b.join(self.mixed.withColumnRenamed("id", "cand_id"), "cand_id", "left_semi"), [*self.key])
        return one.select("s1_id", "cand_id", "source").unionByName(two.select("s1_id", "cand_id", "source")).distinct()

    def counts(self) -> DataFrame:
        """(s1_id, source, n): how many true matches each anchor that has one has in each source."""
        sizes = self._pure(self.others).groupBy(*self.key, "source").agg(F.count(F.lit(1)).alias("n"))
        each = self._pure(self.anchors).join(sizes, [*self.key]).select(F.col("id").alias("s1_id"), "source", "n")
        more = self._mixed_pairs().groupBy("s1_id", "source").agg(F.count(F.lit(1)).alias("n"))
        return each.unionByName(more).groupBy("s1_id", "source").agg(F.sum("n").alias("n"))

    def hits(self, pairs: DataFrame) -> DataFrame:
        """The rows of ``pairs`` (s1_id, cand_id, ...) that are true; ``pairs`` has each of its rows once."""
        a, b = self.anchors.withColumnRenamed("id", "s1_id"), self.others.drop("source").withColumnRenamed("id", "cand_id")
        return pairs.join(a, "s1_id").join(b, ["cand_id", *self.key]).select(*pairs.columns).distinct()

    def missed(self, pairs: DataFrame, of_anchors: DataFrame, of_others: DataFrame) -> DataFrame:
        """s1_id, cand_id and the further columns of ``of_anchors`` (s1_id, ...) and ``of_others`` (cand_id, ...): true pairs
        that ``pairs`` lacks, each once. They are as many as the classes make them. Anchors take their predicted ids along
        and both sides their further columns, so that no true pair is shuffled; a large class is dealt into squares."""
        more_a, more_b = ([c for c in x.columns if c not in ("s1_id", "cand_id")] for x in (of_anchors, of_others))
        pred = pairs.groupBy("s1_id").agg(F.collect_set("cand_id").alias("pred"))
        a, b = (self._pure(x).groupBy(*self.key).agg(F.count(F.lit(1)).alias(n)) for x, n in ((self.anchors, "na"), (self.others, "nb")))
        grid = a.join(b, [*self.key]).select(*self.key, F.ceil(F.sqrt(F.col("na") * F.col("nb") / CELL_PAIRS)).cast("int").alias("grid"))
        grid = written(grid, "class-sizes")
        place, every = (lambda x: F.pmod(F.xxhash64(x), F.col("grid")).cast("int")), F.explode(F.sequence(F.lit(0), F.col("grid") - 1))
        a = self._pure(self.anchors).withColumnRenamed("id", "s1_id").join(of_anchors, "s1_id").join(pred, "s1_id", "left").join(grid, [*self.key])
        a = a.select(*self.key, "s1_id", *more_a, "pred", place("s1_id").alias("row"), every.alias("column"))
        b = self._pure(self.others).withColumnRenamed("id", "cand_id").join(of_others, "cand_id").join(grid, [*self.key])
        b = b.select(*self.key, "cand_id", *more_b, place("cand_id").alias("column"), every.alias("row"))
        out = a.join(b, [*self.key, "row", "column"]).where("pred IS NULL OR NOT array_contains(pred, cand_id)").select("s1_id", "cand_id", *more_a, *more_b)
        more = self._mixed_pairs().select("s1_id", "cand_id").join(pairs.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
        return out.unionByName(more.join(of_anchors, "s1_id").join(of_others, "cand_id"))


def f05_of_counts(hit: Column, pred: Column, true: Column) -> Column:
    """f05() by the numbers of hits, predicted and true ids."""
    p, r = hit / pred, hit / true
    value = F.when(hit == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))
    return F.when(true == 0, F.when(pred == 0, 1.0).otherwise(0.0)).when(pred == 0, 0.0).otherwise(value)


def per_entity_by_class(anchors: DataFrame, classes: Classes, pairs: DataFrame) -> DataFrame:
    """per_entity() of all anchors (entity_id) by a truth in classes and predicted pairs (s1_id, cand_id)."""
    pairs = written(pairs.select("s1_id", "cand_id").distinct(), "predicted")
    true = classes.counts().groupBy("s1_id").agg(F.sum("n").alias("t"))
    pred, hit = (x.groupBy("s1_id").agg(F.count(F.lit(1)).alias(n)) for x, n in ((pairs, "p"), (classes.hits(pairs), "h")))
    each = anchors.select(F.col("entity_id").alias("s1_id")).join(true, "s1_id", "left").join(pred, "s1_id", "left").join(hit, "s1_id", "left")
    n_true, n_pred, n_hit = (F.coalesce(x, F.lit(0)).cast("int") for x in "tph")
    each = each.select("s1_id", n_true.alias("n_true"), n_pred.alias("n_pred"), n_hit.alias("n_hit"))
    return each.withColumn("f05", F.round(f05_of_counts(F.col("n_hit"), F.col("n_pred"), F.col("n_true")), 9))


def macro(scores: DataFrame) -> DataFrame:
    return scores.agg(F.round(F.coalesce(F.avg("f05"), F.lit(0.0)), 6).alias("macro_f05"), F.count(F.lit(1)).alias("n"))


def breakdown(scores: DataFrame) -> DataFrame:
    """One row: counts of singletons and matched anchors, their mean scores, and micro precision and recall."""
    single = F.col("n_true") == 0
    share = lambda a, b: F.round(F.when(F.sum(b) > 0, F.sum(a) / F.sum(b)).otherwise(0.0), 6)
    return scores.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(single).alias("true_singletons"), F.count_if(~single).alias("true_matched"), F.count_if(F.col("n_pred") == 0).alias("pred_singletons"),
        F.round(F.coalesce(F.avg(F.when(single, F.col("f05"))), F.lit(0.0)), 6).alias("f05_singletons"), F.round(F.coalesce(F.avg(F.when(~single, F.col("f05"))), F.lit(0.0)), 6).alias("f05_matched"),
        F.round(F.coalesce(F.avg("f05"), F.lit(0.0)), 6).alias("macro_f05"), F.count_if(F.col("f05") >= 0.99).alias("n_perfect"), F.count_if(F.col("f05") == 0).alias("n_zero"),
        share(F.col("n_hit"), F.col("n_pred")).alias("micro_precision"), share(F.col("n_hit"), F.col("n_true")).alias("micro_recall"),
    )


def sweep(truth: DataFrame, scored: DataFrame, first: int, last: int, step: int) -> DataFrame:
    """(tau, macro_f05) for thresholds in hundredths. scored: s1_id, cand_id, p.

    A pair counts for every threshold up to its own p: pairs are put into the highest threshold they reach, counted by
    anchor and threshold, and summed from above, so each pair is a row once however many thresholds there are."""
    grid = [x / 100 for x in range(first, last + 1, step)]
    true = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct().withColumn("hit", F.lit(1))
    reach = F.floor((F.least(F.round(F.col("p") * 100, 6), F.lit(float(last))) - first) / step).cast("int")
    level = scored.select("s1_id", "cand_id", reach.alias("level")).where("level >= 0").groupBy("s1_id", "cand_id").agg(F.max("level").alias("level"))
    counts = level.join(true, ["s1_id", "cand_id"], "left").groupBy("s1_id", "level").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("h"))
    by_anchor = counts.groupBy("s1_id").agg(F.collect_list(F.struct("level", "n", "h")).alias("c"))  # one entry for each threshold at most
    each = truth.select("s1_id", F.size(F.array_distinct("ids")).alias("t")).join(by_anchor, "s1_id", "left")
    each = each.select("t", F.coalesce("c", F.array().cast("array<struct<level:int,n:bigint,h:bigint>>")).alias("c"), F.posexplode(F.array(*map(F.lit, grid))).alias("i", "tau"))
    total = lambda k: F.aggregate(F.filter("c", lambda x: x["level"] >= F.col("i")), F.lit(0).cast("long"), lambda acc, x: acc + x[k])
    each = each.select("tau", "t", total("n").alias("n"), total("h").alias("h"))
    p, r = F.col("h") / F.col("n"), F.col("h") / F.col("t")
    value = F.when(F.col("t") == 0, (F.col("n") == 0).cast("double")).when((F.col("n") == 0) | (F.col("h") == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))
    return each.select("tau", value.alias("f")).groupBy("tau").agg(F.round(F.avg("f"), 6).alias("macro_f05"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The lowest threshold with the best score."""
    return curve.orderBy(F.desc("macro_f05"), "tau").limit(1)


def recall(truth: DataFrame, found: DataFrame) -> DataFrame:
    """By source of the true match: n_true, n_found and recall of candidate pairs."""
    true = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct()
    hit = true.join(found.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    return hit.groupBy(F.left("cand_id", F.lit(2)).alias("source")).agg(F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("n_found"), F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))


def recall_at(truth: DataFrame, found: DataFrame, ks: tuple[int, ...] = (1, 5, 10, 15, 25, 50)) -> DataFrame:
    """(k, n_found, recall) of candidates ranked up to k."""
    true = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct()
    hit = true.join(found.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left")
    one = hit.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("rank") <= k).alias(f"k{k}") for k in ks])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("n_found")) for k in ks])).alias("x")
    return one.select("n", rows).select("x.k", "x.n_found", F.round(F.col("x.n_found") / F.col("n"), 6).alias("recall"))


def recall_by_class(classes: Classes, found: DataFrame) -> DataFrame:
    """recall() by a truth in classes."""
    hit = classes.hits(found.select("s1_id", "cand_id", F.left("cand_id", F.lit(2)).alias("source")).distinct())
    n = classes.counts().groupBy("source").agg(F.sum("n").alias("n_true"))
    out = n.join(hit.groupBy("source").agg(F.count(F.lit(1)).alias("n_found")), "source", "left")
    out = out.select("source", "n_true", F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"))
    return out.withColumn("recall", F.round(F.col("n_found") / F.col("n_true"), 6))


def recall_at_by_class(classes: Classes, found: DataFrame, ks: tuple[int, ...] = (1, 5, 10, 15, 25, 50)) -> DataFrame:
    """recall_at() by a truth in classes; no row where nothing is true."""
    n = classes.counts().agg(F.sum("n").alias("n"))
    one = classes.hits(found.select("s1_id", "cand_id", "rank")).agg(*[F.count_if(F.col("rank") <= k).alias(f"k{k}") for k in ks])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("n_found")) for k in ks])).alias("x")
    return one.crossJoin(F.broadcast(n)).where("n > 0").select("n", rows).select("x.k", "x.n_found", F.round(F.col("x.n_found") / F.col("n"), 6).alias("recall"))


def singleton_rate(anchors: DataFrame, scored: DataFrame, taus: tuple[float, ...]) -> DataFrame:
    """(tau, n_singletons, rate): anchors without a pair at each threshold; one pass for all thresholds."""
    top = scored.groupBy("s1_id").agg(F.max("p").alias("top"))
    one = anchors.select(F.col("entity_id").alias("s1_id")).join(top, "s1_id", "left")
    one = one.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("top").isNull() | (F.col("top") < x)).alias(f"t{i}") for i, x in enumerate(taus)])
    rows = F.explode(F.array(*[F.struct(F.lit(float(x)).alias("tau"), F.col(f"t{i}").alias("n_singletons")) for i, x in enumerate(taus)])).alias("x")
    return one.select("n", rows).select("x.tau", "x.n_singletons", F.round(F.col("x.n_singletons") / F.col("n"), 6).alias("rate"))


def fixed_distractors(anchors: DataFrame, pool: DataFrame, truth: DataFrame, n: int = 15) -> DataFrame:
    """(s1_id, cand_id, label): each anchor's true matches, and about ``n`` other records of its country, the same ones each
    time. A country's pool is dealt into parts of n records by ordinal and an anchor meets one part, so this is an equi-join."""
    parts = pool.groupBy("country").agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / n)).cast("long").alias("parts"))  # a row for each country
    place = F.pmod(F.col("ord"), F.col("parts")).alias("part")
    a = anchors.join(F.broadcast(parts), "country").select("country", place, F.col("entity_id").alias("s1_id"))
    b = pool.join(F.broadcast(parts), "country").select("country", place, F.col("entity_id").alias("cand_id"))
    true = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct().withColumn("label", F.lit(1))
    others = a.join(b, ["country", "part"]).select("s1_id", "cand_id").join(true, ["s1_id", "cand_id"], "left_anti").withColumn("label", F.lit(0))
    return true.unionByName(others)


def match_counts(lists: DataFrame) -> DataFrame:
    """(n_ids, n): how many anchors have how many matches."""
    return lists.groupBy(F.size("ids").alias("n_ids")).agg(F.count(F.lit(1)).alias("n"))


def size_statistics(lists: DataFrame) -> DataFrame:
    n = F.size("ids")
    return lists.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(n), 6).alias("mean"), F.max(n).alias("most"), F.percentile(n, 0.5).cast("double").alias("median"), F.percentile(n, 0.9).cast("double").alias("p90"))


def composition(lists: DataFrame) -> DataFrame:
    """One row: anchors with matches from S2 only, S3 only, both and none."""
    two, three = (F.exists("ids", _from(s)) for s in ("S2", "S3"))
    return lists.agg(F.count_if(two & ~three).alias("s2_only"), F.count_if(three & ~two).alias("s3_only"), F.count_if(two & three).alias("both_sources"), F.count_if(~two & ~three).alias("none"))


def _from(source: str):
    return lambda x: F.startswith(x, F.lit(source))


def country_isolation(records: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true pairs, and those between two countries."""
    pairs = truth.select("s1_id", F.explode("ids").alias("cand_id"))
    c = records.select("entity_id", "country")
    both = pairs.join(c.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("a")), "s1_id").join(c.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("b")), "cand_id")
    return both.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("a") != F.col("b")).alias("n_crossing"))


def key_coverage(records: DataFrame, truth: DataFrame, keys: tuple[str, ...] = ("name_word", "number2", "addr_word3", "prefix4", "name_word_sound")) -> DataFrame:
    """(key, n_pairs, n_covered): true pairs that share a key of each kind."""
    own = records.select("entity_id", *[KEYS[k]().alias(k) for k in keys])
    pairs = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct()
    a = own.select(F.col("entity_id").alias("s1_id"), *[F.col(k).alias(f"a_{k}") for k in keys])
    b = own.select(F.col("entity_id").alias("cand_id"), *[F.col(k).alias(f"b_{k}") for k in keys])
    both = pairs.join(a, "s1_id").join(b, "cand_id")
    shared = lambda k: F.coalesce(F.arrays_overlap(F.filter(f"a_{k}", lambda x: x != ""), F.filter(f"b_{k}", lambda x: x != "")), F.lit(False))
    one = both.agg(F.count(F.lit(1)).alias("n_pairs"), *[F.count_if(shared(k)).alias(k) for k in keys])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("n_covered")) for k in keys])).alias("x")
    return one.select("n_pairs", rows).select("x.key", "n_pairs", "x.n_covered")


def number_overlap(paired: DataFrame) -> DataFrame:
    """One row over pairs(): share of pairs without and with full overlap of address numbers, mean overlap (of the larger
    set), and median, quartile and mean of the names' token overlap."""
    x, y = F.array_distinct("a_addr_numbers"), F.array_distinct("b_addr_numbers")
    over = F.when(F.greatest(F.size(x), F.size(y)) == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))
    p = paired.select(over.alias("o"), ft.jaccard(F.col("a_name_tokens"), F.col("b_name_tokens")).alias("j"))
    return p.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.round(F.avg((F.col("o") == 0).cast("int")), 6).alias("none"), F.round(F.avg((F.col("o") == 1).cast("int")), 6).alias("full"), F.round(F.avg("o"), 6).alias("mean_overlap"),
        F.round(F.avg("j"), 6).alias("mean_jaccard"), F.round(F.percentile("j", 0.5), 6).alias("median_jaccard"), F.round(F.percentile("j", 0.25), 6).alias("q25_jaccard"),
    )


def buckets(rows: DataFrame, value: Column, edges: tuple[float, ...]) -> DataFrame:
    """(below, n, share): how many rows have a value below each edge; one pass for all edges."""
    one = rows.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(value < e).alias(f"b{i}") for i, e in enumerate(edges)])
    each = F.explode(F.array(*[F.struct(F.lit(float(e)).alias("below"), F.col(f"b{i}").alias("n")) for i, e in enumerate(edges)])).alias("x")
    return one.select("all", each).select("x.below", "x.n", F.round(F.when(F.col("all") > 0, F.col("x.n") / F.col("all")).otherwise(0.0), 6).alias("share"))


def stratified_sample(truth: DataFrame, per_stratum: int) -> DataFrame:
    """(s1_id, singleton): the same number of singletons and of matched anchors, by the hash of their ids, so the same ones
    each time. Spark limits each stratum before it shuffles."""
    single = (F.size("ids") == 0).cast("int").alias("singleton")
    order = Window.partitionBy("singleton").orderBy(F.md5(F.col("s1_id").cast("binary")), "s1_id")
    out = truth.select("s1_id", single).withColumn("place", F.row_number().over(order))
    return out.where(F.col("place") <= per_stratum).select("s1_id", "singleton")


def missed(truth: DataFrame, predicted: DataFrame, records: DataFrame) -> DataFrame:
    """True pairs that the prediction lacks, with both records' names and addresses, to look at."""
    gap = truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct().join(predicted.select("s1_id", F.explode("ids").alias("cand_id")), ["s1_id", "cand_id"], "left_anti")
    return gap.join(_texts(records, "s1_id", "s1"), "s1_id").join(_texts(records, "cand_id", "cand"), "cand_id")


def _texts(records: DataFrame, id_: str, p: str) -> DataFrame:
    return records.select(F.col("entity_id").alias(id_), F.col("business_name").alias(f"{p}_name"), F.col("business_address").alias(f"{p}_address"))


def missed_by_class(classes: Classes, pairs: DataFrame, records: DataFrame) -> DataFrame:
    """missed() by a truth in classes and predicted pairs (s1_id, cand_id). Names and addresses are joined to ids before
    they meet: the missing pairs go to the result as they are made."""
    a = _texts(records.where("source = 'S1'"), "s1_id", "s1")
    b = _texts(records.where("source <> 'S1'"), "cand_id", "cand")
    return classes.missed(pairs, a, b)


def gap_report(truth: DataFrame, predicted: DataFrame, records: DataFrame) -> DataFrame:
    """By country: anchors, true and predicted matches, false singletons (matched in truth, empty in the prediction)."""
    scores = per_entity(truth, predicted).join(records.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id")
    return scores.groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"), F.count_if((F.col("n_pred") == 0) & (F.col("n_true") > 0)).alias("false_singletons"),
        F.round(F.avg("f05"), 6).alias("macro_f05"),
    )


def simulated(truth: DataFrame, recalls: tuple[int, ...] = (50, 60, 70, 80, 90, 100)) -> DataFrame:
    """(recall, macro_f05) if every matched anchor had that share (in hundredths) of its matches, rounded down to at least
    none, and no wrong one."""
    n = truth.select(F.size(F.array_distinct("ids")).alias("t"), F.explode(F.array(*map(F.lit, recalls))).alias("recall"))
    hit = F.floor(F.col("t") * F.col("recall") / 100)
    r = hit / F.col("t")
    value = F.when(F.col("t") == 0, 1.0).when(hit == 0, 0.0).otherwise(1.25 * r / (0.25 + r))
    return n.groupBy("recall").agg(F.round(F.avg(value), 6).alias("macro_f05"))


def audit(source_ids: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row of checks, each true where it holds. All are (s1_id, ord[, ids]): the anchors in order, and both files' rows.

    ``same_count``: as many rows as anchors; ``same_order``: the same id at each place; ``subset``: every match is among the
    anchor's candidates (a violation fails the audit); ``passed``: all of them."""
    n = source_ids.agg(F.count(F.lit(1)).alias("n"))
    m = matches.select("ord", F.col("s1_id").alias("m_id"), F.col("ids").alias("m_ids"))
    k = candidates.select("ord", F.col("s1_id").alias("k_id"), F.col("ids").alias("k_ids"))
    both = source_ids.select("ord", "s1_id").join(m, "ord", "full").join(k, "ord", "full")
    out = both.agg(
        F.count("m_id").alias("n_matches"), F.count("k_id").alias("n_candidates"), F.count_if(~(F.col("s1_id").eqNullSafe(F.col("m_id")) & F.col("s1_id").eqNullSafe(F.col("k_id")))).alias("n_misplaced"),
        F.count_if(F.size(F.array_except("m_ids", F.coalesce("k_ids", _empty()))) > 0).alias("n_not_subset"), F.count_if(F.size("m_ids") == 0).alias("n_singletons"),
    ).join(F.broadcast(n))
    checks = {"same_count": (F.col("n_matches") == F.col("n")) & (F.col("n_candidates") == F.col("n")), "same_order": F.col("n_misplaced") == 0, "subset": F.col("n_not_subset") == 0}
    return out.select("n", "n_matches", "n_candidates", "n_misplaced", "n_not_subset", "n_singletons", *[v.alias(k) for k, v in checks.items()]).withColumn("passed", F.col("same_count") & F.col("same_order") & F.col("subset"))
