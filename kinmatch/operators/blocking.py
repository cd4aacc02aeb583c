"""Candidate generation: one plan for every blocker.

A blocker is data (``Spec``): posting lists of pool records by key, and probes of anchors into them with weights, caps,
document-frequency limits, a floor and k. Both sides become rows (country, list, key, record), meet by key, weights are
summed for each pair, and the k best of each anchor (and source) stay.

Scale: keys that are too frequent go before the join, by an aggregate that combines on the map side. A list is cut to its
cap in two windows, over the longer lists only: first parts of it, dealt by hash, each to the largest cap, a literal that
lets Spark drop the rest of a part before it shuffles (WindowGroupLimit), then what is left to the cap. So a key that holds
a third of the pool costs each task some ``SALTS * cap`` postings at most, and none gets it whole. Sizes by country and
source are the only thing broadcast.

Pairs are anchors x keys x cap at most, far more than the input, and no row of Spark is made for them where k is given:
anchors are dealt into parts, each part gets the lists that its anchors look up, once, as arrays of numbers, and one
function sums and keeps the k best. What is shuffled is lists and results. A part's lists have ``CELL`` postings at most:
there are as many parts as that takes, and lists that are too long for any are dealt into blocks of candidates, whose
k best are ranked once more. Without k all pairs are the result; they are joined, summed by pair and ranked by anchor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.functions import constants as c
from kinmatch.functions import sums
from kinmatch.functions import text as t
from kinmatch.sources.shared import ship, written


def _sounds(words: Column) -> Column:
    return F.transform(words, t.soundex)


def _name3() -> Column:
    return F.filter("name_tokens", lambda w: (F.length(w) >= 3) & ~w.isin(*c.NAME_STOP))


def _least(words: Column, n: int, stop: tuple[str, ...] = ()) -> Column:
    return F.filter(words, lambda w: (F.length(w) >= n) & ~w.isin(*stop)) if stop else F.filter(words, lambda w: F.length(w) >= n)


#: Keys of a record by name: arrays, whose repeats count again.
KEYS: dict[str, Callable[[], Column]] = {
    "name_token3": lambda: _least(F.col("name_tokens"), 3),
    "name_word": _name3,
    "name_sound": lambda: _sounds(F.col("name_tokens")),
    "name_word_sound": lambda: _sounds(_name3()),
    "number": lambda: F.col("addr_numbers"),
    "number2": lambda: _least(F.col("addr_numbers"), 2),
    "number2_once": lambda: F.array_distinct(_least(F.col("addr_numbers"), 2)),
    "addr_word3": lambda: _least(F.col("addr_tokens"), 3, c.ADDRESS_STOP),
    "addr_word4": lambda: _least(F.col("addr_tokens"), 4, c.ADDRESS_STOP),
    "addr_word5": lambda: _least(F.col("addr_tokens"), 5, c.ADDRESS_STOP_WIDE),
    "prefix3": lambda: F.array(t.prefix(F.col("norm_name"), 3)),
    "prefix4": lambda: F.array(t.prefix(F.col("norm_name"), 4)),
    "prefix5": lambda: F.array(t.prefix(F.col("norm_name"), 5)),
    "prefix4or3": lambda: F.array(F.coalesce(t.prefix(F.col("norm_name"), 4), t.prefix(F.col("norm_name"), 3))),
    "gram3": lambda: t.char_grams(F.col("norm_name"), 3),
    "gram3_all": lambda: t.char_grams(F.col("norm_name"), 3, False),
    "addr_word4_name_stop": lambda: _least(F.col("addr_tokens"), 4, c.NAME_STOP),
    "pin": lambda: F.array(t.indian_pin(F.col("norm_addr"))),
    "v2_number": lambda: t.long_numbers(F.col("light_addr")),
    "v2_name_word": lambda: t.words(F.col("light_name"), 3, c.RULE_STOP_V2),
    "v2_addr_word": lambda: t.words(F.col("light_addr"), 4, c.RULE_STOP_V2),
    "v3_name_word": lambda: t.words(F.col("light_name"), 3, c.RULE_STOP_V3),
    "v3_addr_word": lambda: t.words(F.col("light_addr"), 5, c.RULE_STOP_V3),
    "house_number": lambda: t.house_numbers(F.col("business_address")),
    "clean_word": lambda: t.clean_words(F.col("business_name")),
}


@dataclass(frozen=True)
class Weight:
    """``high`` where the key's length fits (at least, or exactly ``length``), else ``low``; times the idf with ``idf``."""

    high: float
    low: float | None = None
    length: int | None = None
    exact: bool = False
    idf: bool = False

    def column(self, key: Column, idf: Column) -> Column:
        w = F.lit(float(self.high))
        if self.length is not None:
            fits = F.length(key) == self.length if self.exact else F.length(key) >= self.length
            w = F.when(fits, float(self.high)).otherwise(float(self.low))
        return w * idf if self.idf else w


@dataclass(frozen=True)
class Postings:
    """Pool records by key. ``keys``: names in KEYS. ``df_keys``: what the document frequency counts, if something else.
    ``max_share``: keys with a frequency from this share of the pool on go. ``cap``: a list's first records by ordinal."""

    name: str
    keys: tuple[str, ...]
    df_keys: tuple[str, ...] | None = None
    max_share: float | None = None
    cap: int | None = None
    countries: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Probe:
    """Keys of an anchor looked up in a list; lists of more than ``skip_over`` records are passed over."""

    postings: str
    keys: str
    weight: Weight
    skip_over: int | None = None


@dataclass(frozen=True)
class Spec:
    """``per_source``: lists, frequencies and ranks for each pool source by itself. ``rank_per_source``: the same for ranks
    (and k) only, if they differ. ``idf``: "smooth" ln((n - df + 0.5) / (df + 0.5) + 1) or "plain" ln(n / (df + 1)).
    ``min_keys``: least number of shared keys. ``k`` None: all."""

    postings: tuple[Postings, ...]
    probes: tuple[Probe, ...]
    k: int | None = 15
    floor: float | None = None
    per_source: bool = True
    idf: str | None = None
    min_keys: int | None = None
    rank_per_source: bool | None = None

    @property
    def ranked(self) -> bool:
        return self.per_source if self.rank_per_source is None else self.rank_per_source


_PAIR = "array<struct<name:string,key:string>>"
#: Parts that a long list is dealt into before its cut, and the setting under which Spark limits groups before it shuffles.
SALTS, UNCAPPED, LIMIT_SETTING = 32, 10**9, "spark.sql.optimizer.windowGroupLimitThreshold"
#: Most postings that a task's part of the anchors meets, and most and least keys of anchors in a part.
CELL, MOST_PROBES, LEAST_PROBES = 1 << 23, 1 << 16, 1 << 8


def _structs(name: str, keys: Column) -> Column:
    return F.transform(F.filter(keys, lambda k: k.isNotNull() & (k != "")), lambda k: F.struct(F.lit(name).alias("name"), k.alias("key")))


def _rows(records: DataFrame, parts: list[Column], *more: str) -> DataFrame:
    """A row for each key of each record, in one pass over the records."""
    out = records.select("country", *more, F.explode(F.concat(*parts)).alias("k"))
    return out.select("country", *more, F.col("k.name").alias("name"), F.col("k.key").alias("key"))


def posting_rows(pool: DataFrame, lists: tuple[Postings, ...], by_df: bool = False) -> DataFrame:
    """(country, source, entity_id, ord, name, key) for every list."""
    parts = []
    for p in lists:
        keys = F.concat(*[_structs(p.name, KEYS[k]()) for k in (p.df_keys if by_df and p.df_keys else p.keys)])
        parts.append(F.when(F.col("country").isin(*p.countries), keys).otherwise(F.array().cast(_PAIR)) if p.countries else keys)
    return _rows(pool, parts, "source", "entity_id", "ord")


def document_frequencies(pool: DataFrame, spec: Spec) -> DataFrame:
    """(country, [source,] name, key, df, n): how many postings each key has, of a pool of n records."""
    group = ["country", *(["source"] if spec.per_source else [])]
    counts = posting_rows(pool, spec.postings, True).groupBy(*group, "name", "key").agg(F.count(F.lit(1)).alias("df"))
    sizes = pool.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))  # a row for each country and source
    return counts.join(F.broadcast(sizes), group)


def idf(kind: str | None, df: Column, n: Column) -> Column:
    if kind == "smooth":
        return F.log((n - df + 0.5) / (df + 0.5) + 1.0)
    if kind == "plain":
        return F.log(n / (df + 1.0))
    return F.lit(1.0)


def _by_name(lists: tuple[Postings, ...], of: Callable[[Postings], float | int | None]) -> Column | None:
    """A number by list, null where a list has none; None where no list has one."""
    out, some = F.lit(None).cast("double"), False
    for p in lists:
        if (v := of(p)) is not None:
            out, some = F.when(F.col("name") == p.name, float(v)).otherwise(out), True
    return out if some else None


def index(pool: DataFrame, spec: Spec) -> DataFrame:
    """The postings that probes may meet: without keys that are too frequent, cut to the caps, with ``df`` and ``n``."""
    group = ["country", *(["source"] if spec.per_source else [])]
    rows = posting_rows(pool, spec.postings)
    share, cap = _by_name(spec.postings, lambda p: p.max_share), _by_name(spec.postings, lambda p: p.cap)
    if not (spec.idf or share is not None or cap is not None or any(p.skip_over for p in spec.probes)):
        return rows.withColumns({"df": F.lit(None).cast("long"), "n": F.lit(None).cast("long")})
    sizes = pool.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(document_frequencies(pool, spec).drop("n"), [*group, "name", "key"], "left").join(F.broadcast(sizes), group)
    rows = rows.withColumn("df", F.coalesce("df", F.lit(0)))  # a key that no frequency counts is as rare as can be
    if share is not None:
        rows = rows.where(share.isNull() | (F.col("df") < share * F.col("n")))
    if cap is not None:
        own_count = _by_name(spec.postings, lambda p: 1 if p.df_keys else None)  # their list may be longer than df says
        long = cap.isNotNull() & ((F.col("df") > cap) | (own_count.isNotNull() if own_count is not None else F.lit(False)))
        most = max(p.cap for p in spec.postings if p.cap is not None)
        conf = rows.sparkSession.conf
        if int(conf.get(LIMIT_SETTING, "1000")) < most < UNCAPPED:
            conf.set(LIMIT_SETTING, str(most))
        parts = rows.where(long).withColumn("salt", F.pmod(F.xxhash64("entity_id"), F.lit(SALTS)))
        own = Window.partitionBy(*group, "name", "key", "salt").orderBy("ord", "entity_id")
        parts = parts.withColumn("place", F.row_number().over(own)).where(F.col("place") <= most).drop("salt", "place")
        place = F.row_number().over(Window.partitionBy(*group, "name", "key").orderBy("ord", "entity_id"))
        cut = parts.withColumn("place", place).where(F.col("place") <= cap).drop("place")
        rows = rows.where(~long | cap.isNull()).unionByName(cut)
    return rows


def candidates(anchors: DataFrame, pool: DataFrame, spec: Spec) -> DataFrame:
    """s1_id, cand_id, country, source, s1_ord, cand_ord, score (rounded to 6 digits) and rank (by score, then the
    candidate's ordinal) of each anchor's best ``k``. Anchors without a candidate have no row; see ``with_all_anchors``."""
    kinds = [(f"{i}", p) for i, p in enumerate(spec.probes)]
    probes = _rows(anchors, [_structs(i, KEYS[p.keys]()) for i, p in kinds], "entity_id", "ord")
    lists = F.create_map(*[F.lit(x) for i, p in kinds for x in (i, p.postings)])
    factor, by_idf, over = F.lit(None).cast("double"), F.lit(False), F.lit(None).cast("long")
    for i, p in kinds:
        this = F.col("name") == i
        factor = F.when(this, p.weight.column(F.col("key"), F.lit(1.0))).otherwise(factor)
        by_idf, over = by_idf | (this & p.weight.idf), over if p.skip_over is None else F.when(this, p.skip_over).otherwise(over)
    probes = probes.select("country", F.col("entity_id").alias("s1_id"), F.col("ord").alias("s1_ord"), lists[F.col("name")].alias("name"), "key", factor.alias("factor"), by_idf.alias("by_idf"), over.alias("over"))
    if spec.k is None:
        return _all_pairs(probes, pool, spec)
    return _best_pairs(probes, pool, spec)


def _all_pairs(probes: DataFrame, pool: DataFrame, spec: Spec) -> DataFrame:
    found = index(pool, spec).select("country", "source", "name", "key", F.col("entity_id").alias("cand_id"), F.col("ord").alias("cand_ord"), "df", "n")
    pairs = probes.join(found, ["country", "name", "key"]).where(F.col("over").isNull() | (F.col("df") <= F.col("over")))
    weight = F.col("factor") * F.when(F.col("by_idf"), idf(spec.idf, F.col("df"), F.col("n"))).otherwise(1.0)
    pairs = pairs.select("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord", weight.alias("w"))
    scored = pairs.groupBy("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord").agg(F.round(F.sum("w"), 6).alias("score"), F.count(F.lit(1)).alias("n_keys"))
    if spec.min_keys is not None:
        scored = scored.where(F.col("n_keys") >= spec.min_keys)
    if spec.floor is not None:
        scored = scored.where(F.col("score") >= spec.floor)
    return best(scored, None, spec.ranked)


def numbered(pool: DataFrame) -> DataFrame:
    """(country, entity_id, ord, no): every record once, with a number that grows with (ord, entity_id)."""
    each = pool.select("country", "entity_id", "ord").distinct().orderBy("ord", "entity_id", "country")
    return written(each.withColumn("no", F.monotonically_increasing_id()), "numbers")


def _met(pool: DataFrame, numbers: DataFrame, spec: Spec) -> DataFrame:
    """(country, source, name, key, df, idf, no): the index without lists that every probe of theirs passes over."""
    rows = index(pool, spec)
    for p in spec.postings:
        overs = [x.skip_over for x in spec.probes if x.postings == p.name]
        if overs and None not in overs:
            rows = rows.where((F.col("name") != p.name) | (F.col("df") <= max(overs)))
    rows = rows.join(numbers, ["country", "entity_id", "ord"])
    return written(rows.select("country", "source", "name", "key", "df", idf(spec.idf, F.col("df"), F.col("n")).alias("idf"), "no"), "index")


def cells(probes: int, postings: int, longest: int) -> tuple[int, int]:
    """(parts of anchors, blocks of candidates), so that a part's lists in a block have CELL postings or so at most."""
    if postings <= CELL:
        return max(1, -(-probes // MOST_PROBES)), 1
    blocks = max(1, -(-longest * LEAST_PROBES // CELL))
    fit = min(MOST_PROBES, max(LEAST_PROBES, CELL * blocks // max(1, longest)))
    return max(1, -(-probes // fit)), blocks


def _best_pairs(probes: DataFrame, pool: DataFrame, spec: Spec) -> DataFrame:
    ship(pool.sparkSession)
    key, k, floor, min_keys, per_source = ["country", "name", "key"], spec.k, spec.floor, spec.min_keys, spec.ranked
    probes, numbers = written(probes, "probes"), numbered(pool)
    found = _met(pool, numbers, spec)
    size = found.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).agg(F.sum("c").alias("all"), F.max("c").alias("most")).first()
    parts, blocks = cells(probes.count(), size["all"] or 0, size["most"] or 0)
    part = F.pmod(F.xxhash64("s1_id"), F.lit(parts)).cast("int").alias("part")
    block = F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int").alias("block")
    packed = found.groupBy(*key, "source", "df", "idf", block).agg(F.collect_list("no").alias("nos"))
    needed = probes.select(part, *[F.col(c).alias(c) for c in key]).distinct()  # aliases: else both sides of the cogroup have the same columns
    lists = needed.join(packed, key)
    probes = probes.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def best_of_cell(mine, theirs):
        from kinmatch.functions.sums import best_sums

        return best_sums(mine, theirs, k, floor, min_keys, per_source)

    out = probes.groupBy("part", "block").cogroup(lists.groupBy("part", "block")).applyInArrow(best_of_cell, sums.RESULT)
    out = out.join(numbers.select("country", "no", F.col("entity_id").alias("cand_id"), F.col("ord").alias("cand_ord")), "no")
    if blocks > 1:
        return best(out, k, per_source)
    return out.select("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord", "score", "rank")


def best(scored: DataFrame, k: int | None, per_source: bool = True) -> DataFrame:
    order = Window.partitionBy("s1_id", *(["source"] if per_source else [])).orderBy(F.desc("score"), "cand_ord", "cand_id")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if k is not None:
        ranked = ranked.where(F.col("rank") <= k)
    return ranked.select("s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord", "score", "rank")


def with_all_anchors(anchors: DataFrame, found: DataFrame) -> DataFrame:
    """(s1_id, candidates): every anchor with its candidates' ids in order, also those that have none."""
    lists = found.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("candidates"))
    out = anchors.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return out.select("s1_id", F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"))


def union(*found: DataFrame) -> DataFrame:
    """The pairs of several blockers, each once."""
    out = found[0].select("s1_id", "cand_id")
    for x in found[1:]:
        out = out.unionByName(x.select("s1_id", "cand_id"))
    return out.distinct()


def priority_union(found: list[DataFrame], cap: int = 50) -> DataFrame:
    """(s1_id, cand_id, priority, rank): pairs of several blockers, the first blocker's first (by its rank), at most
    ``cap`` for an anchor."""
    out = None
    for i, x in enumerate(found):
        one = x.select("s1_id", "cand_id", "cand_ord", F.struct(F.lit(i).alias("priority"), F.col("rank")).alias("at"))
        out = one if out is None else out.unionByName(one)
    out = out.groupBy("s1_id", "cand_id", "cand_ord").agg(F.min("at").alias("at"))
    order = Window.partitionBy("s1_id").orderBy("at", "cand_ord", "cand_id")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)
    return out.select("s1_id", "cand_id", F.col("at.priority").alias("priority"), "rank")
