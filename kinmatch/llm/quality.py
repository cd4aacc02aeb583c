"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document gets counts (words, symbols, repeated lines, repeated 3-word windows, capitals). Documents that fail the
two base rules go at once. The others are judged against their own language and source: for every rate a quantile
sketch per (language, source) gives the median and the lowest tenth, and a document is rejected where a rate lies more
than ``REACH`` spreads beyond the median. The spread is the distance from the lowest tenth to the median (the side that
junk, which has high rates, doesn't move) and at least the rate's resolution.

The sketch is a log-linear histogram over whole numbers (relative error 1/16): two sketches merge by adding counts, so
it is an ordinary partial aggregate whatever share of the rows a source holds, and its size is bounded by the number
of buckets. Small groups lean on larger ones without a switch: a language's sketch is merged with that of all documents,
scaled to ``PRIOR`` documents, and a group's with its language's, scaled alike. So each further document moves a group's
quantiles from its language's towards its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.llm.base import ship, small, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_shouts")
#: Rates in thousandths (word_length in hundredths of a character): numerator, denominator, scale, resolution, two-sided.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars", 1000, 10, False),
    "capital_rate": ("n_capitals", "word_chars", 1000, 20, False),
    "shout_rate": ("n_shouts", "word_chars", 1000, 10, False),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000, 100, False),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, 70, False),
    "word_length": ("word_chars", "n_words", 100, 40, True),
}
REACH = 5
PRIOR = 200
MIN_WORDS = 50


def counts_of(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text. Words are split at ASCII white space only, as bytes.split() does."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    w = raw.split()
    n = len(w)
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(set(zip(w, w[1:], w[2:], strict=False))) < max(0, n - 2):
        ids: dict[bytes, int] = {}
        a = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, n)
        _, pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
        _, inverse, often = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
        twice = often[inverse] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= twice
        repeated = int(covered.sum())
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), capitals, text.count("!")


def counts_column(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.quality import counts_of as one

        for s in parts:
            yield pd.DataFrame([one(t) for t in s], columns=list(COUNTS), dtype="int64")

    return of.asNondeterministic()(text)  # else a filter on the counts evaluates them a second time


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def rate(name: str) -> Column:
    top, bottom, scale, _, _ = RATES[name]
    return F.expr(f"CASE WHEN {bottom} > 0 THEN {scale} * {top} DIV {bottom} ELSE 0 END")


def bucket(x: Column) -> Column:
    """Index of a whole number's bucket: below 32 itself, then 16 buckets for each doubling."""
    shift = F.greatest(F.lit(0), F.length(F.bin(x)) - 5)
    return (16 * shift + F.call_function("shiftright", x, shift)).cast("int")


def bucket_low(b: Column) -> Column:
    """The least number in a bucket."""
    shift = F.greatest(F.lit(0), F.floor(b / 16).cast("int") - 1)
    return F.call_function("shiftleft", (b - 16 * shift).cast("long"), shift)


def group_key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang_key, source_key, rate, bucket, n) of the documents that pass the base rules."""
    each = F.array(*[F.struct(F.lit(r).alias("rate"), bucket(rate(r)).alias("bucket")) for r in RATES])
    rows = measured.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    rows = rows.select("lang_key", "source_key", F.explode(each).alias("x")).select("lang_key", "source_key", "x.*")
    return rows.groupBy("lang_key", "source_key", "rate", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _whole(x: Column) -> Column:
    return F.coalesce(x, F.lit(0)).cast("decimal(38,0)")


def fences(sketch: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """For each (lang_key, source_key) the highest and lowest rate that is kept: ``<rate>_most``, ``<rate>_least``. Counts
    are multiplied by the totals they would be divided by, so that they stay whole numbers."""
    own, cell = ["lang_key", "source_key"], ["rate", "bucket"]
    n = F.sum("n").alias("n")
    every = sketch.groupBy(*cell).agg(F.sum("n").alias("a"))
    every = every.join(F.broadcast(sketch.groupBy("rate").agg(F.sum("n").alias("a_all"))), "rate")  # one row for each rate
    lang = sketch.groupBy("lang_key", *cell).agg(F.sum("n").alias("l"))
    lang_all = sketch.groupBy("lang_key", "rate").agg(F.sum("n").alias("l_all"))
    groups = sketch.groupBy(*own, "rate").agg(n.alias("g_all"))
    grid = groups.join(F.broadcast(every), "rate")  # as many rows as a sketch has buckets
    grid = grid.join(lang_all, ["lang_key", "rate"]).join(lang, ["lang_key", *cell], "left").join(sketch.withColumnRenamed("n", "g"), [*own, *cell], "left")
    of_lang = _whole(F.col("l")) * _whole(F.col("a_all")) + prior * _whole(F.col("a"))
    lang_total = (_whole(F.col("l_all")) + prior) * _whole(F.col("a_all"))
    merged = grid.select(*own, *cell, ((_whole(F.col("g")) * lang_total).cast("decimal(38,0)") + (prior * of_lang).cast("decimal(38,0)")).cast("decimal(38,0)").alias("n"))
    group = Window.partitionBy(*own, "rate")
    run = merged.withColumn("total", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    low = bucket_low(F.col("bucket"))
    q = run.groupBy(*own, "rate").agg(F.min(F.when(F.col("upto") * 10 >= F.col("total"), low)).alias("q10"), F.min(F.when(F.col("upto") * 2 >= F.col("total"), low)).alias("q50"))
    resolution = F.create_map(*[F.lit(x) for r, v in RATES.items() for x in (r, v[3])])
    width = reach * F.greatest(F.col("q50") - F.col("q10"), resolution[F.col("rate")])
    return q.groupBy(*own).agg(
        *[F.max(F.when(F.col("rate") == r, F.col("q50") + width)).alias(f"{r}_most") for r in RATES],
        *[F.max(F.when(F.col("rate") == r, F.col("q50") - width)).alias(f"{r}_least") for r, v in RATES.items() if v[4]],
    )


def inside() -> Column:
    """Whether all rates lie within the fences; where there are none, that is so."""
    ok = F.lit(True)
    for r, v in RATES.items():
        ok = ok & (rate(r) <= F.col(f"{r}_most"))
        if v[4]:
            ok = ok & (rate(r) >= F.col(f"{r}_least"))
    return F.coalesce(ok, F.lit(True))


def _measured(docs: DataFrame) -> DataFrame:
    out = docs.select(F.col("doc_id"), group_key("lang").alias("lang_key"), group_key("source").alias("source_key"), counts_column(F.col("text")).alias("c"))
    return out.select("doc_id", "lang_key", "source_key", "c.*")


def judged(docs: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """One row per row of docs: doc_id, COUNTS, ``base_failed`` and ``kept``.

    Null and empty texts have zero counts and fail the base rules. Null languages and sources are groups of their own.
    Repeated rows are counted and judged each. An empty table gives no rows. Columns other than doc_id, text, lang and
    source are ignored.
    """
    ship(docs.sparkSession, small_batches=True)
    m = written(_measured(docs), "quality-counts")
    limits = written(fences(written(sketches(m), "quality-sketches"), reach, prior), "quality-limits")
    out = m.join(small(limits, 300), ["lang_key", "source_key"], "left")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & inside()).alias("kept"))


def filtered(docs: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """The rows of docs that are kept, with all their columns. Counts are taken a second time rather than shuffling texts
    to their verdicts."""
    ship(docs.sparkSession, small_batches=True)
    m = written(_measured(docs).drop("doc_id"), "quality-counts")
    limits = written(fences(written(sketches(m), "quality-sketches"), reach, prior), "quality-limits")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    own = docs.select(row, group_key("lang").alias("lang_key"), group_key("source").alias("source_key"), counts_column(F.col("text")).alias("c"))
    own = own.select("__row", "lang_key", "source_key", "c.*").where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    out = own.join(small(limits, 300), ["lang_key", "source_key"], "left").where(inside())
    return out.select("__row.*")


def sql(reach: int = REACH, prior: int = PRIOR) -> str:
    """DuckDB SQL for judged() over the table documents."""
    sep = r"[\x20\x09-\x0D]+"
    rates = {r: f"CASE WHEN {b} > 0 THEN {s} * {t} // {b} ELSE 0 END" for r, (t, b, s, _, _) in RATES.items()}
    long = " UNION ALL ".join(f"SELECT lk, sk, '{r}' AS rate, {e} AS x FROM passed" for r, e in rates.items())
    wide = ", ".join(f"max(CASE WHEN rate = '{r}' THEN q50 + {reach} * greatest(q50 - q10, {v[3]}) END) AS {r}_most, max(CASE WHEN rate = '{r}' THEN q50 - {reach} * greatest(q50 - q10, {v[3]}) END) AS {r}_least" for r, v in RATES.items())
    ok = " AND ".join(f"({rates[r]}) <= {r}_most" + f" AND ({rates[r]}) >= {r}_least" * v[4] for r, v in RATES.items())
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce('=' || lang, '') AS lk, coalesce('=' || source, '') AS sk FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '{sep}'), lambda x: x <> '') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS t(k) GROUP BY rid),
m AS (SELECT rid, doc_id, lk, sk, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{sep}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals, CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_shouts
  FROM w LEFT JOIN rep USING (rid)),
passed AS (SELECT * FROM m WHERE NOT {failed}),
xs AS ({long}),
bs AS (SELECT lk, sk, rate, greatest(0, length(bin(x)) - 5) AS s, x FROM xs),
b AS (SELECT lk, sk, rate, 16 * s + (x >> s) AS bucket, min((x >> s) << s) AS low, count(*) AS n FROM bs GROUP BY ALL),
va AS (SELECT rate, bucket, any_value(low) AS low, sum(n)::HUGEINT AS a FROM b GROUP BY rate, bucket), vt AS (SELECT rate, sum(n)::HUGEINT AS a_all FROM b GROUP BY rate),
la AS (SELECT lk, rate, bucket, sum(n)::HUGEINT AS l FROM b GROUP BY ALL), lt AS (SELECT lk, rate, sum(n)::HUGEINT AS l_all FROM b GROUP BY ALL),
gr AS (SELECT DISTINCT lk, sk, rate FROM b),
mg AS (SELECT lk, sk, rate, bucket, va.low, coalesce(b.n, 0)::HUGEINT * (l_all + {prior}) * a_all + {prior} * (coalesce(l, 0) * a_all + {prior} * a) AS n FROM gr JOIN va USING (rate) JOIN vt USING (rate) JOIN lt USING (lk, rate) LEFT JOIN la USING (lk, rate, bucket) LEFT JOIN b USING (lk, sk, rate, bucket)),
run AS (SELECT *, sum(n) OVER (PARTITION BY lk, sk, rate) AS total, sum(n) OVER (PARTITION BY lk, sk, rate ORDER BY bucket) AS upto FROM mg),
q AS (SELECT lk, sk, rate, min(CASE WHEN upto * 10 >= total THEN low END) AS q10, min(CASE WHEN upto * 2 >= total THEN low END) AS q50 FROM run GROUP BY ALL),
lim AS (SELECT lk, sk, {wide} FROM q GROUP BY ALL)
SELECT doc_id, {", ".join(COUNTS)}, {failed} AS base_failed, NOT {failed} AND coalesce({ok}, true) AS kept
FROM m LEFT JOIN lim USING (lk, sk)"""
