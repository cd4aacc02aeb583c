"""Benchmark decontamination by spaced-seed hashing.

A text's tokens (runs of letters and digits, lower-cased; letters of scripts that write no spaces singly) are hashed at
every position under fixed masks: a mask's zeros are token positions that the hash ignores, so a substituted token there
doesn't hide a copy. Equal hashes of documents and benchmark items give candidate alignments (document, item, diagonal).
Each is verified with the tokens themselves: along the diagonal, over all of the item that falls into the document, some
window of ``WINDOW`` tokens (the whole item where it is shorter) must hold at least ``MATCHED`` percent equal tokens. Items
under ``TOLERANT`` tokens must be there whole and unchanged; those under ``LEAST`` are words rather than passages.

The masks are chosen by an item's length so that whatever verification accepts holds a seed, wherever the substituted
tokens lie: the search loses nothing, which the tests try for all places. Documents are hashed under the masks that some
item of the benchmark needs.

The benchmark's seeds are broadcast only after they are counted and found to fit; else documents' seeds first pass a table
of bits of bounded size, made of the benchmark's seeds, and what passes is joined by a shuffle. Only ids and positions are
carried to the join; texts are taken up again for the documents that have candidates. Hits of one alignment are counted
before any shuffle, so a passage that a third of all documents holds costs one row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm import base
from kinmatch.llm.base import small, written

LEAST, TOLERANT, WINDOW, MATCHED = 4, 7, 12, 75
#: The masks, by the least number of tokens of the items they are for.
MASKS = {LEAST: ("1111",), TOLERANT: ("1111", "11011", "1100011"), 10: ("110111", "111011", "11001011", "110100011")}
CHUNK, SEED_BYTES = 4096, 64
#: Words of 64 bits in the table that documents' seeds pass before a shuffle.
FILTER_WORDS = 1 << 20
_BREAK = r"[^\p{L}\p{N}]+"
#: Thai and Lao, Burmese, Khmer, Kana, Han.
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


def tokens(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    low = F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.regexp_replace(low, f"({_UNSPACED})", " $1 "))
    clean = F.trim(F.regexp_replace(low, _BREAK, " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def _masks(n: Column) -> dict[str, Column]:
    """All masks, each with whether an item of n tokens has seeds under it."""
    starts = sorted(MASKS)
    out: dict[str, Column] = {}
    for at, end in zip(starts, [*starts[1:], None], strict=True):
        here = (n >= at) & (n < end) if end else n >= at
        for m in MASKS[at]:
            out[m] = out[m] | here if m in out else here
    return out


def needed(benchmark: DataFrame) -> list[str]:
    """The masks that some item of the benchmark has seeds under."""
    sizes = benchmark.select(F.size(tokens(F.col("text"))).alias("n"))
    found = sizes.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(m) for m, c in _masks(F.col("n")).items()]).first()
    return [m for m in _masks(F.col("n")) if found[m]]


def seeds(df: DataFrame, id_col: str, name: str, masks: list[str], of_items: bool = False) -> DataFrame:
    """(name, position, key) for every mask and position of each row's ``text``; of items, for the masks of their lengths."""
    span = max(map(len, masks), default=1)
    hashed = df.select(F.col(id_col).alias(name), F.transform(tokens(F.col("text")), lambda t: F.xxhash64(t)).alias("h"))
    hashed = hashed.where(F.size("h") >= min(map(len, masks), default=1)).withColumn("n", F.size("h"))
    cuts = F.transform(F.sequence(F.lit(0), F.size("h") - 1, F.lit(CHUNK)), lambda i: F.struct(i.alias("at"), F.slice("h", i + 1, F.lit(CHUNK + span - 1)).alias("h")))
    parts = hashed.select(name, "n", F.explode(cuts).alias("c")).select(name, "n", F.col("c.at").alias("at"), F.col("c.h").alias("h"))  # a very long text is many rows
    shifted = [F.slice("h", k + 1, F.size("h")) if k else F.col("h") for k in range(span)]
    own = F.sequence(F.col("at"), F.col("at") + F.least(F.size("h"), F.lit(CHUNK)) - 1)  # shorter than h where the next part begins
    rows = parts.select(name, "n", F.inline(F.arrays_zip(own.alias("position"), *[s.alias(f"h{k}") for k, s in enumerate(shifted)])))
    rows = rows.toDF(name, "n", "position", *[f"h{k}" for k in range(span)])
    served = _masks(F.col("n"))
    keys = []
    for m in masks:
        there = F.col(f"h{len(m) - 1}").isNotNull()
        keys.append(F.when(there & served[m] if of_items else there, F.xxhash64(F.lit(m), *[F.col(f"h{k}") for k, c in enumerate(m) if c == "1"])))
    keys = F.array(*keys) if keys else F.array().cast("array<bigint>")
    return rows.select(name, "position", F.explode(keys).alias("key")).where("key IS NOT NULL AND position IS NOT NULL")


def passing(hits: DataFrame, of_items: DataFrame) -> DataFrame:
    """The hits whose key may be among the items'. The table of bits has FILTER_WORDS rows at most, however large the benchmark."""
    word, bit = F.col("key").bitwiseAND(F.lit(FILTER_WORDS - 1)), F.expr(f"CAST(shiftright(key, {FILTER_WORDS.bit_length() - 1}) & 63 AS INT)")
    bits = of_items.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    return hits.withColumn("word", word).join(F.broadcast(bits), "word").where(F.getbit("bits", bit) == 1).drop("word", "bits")


def candidates(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, diagonal, hits): diagonal is a document's position less the item's."""
    masks = needed(benchmark)
    of_items = written(seeds(benchmark, "item_id", "item", masks, of_items=True).select("key", "item", F.col("position").alias("at")).distinct(), "seeds")
    hits = seeds(docs, "doc_id", "doc", masks)
    if of_items.count() * SEED_BYTES > base.BROADCAST_BYTES:
        hits = passing(hits, of_items).join(of_items, "key")
    else:
        hits = hits.join(F.broadcast(of_items), "key")
    return hits.groupBy("doc", "item", (F.col("position") - F.col("at")).alias("diagonal")).agg(F.count(F.lit(1)).alias("hits"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document that holds a benchmark item or enough of it: doc_id, item_id, ``doc_start`` and
    ``item_start`` (token positions where the compared stretch begins), ``n_compared``, ``n_equal`` and ``best_window``
    (most equal tokens in a window). Of several alignments, the one with most equal tokens, then the first.

    Null and empty texts, and items of fewer than LEAST tokens, hold no seed and match nothing. Rows with one doc_id are
    one document, rows with one item_id one item; null ids are ids. Empty tables give no rows. Other columns are ignored.
    """
    found = written(candidates(docs, benchmark), "candidates")
    items = written(benchmark.select(F.col("item_id").alias("it_id"), tokens(F.col("text")).alias("it")), "items")
    pairs = docs.select("doc_id", "text").join(small(found, 64), F.col("doc_id").eqNullSafe(F.col("doc")))
    pairs = pairs.select("doc_id", "item", "diagonal", tokens(F.col("text")).alias("dt"))
    size = items.agg(F.sum(F.aggregate("it", F.lit(64).cast("long"), lambda acc, x: acc + 32 + F.octet_length(x)))).first()[0] or 0
    items = F.broadcast(items) if size <= base.BROADCAST_BYTES else items  # by the tokens' real bytes: one can be of any length
    return verified(pairs.join(items, F.col("item").eqNullSafe(F.col("it_id"))))


def verified(pairs: DataFrame) -> DataFrame:
    start = F.greatest(F.lit(0), F.col("diagonal"))
    n = F.least(F.size("dt"), F.size("it") + F.col("diagonal")) - start
    cut = pairs.select("doc_id", "item", "diagonal", start.alias("doc_start"), (start - F.col("diagonal")).alias("item_start"), n.alias("n"), "it", "dt").where("n > 0")
    equal = F.zip_with(F.slice("dt", F.col("doc_start") + 1, F.col("n")), F.slice("it", F.col("item_start") + 1, F.col("n")), lambda a, b: (a == b).cast("int"))
    cut = cut.select("doc_id", "item", "diagonal", "doc_start", "item_start", "n", F.least(F.lit(WINDOW), F.size("it")).alias("w"), equal.alias("e")).where("n >= w")
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("w") + 1), lambda s: total(F.slice("e", s, F.col("w")))))
    scored = cut.select("doc_id", "item", "diagonal", "doc_start", "item_start", F.col("n").alias("n_compared"), total(F.col("e")).alias("n_equal"), best.alias("best_window"), "w")
    kept = scored.where(F.col("best_window") * 100 >= F.col("w") * F.when(F.col("w") < TOLERANT, 100).otherwise(MATCHED))
    top = F.max_by(F.struct("doc_start", "item_start", "n_compared", "n_equal", "best_window"), F.struct(F.col("n_equal"), -F.col("diagonal")))
    return kept.groupBy("doc_id", F.col("item").alias("item_id")).agg(top.alias("t")).select("doc_id", "item_id", "t.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that hold no benchmark item."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    bad = written(overlaps(docs, benchmark).select(F.col("doc_id").alias("bad")).distinct().withColumn("hit", F.lit(True)), "contaminated")
    return docs.select(row).join(small(bad, 80), F.col("row.doc_id").eqNullSafe(F.col("bad")), "left").where("hit IS NULL").select("row.*")


def sql() -> str:
    """DuckDB SQL for overlaps() over the tables documents and benchmark; seeds are the tokens themselves."""
    served = {m: [at for at in sorted(MASKS) if m in MASKS[at]] for masks in MASKS.values() for m in masks}
    ends = dict(zip(sorted(MASKS), [*sorted(MASKS)[1:], 1 << 31], strict=True))

    def keys(of_items: bool) -> str:
        parts = []
        for m, starts in served.items():
            own = "(" + " OR ".join(f"len(t) >= {at} AND len(t) < {ends[at]}" for at in starts) + ")"
            there = f"i + {len(m) - 1} <= len(t)" + (f" AND {own}" if of_items else "")
            parts.append(f"CASE WHEN {there} THEN concat_ws(' ', '{m}', {', '.join(f't[i + {k}]' for k, c in enumerate(m) if c == '1')}) END")
        return ", ".join(parts)

    toks = rf"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '({_UNSPACED})', ' \1 ', 'g'), '{_BREAK}', ' ', 'g')), ' '), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT doc_id, {toks} AS t FROM documents), b AS (SELECT item_id, {toks} AS t FROM benchmark),
dk AS (SELECT doc_id, i, unnest([{keys(False)}]) AS k FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM d)),
bk AS (SELECT DISTINCT item_id, i, unnest([{keys(True)}]) AS k FROM (SELECT item_id, t, unnest(range(1, len(t) + 1)) AS i FROM b)),
c AS (SELECT DISTINCT doc_id, item_id, dk.i - bk.i AS o FROM dk JOIN bk USING (k)),
s AS (SELECT doc_id, item_id, o, greatest(0, o) AS doc_start, greatest(0, o) - o AS item_start, least(len(d.t), len(b.t) + o) - greatest(0, o) AS n, least({WINDOW}, len(b.t)) AS w, d.t AS dt, b.t AS it FROM c JOIN d USING (doc_id) JOIN b USING (item_id)),
e AS (SELECT * EXCLUDE (dt, it), list_transform(range(1, n + 1), lambda j: CASE WHEN dt[doc_start + j] = it[item_start + j] THEN 1 ELSE 0 END) AS e FROM s WHERE n >= w),
r AS (SELECT *, list_sum(e) AS n_equal, list_max(list_transform(range(1, n - w + 2), lambda j: list_sum(e[j:j + w - 1]))) AS best_window FROM e)
SELECT doc_id, item_id, CAST(doc_start AS INT) AS doc_start, CAST(item_start AS INT) AS item_start, CAST(n AS INT) AS n_compared, CAST(n_equal AS INT) AS n_equal, CAST(best_window AS INT) AS best_window
FROM r WHERE best_window * 100 >= w * CASE WHEN w < {TOLERANT} THEN 100 ELSE {MATCHED} END QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, o) = 1"""
