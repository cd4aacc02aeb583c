"""Near-duplicates by the exact Jaccard similarity of word shingles: SimHash first, an index by prefixes for the rest, a
check of each pair.

SimHash as in ``simhash`` (fingerprints, index by byte positions, count filter, links at four bits) proposes pairs, of which
those of similarity t or more link. It misses pairs, so an index by prefixes completes it, without those that it has connected.

A text's shingles are put into one order that holds for all texts, rare ones first. Two sets of similarity t share at least
t of either's shingles, so they share one among the first n - ceil(t n) + 1 of each, and for the smaller set already among
its first n - ceil(2t / (1 + t) n) + 1: an index of those prefixes lets every pair of similarity t or more meet, whatever
the texts differ in (words here and there, a tail, a block). Two bounds take pairs out before their sets are compared:
  * Each set has 256 parity bits, bit i telling whether an odd number of its hashes end in i. Two sets differ in as many
    shingles as bits, at least; pairs that differ in too many don't meet.
  * The others are tallied: with ``m`` prefix shingles in common, the last at places i and j, no more than m and the
    shorter rest behind those places can be shared.
What the tally leaves is held against 4096 parity bits of each set, made for candidates only: half a kilobyte is moved for a
pair in place of two sets. Sets are compared for the pairs that stay, which nearly all are links unless their texts are very long.

The order decides how many pairs meet, never which are found. Shingles that are frequent in a sample of bounded size come last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.llm.base import ship, small, written
from kinmatch.llm import simhash
from kinmatch.llm.simhash import _LOWER, components, first_of

#: The least similarity of a link, as a fraction, so that the comparison is one of whole numbers.
LEAST = (4, 5)
SAMPLE_DOCS, SAMPLE_MIN, MAX_FREQUENT = 20000, 4, 1 << 16
#: 64-bit words of parity bits: of every set, and of the candidates'.
LONG_LIST, WORDS, WIDE_WORDS = 64, 4, 64


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct hashes (uint64, ascending) of a text's word shingles; of all its words where they are fewer than ``size``."""
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    parts = zip(*(w[k:] for k in range(size)), strict=False) if len(w) >= size else [w]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), 42) for x in parts), np.uint64))


def shingle_column(text: Column, size: int, frequent: dict[int, int], keep: str = "all", words: int = WORDS) -> Column:
    """(mark, n, fp, bits, s): a hash of the whole set, its size, the text's SimHash (with "prefix" only), its parity bits
    (``words`` times 64, a power of two) and its shingles in the order of the index. ``keep`` tells which of these: "all", those of the "prefix", or "none"."""
    values = np.array(sorted(frequent), dtype=np.uint64)
    counts = np.array([frequent[int(v)] for v in values], dtype=np.int64)
    top, bottom = LEAST

    @F.pandas_udf("mark long, n long, fp long, bits array<long>, s array<long>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.base import let_go
        from kinmatch.llm.jaccard import shingles as one
        from kinmatch.llm.simhash import fingerprint

        let_go()

        for texts in parts:
            rows = []
            for t in texts:
                s = one(t, size)
                n = len(s)
                mark = np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 42)).astype(np.int64)
                odd = np.packbits(np.bincount(s.view(np.int64) & 64 * words - 1, minlength=64 * words) & 1, bitorder="little").view("<i8")
                if keep == "none":
                    s = s[:0]
                elif len(values) and n:
                    at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                    s = s[np.lexsort((s, np.where(values[at] == s, counts[at], 0)))]
                if keep == "prefix" and n:
                    s = s[: n - (n * top + bottom - 1) // bottom + 1].copy()
                fp = np.uint64(fingerprint(t) if keep == "prefix" else 0).astype(np.int64)
                rows.append((mark, n, fp, odd, s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["mark", "n", "fp", "bits", "s"])

    # else a later join's test for nulls goes below the semi-join that chooses texts, and the function runs over all of them
    return of.asNondeterministic()(text)


def frequent_shingles(docs: DataFrame, text_col: str, size: int) -> dict[int, int]:
    """Frequent shingles of a sample of some SAMPLE_DOCS texts, MAX_FREQUENT at most."""
    share = SAMPLE_DOCS / max(1, docs.count())
    some = docs.select(text_col) if share >= 1 else docs.select(text_col).sample(share, 7)
    each = some.select(shingle_column(F.col(text_col), size, {}).alias("x")).select(F.explode("x.s").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= SAMPLE_MIN).orderBy(F.desc("c"), "key").limit(MAX_FREQUENT)
    return {r["key"] & (1 << 64) - 1: r["c"] for r in often.collect()}


def _may_link(a: str, b: str) -> Column:
    """Whether sizes and parity bits of two sets allow a link."""
    top, bottom = LEAST
    n1, n2 = F.col(f"{a}_n"), F.col(f"{b}_n")
    apart = sum((F.bit_count(F.col(f"{a}_p{i}").bitwiseXOR(F.col(f"{b}_p{i}"))) for i in range(WORDS)), F.lit(0))
    return (bottom * F.least(n1, n2) >= top * F.greatest(n1, n2)) & ((top + bottom) * apart <= (bottom - top) * (n1 + n2))


def _verified(pairs: DataFrame, load: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of LEAST or more."""
    top, bottom = LEAST

    def both(pairs: DataFrame, what: str) -> DataFrame:
        nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-nodes")
        used = written(load(nodes, what), f"candidate-{what}")
        a, b = (used.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col(what).alias(f"of{x}")) for x in "ab")
        return pairs.select("a", "b").join(a, "a").join(b, "b")

    apart = F.aggregate(F.zip_with("ofa", "ofb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda k, x: k + x)
    near = written(both(pairs, "bits").where((top + bottom) * apart <= (bottom - top) * (F.col("na") + F.col("nb"))).select("a", "b"), "near")
    shared = F.size(F.array_intersect("ofa", "ofb"))
    return both(near, "s").where((top + bottom) * shared >= top * (F.col("na") + F.col("nb"))).select("a", "b")


def simhash_links(nodes: DataFrame, load: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links (a, b) of similarity LEAST or more among the pairs that SimHash proposes. ``nodes`` has each distinct set's (node,
    fp). Sets of one fingerprint are compared with the first of them, and of linked fingerprints the first ones."""
    each = written(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("sets")), "fingerprints")
    same = nodes.join(small(each.where("sets > 1"), 40), "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = written(simhash.links(each), "fingerprint-links")
    a, b = (each.select(F.col("fp").alias(f"fp_{x}"), F.col("first").alias(x)) for x in "ab")
    near = near.select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b")).join(a, "fp_a").join(b, "fp_b").select("a", "b")
    return written(_verified(written(same.unionByName(near), "simhash-pairs"), load), "simhash-links")


def links(prefixes: DataFrame, load: Callable[[DataFrame, str], DataFrame], long_list: int = LONG_LIST, first: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that connect what is connected among distinct sets, all of similarity LEAST or more. ``prefixes`` has each
    set's (node, n, bits, s), s its prefix; ``load`` gives (node, n, s), whole sets, or (node, n, bits), their wide parity bits,
    for a table of some nodes. ``first``: links that are known; what they connect doesn't meet again.

    Members of lists over ``long_list`` are first compared with one of their list, if their sizes allow a link: the one
    that is in most long lists. In a large group of near copies that is the same for nearly all lists (what the others
    are copies of), so they cost about a pair each, and only pairs are left that this has not connected."""
    top, bottom = LEAST
    each = prefixes.where("n > 0").select("node", "n", F.posexplode("s").alias("at", "key"))
    shared = each.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("members > 1")
    own = ("node", "n", "at", *[f"p{i}" for i in range(WORDS)])
    bits = prefixes.select("node", *[F.get("bits", F.lit(i)).alias(f"p{i}") for i in range(WORDS)])
    shared = written(shared.join(bits, "node").select("key", "members", *own), "prefix-lists")

    found = first
    a, b = (shared.select("key", *[F.col(c).alias(f"{x}_{c}") for c in own]) for x in "ab")
    long = shared.where(F.col("members") > long_list)
    if not long.isEmpty():
        lists = long.groupBy("node").agg(F.count(F.lit(1)).alias("lists"))
        star = long.join(lists, "node").groupBy("key").agg(F.max_by(F.struct(*own), F.struct("lists", -F.col("node"))).alias("a"))
        star = star.select("key", *[F.col(f"a.{c}").alias(f"a_{c}") for c in own])
        pairs = long.select("key", *[F.col(c).alias(f"b_{c}") for c in own]).join(star, "key").where(_may_link("a", "b") & (F.col("a_node") != F.col("b_node")))
        stars = written(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "stars")
        stars = written(_verified(stars, load), "star-links")
        found = stars if first is None else first.unionByName(stars)
    if found is not None:
        roots = written(components(found), "star-roots")
        a, b = (y.join(small(roots.select(F.col("node").alias(f"{x}_node"), F.col("root").alias(f"{x}_root")), 80), f"{x}_node", "left") for x, y in (("a", a), ("b", b)))
    apart = F.lit(True) if found is None else F.coalesce("a_root", "a_node") != F.coalesce("b_root", "b_node")
    # a is the smaller set, or of equal ones that of the lower number; it is looked up by its shorter prefix only
    a = a.where(F.col("a_at") < F.col("a_n") - F.ceil(2 * top * F.col("a_n") / (top + bottom)) + 1)
    smaller = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_node") < F.col("b_node")))
    met = a.join(b, "key").where(smaller & apart & _may_link("a", "b"))
    tally = met.groupBy(F.col("a_node").alias("a"), F.col("b_node").alias("b")).agg(
        F.count(F.lit(1)).alias("m"), (F.max("a_n") - F.max("a_at") - 1).alias("a_rest"), (F.max("b_n") - F.max("b_at") - 1).alias("b_rest"), F.max(F.col("a_n") + F.col("b_n")).alias("sum_n")
    )
    pairs = written(tally.where((top + bottom) * (F.col("m") + F.least("a_rest", "b_rest")) >= top * F.col("sum_n")).select("a", "b"), "candidates")
    out = _verified(pairs, load)
    return out if found is None else out.unionByName(found)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, long_list: int = LONG_LIST) -> DataFrame:
    """One row per document: id and ``component_id``, the smallest id reachable over links, itself included. Two texts
    link if their sets of word shingles have a Jaccard similarity of LEAST or more.

    Null, empty and word-less texts have the empty set and are one group. Texts with fewer than ``size`` words are one
    shingle. Repeated rows, null ids, empty tables and other columns are as in simhash.near_duplicates()."""
    ship(docs.sparkSession, small_batches=True)
    frequent = frequent_shingles(docs, text_col, size)
    text_hash = F.xxhash64(F.col(text_col)).alias("text_hash")
    base = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_hash, shingle_column(F.col(text_col), size, frequent, "prefix").alias("x"))
    base = written(base.select("id", "row", "text_hash", "x.*"), "shingles")
    nodes = written(base.groupBy("mark").agg(F.min("id").alias("least"), F.min("row").alias("node"), F.min("fp").alias("fp"), F.count(F.lit(1)).alias("copies")), "shingle-nodes")
    again = base.select("mark", "row").join(nodes.where("copies > 1").select("mark", "node"), "mark").where("row <> node").select("row")
    prefixes = base.join(small(written(again, "copies"), 40), "row", "left_anti").select(F.col("row").alias("node"), "n", "bits", "s")

    def load(wanted: DataFrame, what: str) -> DataFrame:
        """Whole sets and wide bits are taken from the texts again: those of all texts would need more room than the texts."""
        rows = base.select(F.col("row").alias("node"), "text_hash", "mark").join(small(wanted, 40), "node", "left_semi")
        rows = written(rows, "candidate-rows")
        texts = docs.select(F.col(text_col).alias("text"), text_hash).join(small(rows.select("text_hash"), 40), "text_hash", "left_semi")
        made = shingle_column(F.col("text"), size, {}, "all" if what == "s" else "none", WIDE_WORDS if what == "bits" else WORDS)
        each = texts.select(made.alias("x")).select("x.mark", "x.n", f"x.{what}")
        return each.join(small(rows.select("node", "mark"), 48), "mark").groupBy("node").agg(F.first("n").alias("n"), F.first(what).alias(what))

    first = simhash_links(nodes.select("node", "fp"), load)
    roots = components(links(prefixes, load, long_list, first))
    linked = written(nodes.join(roots, "node").select("node", "root", "least"), "linked")
    lowest = linked.groupBy("root").agg(F.min("least").alias("lowest"))
    of = written(nodes.select("mark", "node", "least").join(linked.join(lowest, "root").select("node", "lowest"), "node", "left").select("mark", F.coalesce("lowest", "least").alias("component_id")), "components")
    return base.select("id", "mark").join(of, "mark").select(F.col("id").alias(id_col), "component_id")


def first_of_groups(docs: DataFrame) -> DataFrame:
    """docs with one document of each group of near duplicates, as simhash.first_of_groups()."""
    return first_of(docs, near_duplicates(docs))
