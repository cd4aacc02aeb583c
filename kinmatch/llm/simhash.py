"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Fingerprints (64 bits) link at ``max_bits`` = 4 or fewer differing bits. Four differing bits touch at most four of the
eight bytes, so linked fingerprints agree in at least four byte positions: the guaranteed minimum of matches.

Postings keyed by one (position, byte) hold a 256th of all fingerprints each, so tallying them makes a quadratic number
of pairs. The index is therefore keyed by (three positions, their three bytes), for the 20 position triples of a Turan
system: every set of four positions contains one of them, so every pair with four agreeing positions meets in a posting
list, and lists of unrelated fingerprints stay short (24 key bits). Within a list each pair's agreeing byte positions
are tallied, pairs under the minimum go, the rest are verified by their differing bits.

A list is worked off by visiting: a fingerprint takes everything unvisited within reach into its component and is never
compared with it again. That yields the links of a spanning forest, so a group of thousands of near copies costs about
as many links as members and not all pairs. Lists over ``max_list`` members are split on more bits before any task reads them
(first a fourth byte, then fifths of the bits that are left, of which one must agree whole), until at most 2^12
fingerprints can differ at all; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.base import ship, small, written

#: Words hashed at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 15
MAX_LIST = 4096
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, size: int = 4) -> int:
    """SimHash of a text's word shingles as an unsigned number; 0 where there is no word."""
    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return 0
    counts, n, digest = np.zeros(64, np.int64), max(1, len(w) - size + 1), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        if len(w) < size:
            h = [digest(b" ".join(w), 42)]
        else:
            part = w[at : at + CHUNK + size - 1]
            h = [digest(b" ".join(x), 42) for x in zip(*(part[k:] for k in range(size)), strict=False)]
        bits = np.unpackbits(np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, size: int = 4) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.llm.simhash import fingerprint as one

        for s in parts:
            yield pd.Series(np.array([one(t, size) for t in s], dtype=np.uint64).view(np.int64))

    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def position_sets(n: int = 8, least: int = 4) -> list[tuple[int, ...]]:
    """Sets of least - 1 positions of which every set of ``least`` positions contains one. For 4 of 8 positions, Turan's
    construction: the positions in three rings; triples within a ring, or two in a ring and one in the next."""
    if (n, least) != (8, 4):
        return list(combinations(range(n), least))
    ring = [i % 3 for i in range(n)]
    found = []
    for t in combinations(range(n), 3):
        c = sorted(ring[i] for i in t)
        if c[0] == c[2] or (len(set(c)) == 2 and (c[1] + 1) % 3 == next(x for x in c if c.count(x) == 1)):
            found.append(t)
    return found


def _byte_mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _finer(mask: int, max_bits: int) -> list[int]:
    """Masks, each with more bits than ``mask``, of which linked fingerprints that agree on ``mask`` agree on one."""
    free = [i for i in range(64) if not mask >> i & 1]
    whole = [p for p in range(8) if not mask >> (8 * p) & 0xFF]
    if len(whole) == 5:  # three bytes agree, and at least four must
        return [mask | _byte_mask((p,)) for p in whole]
    blocks = [b for b in np.array_split(np.array(free), max_bits + 1) if len(b)]
    return [mask | sum(1 << int(i) for i in b) for b in blocks]


def forest(members: np.ndarray, least: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members (uint64) that agree in ``least`` bytes and differ in ``max_bits`` bits at most."""
    left, links, queue = members, [], []
    while len(left) or queue:
        if not queue:
            queue, left = [left[0]], left[1:]
        at = queue.pop()
        if not len(left):
            continue
        differ = left ^ at
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # the tally of shared positional bytes
        near = shared >= least
        near[near] = np.bitwise_count(differ[near]) <= max_bits
        if near.any():
            found = left[near]
            links += [(int(at), int(x)) for x in found]
            queue += list(found)
            left = left[~near]
    return links


def _list_links(max_bits: int, least: int):
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.llm.simhash import forest as one

        for s in parts:
            out = []
            for x in s:
                links = one(np.sort(np.array(x, dtype=np.int64).view(np.uint64)), least, max_bits)
                ab = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                out.append([{"a": int(a), "b": int(b)} for a, b in ab])
            yield pd.Series(out)

    return of


def links(nodes: DataFrame, max_bits: int = 4, max_list: int = MAX_LIST) -> DataFrame:
    """Links (a, b) that connect what is connected among distinct fingerprints ``fp`` (long), in a spanning forest for
    each posting list. Every fingerprint pair within ``max_bits`` bits is connected through them."""
    if not 0 <= max_bits <= 4:
        raise ValueError("eight bytes guarantee four shared positions for at most 4 differing bits")
    if max_list < 32:
        raise ValueError("lists of fewer than 2^5 members cannot always be split further")
    masks = [_byte_mask(t) for t in position_sets()]
    level, found, udf = nodes.select("fp"), [], _list_links(max_bits, 8 - max_bits)
    at = F.explode(F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks]))
    postings = level.select("fp", at.alias("k")).select("k.mask", "k.key", "fp")
    while True:
        sizes = postings.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = written(sizes, "simhash-lists")
        shared = postings.join(sizes, ["mask", "key"])
        lists = shared.where(F.col("n") <= max_list).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(lists.select(F.explode(udf("fps")).alias("l")).select("l.a", "l.b"))
        hot = [r["mask"] for r in sizes.where(F.col("n") > max_list).select("mask").distinct().collect()]  # at most one for each mask in use
        if not hot:
            break
        finer = {m: _finer(m & (1 << 64) - 1, max_bits) for m in hot}
        pick = F.lit(None).cast("array<long>")
        for m, xs in finer.items():
            pick = F.when(F.col("mask") == m, F.array(*[F.lit(_signed(x)) for x in xs])).otherwise(pick)
        again = shared.where(F.col("n") > max_list).select("fp", F.explode(pick).alias("mask"))
        postings = written(again.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct(), "simhash-finer")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for each node with a link. Alternating large and small stars; every
    round is a table in the shared folder, so a lost executor costs one round at most."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("m", F.least("low", "u"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(e.select("x.u", "x.v").where("u <> v").distinct(), "stars")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, max_bits: int = 4, max_list: int = MAX_LIST) -> DataFrame:
    """One row per document: id, ``fp`` (long), ``component_id`` (smallest id reachable over links, itself included).

    Null, empty and word-less texts have fingerprint 0 and are linked like any other. Texts with fewer than ``size``
    words are one shingle. Repeated rows stay, each with the same component. Rows with a null id keep it and take their
    component's id from the others (null where there is none). An empty table gives no rows. Other columns are ignored.
    """
    ship(docs.sparkSession, small_batches=True)
    base = written(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), size).alias("fp")), "fingerprints")
    nodes = base.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes, max_bits, max_list))
    # only fingerprints with links get another component than their own smallest id
    linked = written(nodes.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "least"), "linked")
    lowest = linked.groupBy("root").agg(F.min("least").alias("lowest"))
    of = nodes.join(linked.join(lowest, "root").select("fp", "lowest"), "fp", "left").select("fp", F.coalesce("lowest", "least").alias("component_id"))
    of = written(of, "components")
    # as many rows as fingerprints: never broadcast by us; both sides are tables, so a fingerprint with many copies is split
    return base.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def first_of_groups(docs: DataFrame, **settings) -> DataFrame:
    """docs with one document of each group of near duplicates: the one with the smallest id.

    All columns stay as they are. Rows that repeat an id are one document: one of them stays. Rows with a null id stay."""
    return first_of(docs, near_duplicates(docs, **settings))


def first_of(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """first_of_groups() by given ``groups`` (doc_id, component_id)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    ids = groups.groupBy(F.col("doc_id").alias("id"))
    marks = ids.agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    marks = written(marks.where("id IS NOT NULL AND (NOT first OR n > 1)"), "marks")
    out = docs.select(row).join(small(marks, 80), F.col("row.doc_id") == F.col("id"), "left").where("first IS NULL OR first")
    if not marks.where("first").isEmpty():
        out = out.where("n IS NULL").unionByName(out.where("n IS NOT NULL").dropDuplicates(["id"]))
    return out.select("row.*")
