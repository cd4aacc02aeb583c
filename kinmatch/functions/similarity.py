"""String similarity kernels and one Arrow function that runs them all over candidate pairs.

``ratio`` is the normalised insert-and-delete similarity, 200 * LCS / (|a| + |b|); Spark's levenshtein counts
substitutions as one and is another measure.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kinmatch.sources.shared import ship


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of positions at a time."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & at.get(ch, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 100; two empty texts are equal."""
    n = len(a) + len(b)
    return 200.0 * lcs(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of: the two remainders behind the common tokens, and the common tokens against either side."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    shared = len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    one, two = shared + gap + len(left), shared + gap + len(right)
    best = 100.0 - 100.0 * (len(left) + len(right) - 2 * lcs(left, right)) / (one + two)
    if shared:
        best = max(best, 100.0 - 100.0 * (gap + len(left)) / (shared + one), 100.0 - 100.0 * (gap + len(right)) / (shared + two))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The shorter text against every stretch of the longer of its length, and against shorter ones at the ends."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100.0
    m, n = len(short), len(long)
    letters, best = set(short), 0.0
    for start in range(1 - m, n):
        part = long[max(0, start) : start + m]
        if (start < 0 and part[-1] not in letters) or (start + m > n and part[0] not in letters):
            continue
        if 200.0 * min(m, len(part)) / (m + len(part)) > best:
            best = max(best, ratio(short, part))
    if m == n and best < 100.0:
        for start in range(1 - m, n):
            best = max(best, ratio(long, short[max(0, start) : start + m]))
    return best


def jaro_winkler(a: str, b: str) -> float:
    """0 to 1; up to four equal first letters lift a similarity above 0.7."""
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(0, max(n, m) // 2 - 1)
    used, hit = [False] * m, []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hit.append(ch)
                break
    if not hit:
        return 0.0
    swaps = sum(x != y for x, y in zip(hit, (b[j] for j in range(m) if used[j]), strict=True)) // 2
    k = len(hit)
    sim = (k / n + k / m + (k - swaps) / k) / 3
    if sim > 0.7:
        same = 0
        while same < min(4, n, m) and a[same] == b[same]:
            same += 1
        sim += same * 0.1 * (1 - sim)
    return sim


@lru_cache(maxsize=1 << 16)
def _names(a: str, b: str) -> tuple[float, ...]:
    """Cached: a hot anchor meets the same names again and again."""
    if not a or not b:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    x, y = ([t for t in s.split() if len(t) >= 2] for s in (a, b))
    first = ratio(x[0], y[0]) / 100 if x and y else 0.0
    return jaro_winkler(a, b), ratio(a, b) / 100, token_sort_ratio(a, b) / 100, token_set_ratio(a, b) / 100, partial_ratio(a, b) / 100, first


KERNELS = ("name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_partial_ratio", "first_token_ratio", "addr_token_sort_ratio", "addr_levenshtein_ratio")


def _doubles(*names: str) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


@F.pandas_udf(_doubles(*KERNELS))
def _kernels(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for n1, n2, a1, a2 in parts:
        rows = [(*_names(p, q), *((token_sort_ratio(r, s) / 100, ratio(r, s) / 100) if r and s else (0.0, 0.0))) for p, q, r, s in zip(n1, n2, a1, a2, strict=True)]
        yield pd.DataFrame(rows, columns=list(KERNELS), dtype="float64")


def _here() -> None:
    """The executors must find this module: the functions above are known to them by name."""
    ship(SparkSession.active())


def kernels(name1: Column, name2: Column, addr1: Column, addr2: Column) -> Column:
    """All kernels of a pair in one trip to Python, 0 where a side is empty."""
    _here()
    return _kernels(*[F.coalesce(x, F.lit("")) for x in (name1, name2, addr1, addr2)])


@F.pandas_udf(DoubleType())
def _token_sort(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in parts:
        yield pd.Series([token_sort_ratio(x, y) if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def token_sort(a: Column, b: Column) -> Column:
    """token_sort_ratio, 0 to 100, 0 where a side is empty."""
    _here()
    return _token_sort(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


@F.pandas_udf(_doubles("n", "a"))
def _rule_ratios(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for n1, n2, a1, a2 in parts:
        rows = [(max(token_sort_ratio(p, q), token_set_ratio(p, q)) if p and q else 0.0, token_sort_ratio(r, s) if r and s else 0.0) for p, q, r, s in zip(n1, n2, a1, a2, strict=True)]
        yield pd.DataFrame(rows, columns=["n", "a"], dtype="float64")


def rule_ratios(name1: Column, name2: Column, addr1: Column, addr2: Column) -> Column:
    """(n, a): name and address similarity as the rule scorers take them, 0 to 100."""
    _here()
    return _rule_ratios(*[F.coalesce(x, F.lit("")) for x in (name1, name2, addr1, addr2)])


@F.pandas_udf(DoubleType())
def _jw(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in parts:
        yield pd.Series([jaro_winkler(x, y) if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def jaro_winkler_column(a: Column, b: Column) -> Column:
    _here()
    return _jw(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))
