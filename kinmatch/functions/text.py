"""Normalisation of names and addresses and the tokens drawn from them, as column expressions.

Empty text stands for a missing value throughout: nulls become empty at the edge. Latin letters with marks are folded by
``translate`` inside the JVM; only texts that still hold other scripts go to Python (``scripts.romanised``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinmatch.functions import constants as c
from kinmatch.functions.scripts import romanised

_MARKED = [(ch, base) for ch in map(chr, range(0xC0, 0x250)) if (base := unicodedata.normalize("NFKD", ch)[0]) != ch and base.isascii()]
FOLD_FROM, FOLD_TO = "".join(a for a, _ in _MARKED), "".join(b for _, b in _MARKED)
#: Letters that fold to two.
FOLD_PAIRS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D"}


def text_or_empty(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def folded(x: Column) -> Column:
    """Latin letters without marks, ligatures as two letters."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), FOLD_PAIRS.items(), F.translate(x, FOLD_FROM, FOLD_TO))


def squeezed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def in_ascii(x: Column) -> Column:
    """A text of any script in ASCII, null as empty. What the normal forms below start from."""
    return romanised(folded(text_or_empty(x)))


def plain_text(x: Column, any_script: bool = True) -> Column:
    """Lower-case ASCII words without punctuation; values that mean nothing are empty. Without ``any_script``, for texts
    that went through in_ascii() already, other scripts are left out."""
    raw = text_or_empty(x)
    ascii_text = folded(raw)
    if any_script:
        ascii_text = romanised(ascii_text)
    out = F.lower(ascii_text)
    out = F.replace(F.replace(out, F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" and "))
    out = squeezed(F.regexp_replace(out, r"[^\w\s]", " "))
    return F.when(F.lower(F.trim(raw)).isin(*c.NOISE_VALUES), "").otherwise(out)


def norm_name(x: Column, any_script: bool = True) -> Column:
    """A business name with its legal form in one spelling."""
    return squeezed(reduce(lambda acc, p: F.regexp_replace(acc, p[0], p[1]), c.LEGAL_FORMS, plain_text(x, any_script)))


def norm_addr(x: Column, any_script: bool = True) -> Column:
    """An address with right ordinals and street words written out."""
    out = plain_text(x, any_script)
    out = F.regexp_replace(out, r"\b(\d*1[123])th\b", "$1TH")
    for digit, end in (("1", "st"), ("2", "nd"), ("3", "rd")):
        out = F.regexp_replace(out, rf"\b(\d*{digit})th\b", f"$1{end}")
    out = F.regexp_replace(out, r"(\d)TH\b", "$1th")
    return squeezed(reduce(lambda acc, p: F.regexp_replace(acc, rf"\b{p[0]}\b", p[1]), c.STREET_WORDS.items(), out))


def light_text(x: Column, plus: bool = True, any_script: bool = True) -> Column:
    """What the rule matchers compare: no legal forms, no street words, and "+" only counts in names."""
    raw = folded(text_or_empty(x))
    out = F.lower(romanised(raw) if any_script else raw)
    out = F.replace(out, F.lit("&"), F.lit(" and "))
    if plus:
        out = F.replace(out, F.lit("+"), F.lit(" and "))
    return squeezed(F.regexp_replace(out, r"[^\w\s]", " "))


def ordinal_suffix(n: Column) -> Column:
    return F.when((n % 100).between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")


def tokens(x: Column) -> Column:
    """White-space tokens in order, with repeats."""
    return F.filter(F.split(x, r"\s+"), lambda t: t != "")


def name_tokens(norm: Column) -> Column:
    return F.array_distinct(tokens(norm))


def numbers(raw: Column) -> Column:
    """Digit runs of a raw address that stand alone, with repeats and in order; any script's digits count."""
    return F.regexp_extract_all(text_or_empty(raw), F.lit(r"(?U)\b\d+\b"), 0)


def long_numbers(x: Column) -> Column:
    """Distinct numbers of two digits or more."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit(r"\b\d{2,}\b"), 0))


def _stripped(x: Column, keep) -> Column:
    found = F.regexp_extract_all(F.lower(text_or_empty(x)), F.lit(r"\b\d+\b"), 0)
    cut = F.transform(F.filter(found, keep), lambda n: F.regexp_replace(n, "^0+", ""))
    return F.array_distinct(F.filter(cut, lambda n: n != ""))


def house_numbers(raw: Column) -> Column:
    """Distinct numbers written with 2 to 6 digits, without leading zeros."""
    return _stripped(raw, lambda n: F.length(n).between(2, 6))


def any_numbers(raw: Column) -> Column:
    """Distinct numbers of any length, without leading zeros."""
    return _stripped(raw, lambda n: F.length(n) > 0)


def clean_words(raw: Column) -> Column:
    """Distinct ASCII words of three characters or more that are no stop words."""
    found = F.regexp_extract_all(F.lower(text_or_empty(raw)), F.lit("[a-z0-9]{3,}"), 0)
    return F.array_except(F.array_distinct(found), F.array(*map(F.lit, c.NAME_STOP)))


def words(x: Column, least: int, stop: Iterable[str]) -> Column:
    """Distinct tokens of ``least`` characters or more that are no stop words."""
    return F.array_distinct(F.filter(tokens(x), lambda t: (F.length(t) >= least) & ~t.isin(*stop)))


def soundex(word: Column) -> Column:
    """Sound key: the first letter and the codes of the others, runs of one code once; vowels, h and w part runs.
    Empty for what isn't letters only. (The built-in function joins codes over h and w and takes any word.)"""
    up = F.upper(word)
    codes = F.translate(up, "BFPVCGJKQSXZDTLMNRAEIOUYHW", "11112222222233455600000000")
    for digit in "0123456":
        codes = F.regexp_replace(codes, f"{digit}+", digit)
    tail = F.replace(F.substr(codes, F.lit(2)), F.lit("0"), F.lit(""))
    return F.when(word.rlike("^[a-zA-Z]+$"), F.rpad(F.concat(F.left(up, F.lit(1)), tail), 4, "0")).otherwise("")


def pin_code(nums: Column) -> Column:
    """The first number that looks like a postal code: six digits without a leading zero, or five."""
    fits = F.filter(nums, lambda n: ((F.length(n) == 6) & (F.left(n, F.lit(1)) != "0")) | (F.length(n) == 5))
    return F.get(fits, F.lit(0))


def indian_pin(norm: Column) -> Column:
    return F.regexp_extract(norm, r"\b([1-9][0-9]{5})\b", 1)


def prefix(x: Column, n: int) -> Column:
    """The first n characters, null for shorter texts."""
    return F.when(F.length(x) >= n, F.left(x, F.lit(n)))


def char_grams(x: Column, n: int = 3, once: bool = True) -> Column:
    """n-grams of a text without spaces, each ``once`` or as often as they are there."""
    s = F.replace(x, F.lit(" "), F.lit(""))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(n)))
    return F.when(F.length(s) >= n, F.array_distinct(grams) if once else grams).otherwise(F.array().cast("array<string>"))


def initials(x: Column) -> Column:
    """First letters of the tokens of two characters or more."""
    return F.array_join(F.transform(F.filter(tokens(x), lambda t: F.length(t) >= 2), lambda t: F.left(t, F.lit(1))), "")


def scrub_tokens(raw: Column) -> Column:
    """What the precision scrub compares: ASCII tokens of two characters or more that are no stop words, in order."""
    clean = F.regexp_replace(F.lower(text_or_empty(raw)), r"[^a-z0-9\s]", " ")
    return F.filter(tokens(clean), lambda t: (F.length(t) >= 2) & ~t.isin(*c.SCRUB_STOP))


def first_token(toks: Column) -> Column:
    return F.coalesce(F.get(toks, F.lit(0)), F.lit(""))
