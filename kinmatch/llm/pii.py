"""Format-preserving Feistel pseudonyms for validated numbers, dates and addresses in texts.

One expression finds candidates; each is validated (Luhn digit, octet range, calendar, number blocks, digit count) and,
if valid, permuted within its format by a keyed Feistel network, so equal values get equal pseudonyms in every document
and different ones never meet. What doesn't validate stays as it is. Separators, letter case and length of the parts
stay; a valid value stays valid.

Two networks, ``ROUNDS`` rounds each, with SHA-256 of key, kind, round and the other half as round function:
  * characters: halves of a string; each character moves within its class (10 digits, 26 letters, 16 hex digits).
    Separators are left out first, so one number written in two ways gets the same digits. Cards: the digits before
    the check digit, which is computed anew. Account numbers (IBAN): what follows the check digits, which are computed
    anew. Telephone numbers: the digits after the first. Mail addresses: everything before the top-level domain, without
    regard to case. Access keys: what follows the mark of their kind. IPv6 addresses: the hex digits of each way of writing.
  * numbers: Z_a x Z_b, for dates (days within a block of 200 years), IPv4 addresses and social security numbers
    (valid areas x groups and serials).

A date with slashes is read month first, and day first where that is no date. All of it is DataFrame expressions; only
texts with candidates are taken apart.

There is no default key: without one the operator refuses. In plans stands a hash of the key with a mark in front, which
the session is told to redact (spark.sql.redaction.string.regex) wherever Spark shows a plan.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10
KEY_SETTING, REDACTION = "spark.kinmatch.pii.key", "spark.sql.redaction.string.regex"
#: What the registered queries and the pipeline take where the session has no key, so that their results can be compared;
#: it is published and protects nobody. The operator never takes it by itself.
PUBLISHED_KEY = "kinmatch: the registered queries' published key"
KEY_MARK = "pii-key:"
#: Kinds and their candidates, in order of preference. No look-around, so that Java's and RE2's engines
#: agree; every repetition is bounded, so that a very long run of characters costs no more than its length.
CANDIDATES = {
    "email": r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "date": r"\b\d{4}-\d\d-\d\d\b|\b\d{4}/\d\d/\d\d\b|\b\d\d\.\d\d\.\d{4}\b|\b\d\d/\d\d/\d{4}\b",
    "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}\b|\([2-9]\d\d\) ?\d{3}[ .-]\d{4}\b|\b[2-9]\d\d-\d{3}-\d{4}\b|\b[2-9]\d\d\.\d{3}\.\d{4}\b|\b[2-9]\d\d \d{3}-\d{4}\b",
    "ssn": r"\b\d{3}-\d\d-\d{4}\b",
    "iban": r"\b[A-Z]{2}\d\d[0-9A-Z]{11,30}\b|\b[A-Z]{2}\d\d(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?\b",
    "card": r"\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}\b|\b\d{4}[ -]\d{6}[ -]\d{5}\b|\b\d{13,19}\b",
    "token": r"\bA[KS]IA[0-9A-Z]{16}\b|\bgh[opsu]_[0-9A-Za-z]{36}\b|\bsk-[0-9A-Za-z]{20,64}\b|\bAIza[0-9A-Za-z_-]{35}|\bxox[abp]-[0-9A-Za-z-]{10,72}",
    "ipv6": r"\b[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}\b|\b(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}\b",
    "hex": r"\b[0-9a-f]{32,64}\b|\b[0-9A-F]{32,64}\b",
}
TOKEN_MARK = r"^(?:A[KS]IA|gh[opsu]_|sk-|AIza|xox[abp]-)"
PATTERN = "|".join(CANDIDATES.values())
#: Days in a block of 200 years from 1900-01-01 are 17 x 4297; valid social security areas, groups x serials.
DAYS, IP, SSN = (17, 4297), (65536, 65536), (898, 99 * 9999)
HEX = "0123456789abcdef"


def guarded(key: str) -> str:
    """What stands for the key in plans."""
    return KEY_MARK + hashlib.sha256(key.encode()).hexdigest()


def key_of(spark: SparkSession, key: str | None = None) -> str:
    """The given key or the session's, guarded, with the session told to redact it in what it shows of plans."""
    key = key if key is not None else spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"no key: give one, or set {KEY_SETTING}")
    own, known = KEY_MARK + "[0-9a-f]{64}", spark.conf.get(REDACTION, None)
    if not known or own not in known:
        spark.conf.set(REDACTION, f"{known}|{own}" if known else own)
    return guarded(key)


def published_or_own(spark: SparkSession) -> str:
    """The session's key, else the published one: for the registered queries and the pipeline."""
    return spark.conf.get(KEY_SETTING, None) or PUBLISHED_KEY


def _round_hash(key: str, kind: Column, k: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, k.cast("string"), other.cast("string")), 256)


def _moved(c: Column, by: Column, kind: Column) -> Column:
    """The character ``by`` places on in its class."""
    code = F.ascii(c)

    def place(first: int, n: int) -> Column:
        return F.char(F.lit(first) + F.pmod(code - first + by, F.lit(n)))

    hexed = F.substr(F.lit(HEX), F.pmod(F.position(c, F.lit(HEX)) - 1 + by, F.lit(16)) + 1, F.lit(1))
    return F.when(kind.isin("hex", "ipv6"), hexed).when(code < 58, place(48, 10)).when(code < 91, place(65, 26)).otherwise(place(97, 26))


def permuted_text(core: Column, kind: Column, key: str) -> Column:
    """A string of letters and digits, permuted among the strings of the same classes."""
    half = F.floor(F.length(core) / 2).cast("int")
    start = F.struct(F.substr(core, F.lit(1), half).alias("l"), F.substr(core, half + 1, F.length(core)).alias("r"))

    def step(acc: Column, k: Column) -> Column:
        l, r = acc["l"], acc["r"]
        with_hash = F.array(F.struct(l.alias("l"), _round_hash(key, kind, k, r).alias("h")))  # one evaluation of the hash
        new = F.transform(with_hash, lambda x: F.array_join(F.transform(F.filter(F.split(x["l"], ""), lambda c: c != ""), lambda c, i: _moved(c, F.conv(F.substr(x["h"], 2 * F.pmod(i, F.lit(32)) + 1, F.lit(2)), 16, 10).cast("int"), kind)), ""))
        return F.struct(r.alias("l"), new[0].alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def permuted_number(x: Column, size: tuple[int, int], kind: Column, key: str) -> Column:
    """A number of 0 .. a * b - 1, permuted."""
    a, b = size
    start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def step(acc: Column, k: Column) -> Column:
        by = F.conv(F.substr(_round_hash(key, kind, k, acc["r"]), F.lit(1), F.lit(12)), 16, 10).cast("long")
        size_l = F.when(k % 2 == 1, F.lit(a)).otherwise(F.lit(b)).cast("long")
        return F.struct(acc["r"].alias("l"), F.pmod(acc["l"] + by, size_l).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: acc["l"] * b + acc["r"])


def luhn_sum(digits: Column, last: int) -> Column:
    """Sum of a number's digits, every second one doubled; ``last``: 1 if the last digit stands alone, 2 if it is doubled."""
    places = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    each = F.transform(places, lambda c, i: c.cast("int") * F.when(F.pmod(i + last, F.lit(2)) == 1, 1).otherwise(2))
    return F.aggregate(each, F.lit(0), lambda acc, v: acc + v - F.when(v > 9, 9).otherwise(0))


def _core(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9A-Za-z]", "")


def _refilled(v: Column, core: Column, case: bool = False) -> Column:
    """v with its letters and digits taken from core; with ``case``, capitals where v has them."""
    one = F.array(F.struct(v.alias("v"), core.alias("core")))

    def place(x: Column, c: Column, i: Column) -> Column:
        new = F.substr(x["core"], F.length(_core(F.substr(x["v"], F.lit(1), i + 1))), F.lit(1))
        return F.when(c.rlike("[0-9A-Za-z]"), F.when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new) if case else new).otherwise(c)

    fill = lambda x: F.array_join(F.transform(F.filter(F.split(x["v"], ""), lambda c: c != ""), lambda c, i: place(x, c, i)), "")
    return F.transform(one, fill)[0]


def _int(m: Column, at: int, n: int) -> Column:
    return F.substr(m, F.lit(at), F.lit(n)).cast("int")


def _is_date(year: Column, month: Column, day: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return year.between(1, 9500) & month.between(1, 12) & day.between(1, days)


def _date(m: Column, key: str) -> Column:
    """Four layouts: year first with a dash or slash, day first with dots, month or day first with slashes."""
    first, dotted = F.substr(m, F.lit(5), F.lit(1)).isin("-", "/"), F.substr(m, F.lit(3), F.lit(1)) == "."
    year = F.when(first, _int(m, 1, 4)).otherwise(_int(m, 7, 4))
    one, two = _int(m, 1, 2), _int(m, 4, 2)
    day_first = ~first & (dotted | ~_is_date(year, one, two))
    month = F.when(first, _int(m, 6, 2)).when(day_first, two).otherwise(one)
    day = F.when(first, _int(m, 9, 2)).when(day_first, one).otherwise(two)
    valid = _is_date(year, month, day)
    n = F.datediff(F.make_date(year, month, day), F.lit("1900-01-01").cast("date")).cast("long")
    size = DAYS[0] * DAYS[1]
    moved = permuted_number(F.pmod(n, F.lit(size)), DAYS, F.lit("date"), key) + F.floor(n / size) * size
    new = F.transform(F.array(F.date_add(F.lit("1900-01-01").cast("date"), moved.cast("int"))), lambda d: F.struct(F.lpad(F.year(d).cast("string"), 4, "0").alias("y"), F.lpad(F.month(d).cast("string"), 2, "0").alias("m"), F.lpad(F.day(d).cast("string"), 2, "0").alias("d")))
    iso, mark = F.substr(m, F.lit(5), F.lit(1)), F.substr(m, F.lit(3), F.lit(1))
    laid = F.transform(new, lambda d: F.when(first, F.concat(d["y"], iso, d["m"], iso, d["d"])).when(day_first, F.concat(d["d"], mark, d["m"], mark, d["y"])).otherwise(F.concat(d["m"], mark, d["d"], mark, d["y"])))
    return F.when(valid, laid[0])


def _ip(m: Column, key: str) -> Column:
    p = F.split(m, r"\.")
    octets = [p[i].cast("long") for i in range(4)]
    valid = F.lit(True)
    for i, o in enumerate(octets):
        valid = valid & (o <= 255) & (o.cast("string") == p[i])
    n = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    new = F.transform(F.array(permuted_number(n, IP, F.lit("ip"), key)), lambda x: F.concat_ws(".", *[F.pmod(F.floor(x / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]))
    return F.when(valid, new[0])


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = _int(m, 1, 3), _int(m, 5, 2), _int(m, 8, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    n = (area - F.when(area > 666, 2).otherwise(1)).cast("long") * SSN[1] + (group - 1) * 9999 + serial - 1
    new = F.transform(
        F.array(permuted_number(n, SSN, F.lit("ssn"), key)),
        lambda x: F.transform(F.array(F.floor(x / SSN[1])), lambda a: F.concat_ws("-", F.lpad((a + F.when(a >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((F.floor(F.pmod(x, F.lit(SSN[1])) / 9999) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(F.pmod(x, F.lit(SSN[1])), F.lit(9999)) + 1).cast("string"), 4, "0")))[0],
    )
    return F.when(valid, new[0])


def _card(m: Column, key: str) -> Column:
    digits = _core(m)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = F.transform(F.array(permuted_text(body, F.lit("card"), key)), lambda b: F.concat(b, F.pmod(-luhn_sum(b, 2), F.lit(10)).cast("string")))
    return F.when((luhn_sum(digits, 1) % 10 == 0) & (digits.rlike("[1-9]")), _refilled(m, new[0]))


def _phone(m: Column, key: str) -> Column:
    digits = _core(m)
    new = F.concat(F.substr(digits, F.lit(1), F.lit(1)), permuted_text(F.substr(digits, F.lit(2), F.length(digits)), F.lit("phone"), key))
    return F.when(F.length(digits).between(8, 15), _refilled(m, new))


def _email(m: Column, key: str) -> Column:
    body, tail = F.regexp_extract(m, r"^(.*)\.([A-Za-z]+)$", 1), F.regexp_extract(m, r"^(.*)(\.[A-Za-z]+)$", 2)
    return F.concat(_refilled(body, permuted_text(F.lower(_core(body)), F.lit("email"), key), True), tail)


def _mod97(s: Column) -> Column:
    """Of the number that digits and capitals (as 10 to 35) make."""
    step = lambda acc, c: F.when(F.ascii(c) < 58, acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    core = _core(m)
    country, rest = F.substr(core, F.lit(1), F.lit(2)), F.substr(core, F.lit(5), F.length(core))
    new = F.transform(F.array(permuted_text(rest, F.lit("iban"), key)), lambda r: F.concat(country, F.lpad((98 - _mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))
    return F.when(F.length(core).between(15, 34) & (_mod97(F.concat(rest, F.substr(core, F.lit(1), F.lit(4)))) == 1), _refilled(m, new[0]))


def _token(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, TOKEN_MARK, 0)
    rest = F.substr(m, F.length(head) + 1, F.length(m))
    return F.when(rest.rlike("[0-9]") & rest.rlike("[A-Za-z]"), F.concat(head, _refilled(rest, permuted_text(_core(rest), F.lit("token"), key))))


def _ipv6(m: Column, key: str) -> Column:
    groups = F.size(F.filter(F.split(m, ":"), lambda x: x != ""))
    return F.when(m.rlike("[0-9]") & F.when(F.contains(m, F.lit("::")), groups <= 7).otherwise(groups == 8), _refilled(m, permuted_text(F.lower(_core(m)), F.lit("ipv6"), key), True))


def _hex(m: Column, key: str) -> Column:
    """Hexadecimal secrets; the permutation ignores case, the layout keeps it."""
    new = F.transform(F.array(permuted_text(F.lower(m), F.lit("hex"), key)), lambda x: F.when(m == F.lower(m), x).otherwise(F.upper(x)))
    return F.when(m.rlike("[0-9]") & m.rlike("[A-Fa-f]"), new[0])


def kind_of(m: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, p in reversed(CANDIDATES.items()):
        out = F.when(m.rlike("|".join(f"^(?:{x})$" for x in p.split("|"))), kind).otherwise(out)
    return out


def pseudonym(m: Column, key: str) -> Column:
    """(kind, value) for a candidate; null value where it isn't valid."""
    by = {"email": _email, "date": _date, "ip": _ip, "phone": _phone, "ssn": _ssn, "iban": _iban, "card": _card, "token": _token, "ipv6": _ipv6, "hex": _hex}
    value = F.lit(None).cast("string")
    kind = kind_of(m)
    one = F.array(F.struct(m.alias("m"), kind.alias("kind")))

    def of(x: Column) -> Column:
        out = value
        for k, f in by.items():
            out = F.when(x["kind"] == k, f(x["m"], key)).otherwise(out)
        return F.struct(x["kind"].alias("kind"), x["m"].alias("found"), out.alias("value"))

    return F.transform(one, of)[0]


def pseudonyms(text: Column, key: str) -> Column:
    """array<struct<kind, found, value>> of the candidates of a text, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), 0), lambda m: pseudonym(m, key))


def rewritten(text: Column, found: Column) -> Column:
    """The text with each candidate's pseudonym in its place."""
    gaps = F.split(text, PATTERN, -1)
    parts = F.zip_with(gaps, found, lambda g, x: F.concat(g, F.coalesce(x["value"], x["found"], F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(text)


def pseudonymised(docs: DataFrame, text_col: str = "text", key: str | None = None, found_col: str | None = None) -> DataFrame:
    """docs with the texts' valid values replaced; all other columns stay. ``found_col``: a further column with the
    candidates, as pseudonyms() gives them.

    Null texts stay null, empty ones empty. Repeated rows and values are replaced alike. A column of docs that is named as
    ``found_col`` gives way to it. ``key``: the setting spark.kinmatch.pii.key of the session if not given; an error where
    neither is there."""
    key = key_of(docs.sparkSession, key)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    out = docs.select(row, pseudonyms(F.col(f"`{text_col}`"), key).alias("__found"))
    new = rewritten(F.col("__row").getField(text_col), F.col("__found"))
    cols = [(new if c == text_col else F.col("__row").getField(c)).alias(c) for c in docs.columns if c != found_col]
    return out.select(*cols, *([F.col("__found").alias(found_col)] if found_col else []))


def sql(key: str = PUBLISHED_KEY) -> str:
    """DuckDB SQL for (doc_id, n_values, text) of pseudonymised() over the table documents."""
    key = guarded(key)
    quoted = PATTERN.replace("'", "''")
    kinds = " ".join(f"WHEN regexp_full_match(m, '{p}') THEN '{k}'" for k, p in CANDIDATES.items())
    h = f"sha256(concat_ws('|', '{key}', kind, k + 1, r))"

    def luhn(digits: str, last: int) -> str:
        return f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN (i - 1 + {last}) % 2 = 1 THEN CAST(substr(reverse({digits}), i, 1) AS INT) ELSE CAST(substr(reverse({digits}), i, 1) AS INT) * 2 - CASE WHEN CAST(substr(reverse({digits}), i, 1) AS INT) > 4 THEN 9 ELSE 0 END END))"

    def mod97(x: str) -> str:
        return f"list_reduce(string_split({x}, ''), lambda acc, c: CASE WHEN ascii(c) < 58 THEN acc * 10 + ascii(c) - 48 ELSE acc * 100 + ascii(c) - 55 END % 97, 0)"

    month_first = "TRY_CAST(m[7:10] || '-' || m[1:2] || '-' || m[4:5] AS DATE) IS NOT NULL"
    days, serials = DAYS[0] * DAYS[1], SSN[1]
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
f AS (SELECT rid, unnest(regexp_extract_all(text, '{quoted}')) AS m, generate_subscripts(regexp_extract_all(text, '{quoted}'), 1) AS i FROM d),
v AS (SELECT m, CASE {kinds} END AS kind, regexp_replace(m, '[^0-9A-Za-z]', '', 'g') AS core FROM (SELECT DISTINCT m FROM f)),
dp AS (SELECT m, CASE WHEN m[5] IN ('-', '/') THEN m[1:4] || '-' || m[6:7] || '-' || m[9:10] WHEN m[3] = '/' AND {month_first} THEN m[7:10] || '-' || m[1:2] || '-' || m[4:5] ELSE m[7:10] || '-' || m[4:5] || '-' || m[1:2] END AS iso FROM v WHERE kind = 'date'),
num AS (
  SELECT m, 'date' AS kind, datediff('day', DATE '1900-01-01', TRY_CAST(iso AS DATE)) AS x, CAST({DAYS[0]} AS BIGINT) AS a, CAST({DAYS[1]} AS BIGINT) AS b FROM dp WHERE TRY_CAST(iso AS DATE) IS NOT NULL AND iso[1:4] BETWEEN '0001' AND '9500'
  UNION ALL SELECT m, 'ip', list_reduce(list_transform(string_split(m, '.'), lambda o: CAST(o AS BIGINT)), lambda p, q: p * 256 + q), {IP[0]}, {IP[1]} FROM v WHERE kind = 'ip' AND len(list_filter(string_split(m, '.'), lambda o: CAST(o AS INT) > 255 OR CAST(CAST(o AS INT) AS VARCHAR) <> o)) = 0
  UNION ALL SELECT m, 'ssn', (CAST(m[1:3] AS BIGINT) - CASE WHEN m[1:3] > '666' THEN 2 ELSE 1 END) * {serials} + (CAST(m[5:6] AS BIGINT) - 1) * 9999 + CAST(m[8:11] AS BIGINT) - 1, {SSN[0]}, {SSN[1]} FROM v WHERE kind = 'ssn' AND m[1:3] BETWEEN '001' AND '899' AND m[1:3] <> '666' AND m[5:6] <> '00' AND m[8:11] <> '0000'),
nr AS (SELECT m, kind, x, a, b, 0 AS k, CAST((((x % (a * b)) + a * b) % (a * b)) // b AS BIGINT) AS l, CAST((((x % (a * b)) + a * b) % (a * b)) % b AS BIGINT) AS r FROM num
  UNION ALL SELECT m, kind, x, a, b, k + 1, r, (l + CAST('0x' || {h}[1:12] AS BIGINT)) % CASE WHEN k % 2 = 0 THEN a ELSE b END FROM nr WHERE k < {ROUNDS}),
ns AS (SELECT m, kind, CASE kind WHEN 'date' THEN l * b + r + CAST(floor(x / {days}) AS BIGINT) * {days} ELSE l * b + r END AS y FROM nr WHERE k = {ROUNDS}),
no AS (SELECT m, kind, CASE kind
  WHEN 'ip' THEN concat_ws('.', y // 16777216, y // 65536 % 256, y // 256 % 256, y % 256)
  WHEN 'ssn' THEN concat_ws('-', lpad(CAST(y // {serials} + CASE WHEN y // {serials} >= 665 THEN 2 ELSE 1 END AS VARCHAR), 3, '0'), lpad(CAST(y % {serials} // 9999 + 1 AS VARCHAR), 2, '0'), lpad(CAST(y % {serials} % 9999 + 1 AS VARCHAR), 4, '0'))
  WHEN 'date' THEN CASE WHEN m[5] = '-' THEN strftime(DATE '1900-01-01' + CAST(y AS INT), '%Y-%m-%d') WHEN m[5] = '/' THEN strftime(DATE '1900-01-01' + CAST(y AS INT), '%Y/%m/%d')
    WHEN m[3] = '.' THEN strftime(DATE '1900-01-01' + CAST(y AS INT), '%d.%m.%Y') WHEN NOT {month_first} THEN strftime(DATE '1900-01-01' + CAST(y AS INT), '%d/%m/%Y') ELSE strftime(DATE '1900-01-01' + CAST(y AS INT), '%m/%d/%Y') END END AS value FROM ns),
body AS (SELECT m, kind, CASE kind WHEN 'card' THEN core[1:length(core) - 1] WHEN 'phone' THEN core[2:length(core)] WHEN 'email' THEN lower(regexp_replace(regexp_extract(m, '^(.*)\.([A-Za-z]+)$', 1), '[^0-9A-Za-z]', '', 'g')) WHEN 'iban' THEN core[5:length(core)] WHEN 'token' THEN regexp_replace(regexp_replace(m, '{TOKEN_MARK}', ''), '[^0-9A-Za-z]', '', 'g') ELSE lower(core) END AS core FROM v
  WHERE kind = 'email' OR kind = 'iban' AND length(core) BETWEEN 15 AND 34 AND {mod97("(core[5:length(core)] || core[1:4])")} = 1 OR kind = 'token' AND regexp_matches(regexp_replace(m, '{TOKEN_MARK}', ''), '[0-9]') AND regexp_matches(regexp_replace(m, '{TOKEN_MARK}', ''), '[A-Za-z]')
    OR kind = 'ipv6' AND regexp_matches(m, '[0-9]') AND CASE WHEN contains(m, '::') THEN len(list_filter(string_split(m, ':'), lambda x: x <> '')) <= 7 ELSE len(string_split(m, ':')) = 8 END OR kind = 'phone' AND length(core) BETWEEN 8 AND 15 OR kind = 'hex' AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Fa-f]') OR kind = 'card' AND regexp_matches(core, '[1-9]') AND {luhn("core", 1)} % 10 = 0),
tr AS (SELECT m, kind, 0 AS k, substr(core, 1, length(core) // 2) AS l, substr(core, length(core) // 2 + 1) AS r FROM body
  UNION ALL SELECT m, kind, k + 1, r, array_to_string(list_transform(range(1, length(l) + 1), lambda i: CASE
    WHEN kind IN ('hex', 'ipv6') THEN substr('{HEX}', CAST((instr('{HEX}', substr(l, i, 1)) - 1 + CAST('0x' || substr({h}, 2 * ((i - 1) % 32) + 1, 2) AS INT)) % 16 + 1 AS INT), 1)
    WHEN ascii(substr(l, i, 1)) < 58 THEN chr((ascii(substr(l, i, 1)) - 48 + CAST('0x' || substr({h}, 2 * ((i - 1) % 32) + 1, 2) AS INT)) % 10 + 48)
    WHEN ascii(substr(l, i, 1)) < 91 THEN chr((ascii(substr(l, i, 1)) - 65 + CAST('0x' || substr({h}, 2 * ((i - 1) % 32) + 1, 2) AS INT)) % 26 + 65)
    ELSE chr((ascii(substr(l, i, 1)) - 97 + CAST('0x' || substr({h}, 2 * ((i - 1) % 32) + 1, 2) AS INT)) % 26 + 97) END), '') FROM tr WHERE k < {ROUNDS}),
tc AS (SELECT m, kind, CASE kind WHEN 'iban' THEN m[1:2] || lpad(CAST(98 - {mod97("(l || r || m[1:2] || '00')")} AS VARCHAR), 2, '0') || l || r WHEN 'card' THEN l || r || CAST((10 - {luhn("(l || r)", 2)} % 10) % 10 AS VARCHAR) WHEN 'phone' THEN regexp_extract(m, '[0-9]') || l || r ELSE l || r END AS core FROM tr WHERE k = {ROUNDS}),
tm AS (SELECT *, CASE kind WHEN 'token' THEN regexp_extract(m, '{TOKEN_MARK}') ELSE '' END AS head, CASE kind WHEN 'email' THEN regexp_extract(m, '^(.*)\.([A-Za-z]+)$', 1) WHEN 'token' THEN regexp_replace(m, '{TOKEN_MARK}', '') ELSE m END AS mid,
  CASE kind WHEN 'email' THEN '.' || regexp_extract(m, '^(.*)\.([A-Za-z]+)$', 2) ELSE '' END AS tail FROM tc),
t AS (SELECT m, kind, CASE WHEN kind = 'hex' THEN CASE WHEN m = lower(m) THEN core ELSE upper(core) END
  ELSE head || array_to_string(list_transform(range(1, length(mid) + 1), lambda i: CASE WHEN regexp_matches(substr(mid, i, 1), '[0-9A-Za-z]') THEN CASE WHEN kind IN ('email', 'ipv6') AND regexp_matches(substr(mid, i, 1), '[A-Z]') THEN upper(substr(core, length(regexp_replace(substr(mid, 1, i), '[^0-9A-Za-z]', '', 'g')), 1)) ELSE substr(core, length(regexp_replace(substr(mid, 1, i), '[^0-9A-Za-z]', '', 'g')), 1) END ELSE substr(mid, i, 1) END), '') || tail END AS value FROM tm),
p AS (SELECT m, value FROM no UNION ALL SELECT m, value FROM t),
g AS (SELECT rid, unnest(string_split_regex(text, '{quoted}')) AS g, generate_subscripts(string_split_regex(text, '{quoted}'), 1) AS i FROM d WHERE text IN (SELECT text FROM d SEMI JOIN f USING (rid))),
j AS (SELECT rid, string_agg(g || coalesce(p.value, f.m, ''), '' ORDER BY i) AS text, count(p.value) AS n FROM g LEFT JOIN f USING (rid, i) LEFT JOIN p USING (m) GROUP BY rid)
SELECT doc_id, CAST(coalesce(j.n, 0) AS BIGINT) AS n_values, coalesce(j.text, d.text) AS text FROM d LEFT JOIN j USING (rid)"""
