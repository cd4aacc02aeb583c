"""Other scripts in ASCII.

The scripts of India are read by rule: a consonant has an "a" unless a vowel sign or virama follows or its word ends.
All other letters (Cyrillic, Greek, Arabic, Hebrew, Chinese, kana, Thai ...) have one reading each, in a table that ICU, a
library that comes with Spark, makes on the driver; without it, the last word of a letter's Unicode name stands in.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from kinmatch.sources.shared import ship

#: Blocks whose letters are read one by one: all but Latin, the scripts of India, Hangul syllables (their names are their
#: readings), surrogates and private ones.
RANGES = ((0x370, 0x900), (0xE00, 0x1E00), (0x1F00, 0x2000), (0x3040, 0x3100), (0x4E00, 0xA000))
INDIC, KANA = range(0x900, 0xE00), range(0x3040, 0x3100)
#: Cyrillic letters by their usual English reading.
CYRILLIC = {"ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "й": "y", "ё": "yo", "є": "ye", "ї": "yi"}
#: Names of Indian letters that aren't read as they are written.
INDIC_NAMES = {"CA": "cha", "CHA": "chha", "SSA": "sha", "R": "ri", "ANUSVARA": "m", "CANDRABINDU": "n", "VISARGA": "h", "RRA": "ra", "LLLA": "la"}


def _indic(ch: str) -> tuple[str, str]:
    """(kind, reading) of a sign: consonant with its "a", vowel, sign (a vowel sign), virama, mark or other."""
    name = unicodedata.name(ch, "")
    last = name.rsplit(" ", 1)[-1]
    if "VIRAMA" in name or last in ("HALANT", "AL-LAKUNA"):
        return "virama", ""
    if last in ("ANUSVARA", "CANDRABINDU", "VISARGA"):
        return "mark", INDIC_NAMES[last]
    if "NUKTA" in name:
        return "none", ""
    read = INDIC_NAMES.get(last, last.lower())
    for twice in ("aa", "ii", "uu", "ee", "oo", "tt", "dd", "nn", "ll"):
        read = read.replace(twice, twice[0])
    if "VOWEL SIGN" in name:
        return "sign", read
    if "LETTER" in name and ch.isalpha():
        return ("consonant", read) if len(read) > 1 and read.endswith("a") else ("vowel", read)
    return "other", ""


def romanise(text: str, table: Mapping[str, str] | None = None) -> str:
    """Any script in ASCII; signs that are no letters, digits or marks become spaces."""
    table, out, n = table or {}, [], len(text)
    for k, ch in enumerate(text):
        if ch.isascii():
            out.append(ch)
        elif ord(ch) in INDIC and not ch.isdigit():
            kind, read = _indic(ch)
            if kind == "consonant":
                j = k + 1
                while j < n and ord(text[j]) in INDIC and _indic(text[j])[0] == "none":  # a dot below
                    j += 1
                after = _indic(text[j])[0] if j < n and ord(text[j]) in INDIC else "end"
                first = k == 0 or not text[k - 1].isalpha() and unicodedata.category(text[k - 1]) not in ("Mn", "Mc")
                out.append(read[:-1] if after in ("sign", "virama", "other") or after == "end" and not first else read)
            else:
                out.append(" " if kind == "other" else read)
        elif ord(ch) in KANA and " SMALL " in (name := unicodedata.name(ch, "")):
            read = name.rsplit(" ", 1)[-1].lower()
            if read != "tu" and out and out[-1][-1:] in tuple("aiueo"):  # it takes the vowel's place
                out[-1] = out[-1][:-1]
            out.append("" if read == "tu" else read)
        elif ch in table:
            out.append(table[ch])
        elif (low := ch.lower()) in CYRILLIC:
            out.append(CYRILLIC[low])
        elif ch.isdecimal():
            out.append(str(unicodedata.decimal(ch)))
        else:
            out.append(_other(ch))
    return "".join(out)


def _other(ch: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if c.isascii())
    if plain:
        return plain
    if unicodedata.category(ch) in ("Mn", "Me", "Cf"):
        return ""
    name = unicodedata.name(ch, "")
    if ch.isalpha() and ("LETTER" in name or "SYLLABLE" in name or "VOWEL" in name):
        return name.rsplit(" ", 1)[-1].lower()
    return " "


def readings(spark: SparkSession) -> dict[str, str]:
    """Letter -> ASCII for the letters of RANGES, by ICU; empty where the session's Java has no ICU."""
    try:
        icu = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII")
    except (TypeError, AttributeError):
        return {}
    letters = [ch for a, b in RANGES for ch in map(chr, range(a, b)) if ch.isalpha() and ch.lower() not in CYRILLIC]
    read = icu.transliterate("\n".join(letters)).split("\n")
    return {a: "".join(filter(str.isalnum, b.lower())) for a, b in zip(letters, read, strict=True) if b.isascii()}


_tables: dict[str, object] = {}


def _table(spark: SparkSession):
    """The readings for the executors, made once for each application: some 25,000 short entries, whatever the data."""
    app = spark.sparkContext.applicationId
    if app not in _tables:
        _tables.clear()
        _tables[app] = spark.sparkContext.broadcast(readings(spark))
    return _tables[app]


def romanised(x: Column) -> Column:
    """``romanise`` for the texts that need it; all others reach Python as null."""
    spark = SparkSession.active()
    ship(spark)
    held = _table(spark)

    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.functions.scripts import romanise as one

        table = held.value
        for s in parts:
            yield s.map(lambda t: t if t is None else one(t, table))

    return F.coalesce(of(F.when(x.rlike(r"[^\x00-\x7F]"), x)), x)
