"""DuckDB SQL that computes what the registered queries compute, built from the same settings but by other means: common
table expressions over lists, one row per key."""

from __future__ import annotations

from kinmatch.functions import constants as c
from kinmatch.functions.text import FOLD_FROM, FOLD_PAIRS, FOLD_TO
from kinmatch.operators.blocking import Spec, Weight
from kinmatch.plans.fixture import ENTITIES_SQL


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _regs(x: str, steps) -> str:
    for a, b in steps:
        x = f"regexp_replace({x}, '{a}', '{b}', 'g')"
    return x


def folded(x: str) -> str:
    x = f"translate({x}, '{FOLD_FROM}', '{FOLD_TO}')"
    for a, b in FOLD_PAIRS.items():
        x = f"replace({x}, '{a}', '{b}')"
    return x


def squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def light(x: str, plus: bool = True) -> str:
    out = f"replace(lower({folded(x)}), '&', ' and ')"
    if plus:
        out = f"replace({out}, '+', ' and ')"
    return squeezed(f"regexp_replace({out}, '[^\\w\\s]', ' ', 'g')")


def plain(x: str) -> str:
    return f"CASE WHEN lower(trim({x})) IN {_in(c.NOISE_VALUES)} THEN '' ELSE {light(x)} END"


def norm_name(x: str) -> str:
    return squeezed(_regs(f"({plain(x)})", c.LEGAL_FORMS))


def norm_addr(x: str) -> str:
    steps = [(r"\b(\d*1[123])th\b", r"\1TH"), *[(rf"\b(\d*{d})th\b", rf"\1{e}") for d, e in (("1", "st"), ("2", "nd"), ("3", "rd"))], (r"(\d)TH\b", r"\1th")]
    return squeezed(_regs(f"({plain(x)})", [*steps, *[(rf"\b{a}\b", b) for a, b in c.STREET_WORDS.items()]]))


def toks(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def soundex(w: str) -> str:
    codes = f"translate(upper({w}), 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '11112222222233455600000000')"
    codes = _regs(codes, [(f"{d}+", d) for d in "0123456"])
    return f"CASE WHEN regexp_full_match({w}, '[a-zA-Z]+') THEN left(rpad(upper(left({w}, 1)) || replace(substr({codes}, 2), '0', ''), 4, '0'), 4) ELSE '' END"


def least(arr: str, n: int, stop=()) -> str:
    return f"list_filter({arr}, lambda w: length(w) >= {n}" + (f" AND w NOT IN {_in(stop)})" if stop else ")")


def distinct(x: str) -> str:
    return f"list_distinct({x})"


def prefix(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN left({x}, {n}) END"


def grams(x: str, n: int = 3) -> str:
    s = f"replace({x}, ' ', '')"
    return f"list_distinct(list_transform(range(1, length({s}) - {n - 2}), lambda i: substr({s}, i, {n})))"


def stripped(x: str, cond: str) -> str:
    return f"list_distinct(list_filter(list_transform(list_filter(regexp_extract_all(lower({x}), '\\b\\d+\\b'), lambda n: {cond}), lambda n: regexp_replace(n, '^0+', '')), lambda n: n <> ''))"


HOUSE = stripped("business_address", "length(n) BETWEEN 2 AND 6")
ANY_NUMBER = stripped("business_address", "length(n) > 0")
CLEAN = f"list_filter(list_distinct(regexp_extract_all(lower(business_name), '[a-z0-9]{{3,}}')), lambda w: w NOT IN {_in(c.NAME_STOP)})"
LONG_NUMBERS = "list_distinct(regexp_extract_all(light_addr, '\\b\\d{2,}\\b'))"

RECORDS_SQL = f"""{ENTITIES_SQL},
rec0 AS (SELECT entity_id, country, business_name, business_address, {norm_name("business_name")} AS norm_name, {norm_addr("business_address")} AS norm_addr, {light("business_name")} AS light_name, {light("business_address", False)} AS light_addr FROM ents),
rec AS (SELECT *, CAST(regexp_extract(entity_id, '(\\d+)$', 1) AS BIGINT) AS ord, left(entity_id, 2) AS source, {distinct(toks("norm_name"))} AS name_tokens, {toks("norm_addr")} AS addr_tokens, regexp_extract_all(business_address, '\\b\\d+\\b') AS addr_numbers FROM rec0)"""

_NAME3 = least("name_tokens", 3, c.NAME_STOP)
KEYS_SQL = {
    "name_token3": least("name_tokens", 3),
    "name_word": _NAME3,
    "name_sound": f"list_transform(name_tokens, lambda q: {soundex('q')})",
    "name_word_sound": f"list_transform({_NAME3}, lambda q: {soundex('q')})",
    "number": "addr_numbers",
    "number2": least("addr_numbers", 2),
    "number2_once": distinct(least("addr_numbers", 2)),
    "addr_word3": least("addr_tokens", 3, c.ADDRESS_STOP),
    "addr_word4": least("addr_tokens", 4, c.ADDRESS_STOP),
    "addr_word5": least("addr_tokens", 5, c.ADDRESS_STOP_WIDE),
    "prefix3": f"[{prefix('norm_name', 3)}]",
    "prefix4": f"[{prefix('norm_name', 4)}]",
    "prefix5": f"[{prefix('norm_name', 5)}]",
    "prefix4or3": f"[coalesce({prefix('norm_name', 4)}, {prefix('norm_name', 3)})]",
    "gram3": grams("norm_name"),
    "gram3_all": grams("norm_name").removeprefix("list_distinct"),
    "addr_word4_name_stop": least("addr_tokens", 4, c.NAME_STOP),
    "pin": "[regexp_extract(norm_addr, '\\b([1-9][0-9]{5})\\b', 1)]",
    "v2_number": LONG_NUMBERS,
    "v2_name_word": distinct(least(toks("light_name"), 3, c.RULE_STOP_V2)),
    "v2_addr_word": distinct(least(toks("light_addr"), 4, c.RULE_STOP_V2)),
    "v3_name_word": distinct(least(toks("light_name"), 3, c.RULE_STOP_V3)),
    "v3_addr_word": distinct(least(toks("light_addr"), 5, c.RULE_STOP_V3)),
    "house_number": HOUSE,
    "clean_word": CLEAN,
}


def _rows(name: str, keys: str, where: str, *more: str) -> str:
    cols = ", ".join(("country", *more))
    return f"SELECT * FROM (SELECT {cols}, '{name}' AS name, unnest({KEYS_SQL[keys]}) AS key FROM rec WHERE {where}) WHERE key IS NOT NULL AND key <> ''"


def _postings(spec: Spec, by_df: bool) -> str:
    out = []
    for p in spec.postings:
        where = "source <> 'S1'" + (f" AND country IN {_in(p.countries)}" if p.countries else "")
        out += [_rows(p.name, k, where, "source", "entity_id", "ord") for k in (p.df_keys if by_df and p.df_keys else p.keys)]
    return " UNION ALL ".join(out)


def _weight(w: Weight, idf: str) -> str:
    base = str(float(w.high))
    if w.length is not None:
        base = f"(CASE WHEN length(key) {'=' if w.exact else '>='} {w.length} THEN {float(w.high)} ELSE {float(w.low)} END)"
    return f"{base} * {idf}" if w.idf else base


IDF = {"smooth": "ln((n - df + 0.5) / (df + 0.5) + 1.0)", "plain": "ln(n / (df + 1.0))", None: "1.0"}


def frequencies(spec: Spec) -> str:
    group = "country, source" if spec.per_source else "country"
    return f"""dk AS ({_postings(spec, True)}),
sz AS (SELECT {group}, count(*) AS n FROM rec WHERE source <> 'S1' GROUP BY {group}),
dfs AS (SELECT {group}, name, key, count(*) AS df FROM dk GROUP BY {group}, name, key)"""


def candidates(spec: Spec, anchors: str = "source = 'S1'", pool: str = "true", tag: str = "cand") -> str:
    """CTEs of which the last, ``tag``, has what blocking.candidates returns."""
    group = "country, source" if spec.per_source else "country"
    share = " ".join(f"WHEN '{p.name}' THEN {p.max_share}" for p in spec.postings if p.max_share is not None)
    caps = " ".join(f"WHEN '{p.name}' THEN {p.cap}" for p in spec.postings if p.cap is not None)
    probes = " UNION ALL ".join(f"SELECT * FROM (SELECT country, entity_id AS s1_id, ord AS s1_ord, {i} AS kind, '{p.postings}' AS name, unnest({KEYS_SQL[p.keys]}) AS key FROM rec WHERE {anchors}) WHERE key IS NOT NULL AND key <> ''" for i, p in enumerate(spec.probes))
    weights = " ".join(f"WHEN {i} THEN {_weight(p.weight, IDF[spec.idf])}" for i, p in enumerate(spec.probes))
    skips = "".join(f" AND NOT (kind = {i} AND df > {p.skip_over})" for i, p in enumerate(spec.probes) if p.skip_over is not None)
    having = [f"round(sum(w), 6) >= {spec.floor}"] * (spec.floor is not None) + [f"count(*) >= {spec.min_keys}"] * (spec.min_keys is not None)
    part = "s1_id, source" if spec.per_source else "s1_id"
    return f"""{frequencies(spec)},
po AS ({_postings(spec, False)}),
ix AS (SELECT po.*, coalesce(df, 0) AS df, n, row_number() OVER (PARTITION BY {", ".join("po." + g for g in group.split(", "))}, po.name, po.key ORDER BY ord, entity_id) AS place FROM po LEFT JOIN dfs USING ({group}, name, key) JOIN sz USING ({group})),
ik AS (SELECT * FROM ix WHERE {pool}{f" AND (CASE name {share} END IS NULL OR df < CASE name {share} END * n)" if share else ""}{f" AND (CASE name {caps} END IS NULL OR place <= CASE name {caps} END)" if caps else ""}),
pr AS ({probes}),
pa AS (SELECT s1_id, entity_id AS cand_id, pr.country, source, s1_ord, ord AS cand_ord, CAST(CASE kind {weights} END AS DOUBLE) AS w FROM pr JOIN ik USING (country, name, key) WHERE true{skips}),
sc AS (SELECT s1_id, cand_id, country, source, s1_ord, cand_ord, round(sum(w), 6) AS score FROM pa GROUP BY ALL{" HAVING " + " AND ".join(having) if having else ""}),
{tag} AS (SELECT *, CAST(row_number() OVER (PARTITION BY {part} ORDER BY score DESC, cand_ord, cand_id) AS INT) AS rank FROM sc{f" QUALIFY rank <= {spec.k}" if spec.k is not None else ""})"""


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join((RECORDS_SQL, *ctes)) + "\n" + select


TRUTH = "truth AS (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id FROM ents a JOIN ents b ON a.country = b.country AND a.gk = b.gk WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"


def lists(pairs: str, name: str) -> str:
    return f"{name} AS (SELECT r.entity_id AS s1_id, coalesce(list_sort(list(DISTINCT p.cand_id) FILTER (p.cand_id IS NOT NULL)), []) AS ids FROM rec r LEFT JOIN {pairs} p ON p.s1_id = r.entity_id WHERE r.source = 'S1' GROUP BY r.entity_id)"


F05 = "CASE WHEN len(t) = 0 THEN CASE WHEN len(p) = 0 THEN 1.0 ELSE 0.0 END WHEN len(p) = 0 OR h = 0 THEN 0.0 ELSE 1.25 * (h / len(p)) * (h / len(t)) / (0.25 * (h / len(p)) + h / len(t)) END"
SCORES = f"scores AS (SELECT s1_id, len(t) AS n_true, len(p) AS n_pred, h AS n_hit, round({F05}, 9) AS f05 FROM (SELECT tl.s1_id, tl.ids AS t, pl.ids AS p, len(list_intersect(tl.ids, pl.ids)) AS h FROM tl JOIN pl USING (s1_id)))"

PAIRS = "pairs AS (SELECT k.*, {cols} FROM {cand} k JOIN rec a ON a.entity_id = k.s1_id JOIN rec b ON b.entity_id = k.cand_id)"


def paired(cand: str = "cand") -> str:
    own = ("country", "norm_name", "norm_addr", "name_tokens", "addr_tokens", "addr_numbers", "light_name", "light_addr", "business_name", "business_address")
    return PAIRS.format(cols=", ".join(f"{s}.{x} AS {s}_{x}" for s in "ab" for x in own), cand=cand)


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"


def flag(x: str) -> str:
    return f"CAST(coalesce({x}, false) AS DOUBLE)"


def pin(nums: str) -> str:
    return f"list_filter({nums}, lambda n: (length(n) = 6 AND left(n, 1) <> '0') OR length(n) = 5)[1]"


def initials(x: str) -> str:
    return f"array_to_string(list_transform(list_filter({toks(x)}, lambda t: length(t) >= 2), lambda t: left(t, 1)), '')"


def containment(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> '' AND {b} <> '' AND (contains({a}, {b}) OR contains({b}, {a})) THEN least(length({a}), length({b})) / greatest(length({a}), length({b})) ELSE 0.0 END"


def same_set(a: str, b: str) -> str:
    return f"len({a}) > 0 AND list_sort(list_distinct({a})) = list_sort(list_distinct({b}))"


FEATURES = {
    "name_jaccard": jaccard("a_name_tokens", "b_name_tokens"),
    "name_common_token_ratio": "CASE WHEN least(len(a_name_tokens), len(b_name_tokens)) = 0 THEN 0.0 ELSE len(list_intersect(a_name_tokens, b_name_tokens)) / least(len(a_name_tokens), len(b_name_tokens)) END",
    "name_len_diff": "CAST(abs(length(a_norm_name) - length(b_norm_name)) AS DOUBLE)",
    "addr_jaccard": jaccard("a_addr_tokens", "b_addr_tokens"),
    "addr_number_match": flag(same_set("a_addr_numbers", "b_addr_numbers")),
    "addr_number_jaccard": jaccard("a_addr_numbers", "b_addr_numbers"),
    "addr_has_any": flag("a_norm_addr <> '' OR b_norm_addr <> ''"),
    "addr_both_empty": flag("a_norm_addr = '' AND b_norm_addr = ''"),
    "country_match": flag("a_country = b_country"),
    "name_exact_match": flag("a_norm_name <> '' AND a_norm_name = b_norm_name"),
    "addr_exact_match": flag("a_norm_addr <> '' AND a_norm_addr = b_norm_addr"),
    "first_token_match": flag(f"{least(toks('a_norm_name'), 2)}[1] = {least(toks('b_norm_name'), 2)}[1]"),
    "pincode_match": flag(f"{pin('a_addr_numbers')} = {pin('b_addr_numbers')}"),
    "pincode_conflict": flag(f"{pin('a_addr_numbers')} <> {pin('b_addr_numbers')}"),
    "initials_match": flag(f"length({initials('a_norm_name')}) >= 2 AND {initials('a_norm_name')} = {initials('b_norm_name')}"),
    "name_containment_ratio": containment("a_norm_name", "b_norm_name"),
    "name_char_3gram_jaccard": jaccard(grams("a_norm_name"), grams("b_norm_name")),
    "addr_containment_ratio": containment("a_norm_addr", "b_norm_addr"),
}


def conflict(a: str, b: str) -> str:
    return f"(len({a}) > 0 AND len({b}) > 0 AND len(list_intersect({a}, {b})) = 0)"


def jw(a: str, b: str) -> str:
    return f"round(CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE jaro_winkler_similarity({a}, {b}) END, 6)"


RULES = {
    2: "CASE WHEN n >= 85 THEN CASE WHEN x THEN 0 ELSE 95 END WHEN n >= 70 AND a >= 60 THEN CASE WHEN x THEN 0 ELSE 90 END WHEN n >= 70 THEN CASE WHEN x THEN 0 WHEN m THEN 85 ELSE 65 END WHEN n >= 55 AND a >= 75 THEN CASE WHEN x THEN 0 ELSE 80 END WHEN a >= 80 AND m THEN 85 WHEN a >= 75 AND NOT x THEN CASE WHEN m THEN 75 ELSE 50 END WHEN n >= 55 AND m THEN 70 WHEN a >= 65 AND m AND n >= 30 THEN 60 ELSE 0 END",
    3: "CASE WHEN x AND n < 85 THEN 0 WHEN n >= 85 THEN 95 WHEN n >= 70 AND a >= 60 THEN 90 WHEN n >= 70 AND m THEN 88 WHEN n >= 70 THEN 68 WHEN n >= 55 AND a >= 70 THEN 82 WHEN n >= 55 AND m THEN 75 WHEN a >= 80 AND m THEN 85 WHEN a >= 70 AND m AND n >= 20 THEN 70 WHEN a >= 85 AND n >= 30 THEN 65 ELSE 0 END",
}


def lcs(a: str, b: str) -> str:
    """Longest common subsequence of two texts of up to 120 characters: a row of the table as the bits of a number."""
    hits = f"coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i, 1) = ch THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END)), 0)::HUGEINT"
    full = f"((1::HUGEINT << length({a})) - 1)"
    step = f"list_transform([v & {hits}], lambda u: ((v + u) | (v - u)) & {full})[1]"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - bit_count(list_reduce(string_split({b}, ''), lambda v, ch: {step}, {full})) END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100::DOUBLE ELSE 200::DOUBLE * ({lcs(a, b)}) / (length({a}) + length({b})) END"


def sorted_text(arr: str) -> str:
    return f"array_to_string(list_sort({arr}), ' ')"


def ratios(source: str, name: str, a: str, b: str) -> str:
    """CTEs of which the last, ``name``, has for each pair of texts (x, y) in ``source`` the four token and letter ratios,
    each by itself by its definition."""
    left, right, both = "list_filter(list_distinct(tx), lambda w: NOT list_contains(ty, w))", "list_filter(list_distinct(ty), lambda w: NOT list_contains(tx, w))", "list_intersect(tx, ty)"
    one, two, shared = "(n + g + length(l))", "(n + g + length(r))", "n"
    by_set = f"CASE WHEN len(tx) = 0 OR len(ty) = 0 THEN 0::DOUBLE WHEN n > 0 AND (l = '' OR r = '') THEN 100::DOUBLE ELSE greatest(100::DOUBLE - 100::DOUBLE * (length(l) + length(r) - 2 * ({lcs('l', 'r')})) / ({one} + {two}), CASE WHEN n > 0 THEN 100::DOUBLE - 100::DOUBLE * (g + length(l)) / ({shared} + {one}) ELSE 0::DOUBLE END, CASE WHEN n > 0 THEN 100::DOUBLE - 100::DOUBLE * (g + length(r)) / ({shared} + {two}) ELSE 0::DOUBLE END) END"
    return f"""{name}_p AS (SELECT DISTINCT {a} AS x, {b} AS y FROM {source}),
{name}_t AS (SELECT *, {toks("x")} AS tx, {toks("y")} AS ty FROM {name}_p),
{name}_s AS (SELECT *, {sorted_text("tx")} AS sx, {sorted_text("ty")} AS sy, {sorted_text(left)} AS l, {sorted_text(right)} AS r, length({sorted_text(f"list_distinct({both})")}) AS n FROM {name}_t),
{name}_g AS (SELECT *, CAST(n > 0 AS INT) AS g FROM {name}_s),
{name} AS (SELECT x, y, {ratio("x", "y")} AS plain, {ratio("sx", "sy")} AS by_sort, {by_set} AS by_set FROM {name}_g)"""


def partial_ratios(source: str, name: str, a: str, b: str) -> str:
    """CTEs; the last, ``name``, has for each pair (x, y) the best ratio of the shorter text to a stretch of the longer, of its
    length or cut off at an end."""
    return f"""{name}_p AS (SELECT DISTINCT {a} AS x, {b} AS y FROM {source} WHERE {a} <> '' AND {b} <> ''),
{name}_o AS (SELECT x, y, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS s, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS o FROM {name}_p),
{name}_e AS (SELECT x, y, s, o FROM {name}_o UNION ALL SELECT x, y, o, s FROM {name}_o WHERE length(s) = length(o)),
{name}_w AS (SELECT DISTINCT x, y, s, substr(o, greatest(1, k), k + length(s) - greatest(1, k)) AS w FROM (SELECT *, unnest(range(2 - length(s), length(o) + 1)) AS k FROM {name}_e)),
{name} AS (SELECT x, y, max({ratio("s", "w")}) AS best FROM {name}_w GROUP BY x, y)"""


def tfidf(column: str, low: int, high: int, k: int, features: int = 80_000, floor: float = 0.01) -> str:
    """CTEs for tfidf.cosine_top_k; the last is ``cand``."""
    gram = " UNION ALL ".join(f"SELECT country, source, entity_id, ord, unnest(CASE WHEN length(w) >= {n} THEN list_transform(range(1, length(w) - {n - 2}), lambda i: substr(w, i, {n})) ELSE {'[w]' if n == low else '[]'} END) AS gram FROM ww" for n in range(low, high + 1))
    return f"""ww AS (SELECT country, source, entity_id, ord, ' ' || unnest({toks(f"lower({column})")}) || ' ' AS w FROM rec),
g AS (SELECT country, source, entity_id, ord, gram, count(*) AS tf FROM ({gram}) GROUP BY ALL),
sz AS (SELECT country, count(*) AS n FROM rec WHERE source <> 'S1' GROUP BY country),
vo AS (SELECT country, gram, df, n, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT country, gram, count(*) AS df, sum(tf) AS total FROM g WHERE source <> 'S1' GROUP BY ALL) JOIN sz USING (country) QUALIFY row_number() OVER (PARTITION BY country ORDER BY total DESC, gram) <= {features}),
wt AS (SELECT g.*, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY country, entity_id)) AS norm, n FROM g JOIN vo USING (country, gram)),
sc AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, a.country, b.source, a.ord AS s1_ord, b.ord AS cand_ord, any_value(a.n) AS n, round(sum((a.w / a.norm) * (b.w / b.norm)), 6) AS score FROM wt a JOIN wt b ON a.country = b.country AND a.gram = b.gram WHERE a.source = 'S1' AND b.source <> 'S1' GROUP BY ALL),
cand AS (SELECT * EXCLUDE (n), CAST(row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_ord, cand_id) AS INT) AS rank FROM sc WHERE score > CASE WHEN n <= {k} THEN 0.0 ELSE {floor} END QUALIFY rank <= {k})"""
