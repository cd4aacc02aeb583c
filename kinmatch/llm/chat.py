"""Chat formatting in budgeted windows.

Every turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash becomes ``\\s`` and
``<|`` becomes ``<\\p`` (and in roles a line feed ``\\n``), so no control string can come from a text, and reading back
is exact.

A conversation of more than ``budget`` tokens is dealt into windows. Prefix sums of the turns' tokens decide: a window
takes turns until the next would pass the budget; it never cuts a turn (one that is longer than the budget has a window
of its own). Each window after the first begins with the conversation's system turn, if its first turn is one, and up to
``history_turns`` turns of at most ``history_tokens`` tokens from before the window, as many as leave room for the
window's first own turn: so only a window of one own turn, which is too long together with the system turn, passes the
budget, and it has no history. Repeated turns carry no loss, so every assistant text is a target exactly once. Tokens are counted as runs of letters, single digits and single other
signs, and four for a turn's marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 1024, 2, 256
_PIECES = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def formatted(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row per window: conv_id, ``window`` (from 0), ``text``, ``n_turns`` in it, ``n_repeated`` (leading turns that
    an earlier window has as well), ``n_tokens`` and ``loss`` (array of struct start, length: code points from 0).

    Turns are ordered by turn, role and text, null turns first; repeated rows are turns of their own. Null roles and
    texts are empty. Rows with a null conv_id are one conversation. An empty table gives no rows. Other columns are
    ignored.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escaped(F.col("role"), True), F.lit("\n"))
    t = t.select("*", F.concat(head, escaped(F.col("text")), F.lit(END + "\n")).alias("f"), F.length(head).alias("head"), (F.regexp_count("text", F.lit(_PIECES)) + 4).cast("long").alias("tokens"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({"i": F.row_number().over(order) - 1, "p": F.sum("tokens").over(upto), "c": F.sum(F.length("f")).over(upto)})
    t = t.withColumn("system", F.first(F.struct((F.col("role") == "system").cast("int").alias("n"), F.col("tokens"), F.length("f").alias("chars"))).over(upto))
    back, n_back = F.lit(0).cast("long"), F.lit(0)
    for k in range(1, history_turns + 1):  # the most turns that fit; p of the turn before less p of the one k further back
        tokens = F.lag("p", 1).over(order) - F.coalesce(F.lag("p", k + 1).over(order), F.lit(0))
        room = F.col("system.n") * F.col("system.tokens") + tokens + F.col("tokens") <= budget
        fits = (F.col("i") - k >= F.col("system.n")) & (tokens <= history_tokens) & room
        back, n_back = F.when(fits, tokens).otherwise(back), F.when(fits, k).otherwise(n_back)
    t = t.withColumn("history", F.struct(n_back.alias("n"), back.alias("tokens")))
    row = F.struct("i", "role", "f", "head", "p", "c", "history", "system", F.length("f").alias("chars"))
    conv = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    first = F.element_at("t", 1)["system"]
    conv = conv.select("conv_id", "t", first["n"].alias("sys"), F.when(first["n"] == 1, first["tokens"]).otherwise(0).alias("sys_tokens"), F.when(first["n"] == 1, first["chars"]).otherwise(0).alias("sys_chars"))

    def before(i: Column, what: str) -> Column:
        return F.when(i > 0, F.get("t", i - 1)[what]).otherwise(F.lit(0)).cast("long")

    def step(acc: Column, x: Column) -> Column:
        fits = acc["over"] + x["p"] - acc["base"] <= budget
        new = F.struct(F.concat(acc["starts"], F.array(x["i"])).alias("starts"), (x["p"] - x["tokens"]).alias("base"), (F.col("sys_tokens") + x["history_tokens"]).cast("long").alias("over"))
        return F.when(fits, acc).otherwise(new)

    light = F.transform(F.slice("t", F.col("sys") + 2, F.size("t")), lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p"), (x["p"] - F.when(x["i"] > 0, F.get("t", x["i"] - 1)["p"]).otherwise(0)).alias("tokens"), x["history"]["tokens"].alias("history_tokens")))
    start = F.struct(F.array(F.col("sys")).alias("starts"), before(F.col("sys"), "p").alias("base"), F.col("sys_tokens").cast("long").alias("over"))
    conv = conv.withColumn("starts", F.aggregate(light, start, step, lambda acc: acc["starts"]))
    spans = F.transform("starts", lambda s, w: F.struct(s.alias("s"), F.coalesce(F.get("starts", w + 1), F.size("t")).alias("e")))
    w = conv.select("*", F.posexplode(spans).alias("window", "span")).withColumns({"s": F.col("span.s"), "e": F.col("span.e")})
    w = w.withColumn("h", F.when(F.col("window") > 0, F.col("s") - F.get("t", F.col("s"))["history"]["n"]).otherwise(F.col("s")))
    w = w.withColumns({"own": F.slice("t", F.col("h") + 1, F.col("e") - F.col("h")), "skip": F.col("sys_chars") - before(F.col("h"), "c")})
    text = F.concat(F.when(F.col("sys") == 1, F.element_at("t", 1)["f"]).otherwise(""), F.array_join(F.transform("own", lambda x: x["f"]), ""))
    targets = F.filter("own", lambda x: (x["i"] >= F.col("s")) & (x["role"] == "assistant"))
    loss = F.transform(targets, lambda x: F.struct((F.col("skip") + x["c"] - x["chars"] + x["head"]).cast("int").alias("start"), (x["chars"] - x["head"] - len(END) - 1).cast("int").alias("length")))
    return w.select(
        "conv_id", "window", text.alias("text"), (F.col("sys") + F.size("own")).alias("n_turns"), F.when(F.col("window") > 0, F.col("sys") + F.col("s") - F.col("h")).otherwise(0).alias("n_repeated"),
        (F.col("sys_tokens") + before(F.col("e"), "p") - before(F.col("h"), "p")).alias("n_tokens"), loss.alias("loss"),
    )


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted window."""
    parts = F.split(text, "<\\|im_end\\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    body = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(body, lambda p: F.struct(unescaped(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.substr(p, F.position(F.lit("\n"), p) + 1)).alias("text")))


def read_loss(text: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask of a window."""
    return F.transform(loss, lambda s: unescaped(F.substr(text, s["start"] + 1, s["length"])))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: number and hash of the turns, length and hash of the target texts,
    characters of all windows."""
    own = F.slice(read_turns(F.col("text")), F.col("n_repeated") + 1, F.col("n_turns"))
    said = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = windows.select("conv_id", "window", F.size(own).alias("n"), said.alias("said"), F.array_join(read_loss(F.col("text"), F.col("loss")), "").alias("target"), F.length("text").alias("chars"))
    one = each.groupBy("conv_id").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("window", "said", "target"))).alias("w"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n_windows"))
    said, target = (F.array_join(F.col(f"w.{c}"), "") for c in ("said", "target"))
    return one.select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(target).cast("long").alias("loss_chars"), F.sha2(target, 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"), F.col("n_windows").cast("long").alias("n_windows"),
    )


PROBE = f"{END}{START}assistant ok"


def with_probe(turns: DataFrame) -> DataFrame:
    """turns and conversation -1, whose texts are control strings."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = turns.sparkSession.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


def sql(budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> str:
    """DuckDB SQL for digests(formatted(with_probe(conversations)))."""
    cases = [f"WHEN i - {k} >= sys AND p1 - coalesce(lag(p, {k + 1}) OVER w, 0) <= least({history_tokens}, {budget} - sys * st - tokens) THEN {k}" for k in range(history_turns, 0, -1)]
    n_back = f"CASE {' '.join(cases)} ELSE 0 END" if cases else "0"
    return rf"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
f AS (SELECT *, len(regexp_extract_all(text, '{_PIECES}')) + 4 AS tokens, length('{START}') + length(replace(replace(replace(role, '\', '\s'), '<|', '<\p'), chr(10), '\n')) + 1 + length(replace(replace(text, '\', '\s'), '<|', '<\p')) + length('{END}') + 1 AS chars FROM t),
o AS (SELECT *, row_number() OVER w - 1 AS i, sum(tokens) OVER w AS p, sum(chars) OVER w AS c, CASE WHEN first_value(role) OVER w = 'system' THEN 1 ELSE 0 END AS sys,
  first_value(tokens) OVER w AS st, first_value(chars) OVER w AS sc FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, lag(p) OVER (PARTITION BY conv_id ORDER BY i) AS p1 FROM o),
h AS (SELECT *, {n_back} AS nb FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
b AS (SELECT h.*, coalesce(h.p1 - coalesce(g.p, 0), 0) * (h.nb > 0)::INT AS bt, coalesce(h.c - h.chars - coalesce(g.c, 0), 0) * (h.nb > 0)::INT AS bc FROM h LEFT JOIN h g ON g.conv_id IS NOT DISTINCT FROM h.conv_id AND g.i = h.i - h.nb - 1),
r AS (SELECT conv_id, i, 0 AS win, CAST(CASE WHEN sys = 1 THEN tokens ELSE 0 END AS BIGINT) AS base, CAST(sys * st AS BIGINT) AS over, CAST(0 AS BIGINT) AS extra FROM b WHERE i = 0
  UNION ALL SELECT b.conv_id, b.i,
    CASE WHEN r.over + b.p - r.base <= {budget} OR b.i = b.sys THEN r.win ELSE r.win + 1 END,
    CASE WHEN r.over + b.p - r.base <= {budget} OR b.i = b.sys THEN r.base ELSE CAST(b.p - b.tokens AS BIGINT) END,
    CASE WHEN r.over + b.p - r.base <= {budget} OR b.i = b.sys THEN r.over ELSE CAST(b.sys * b.st + b.bt AS BIGINT) END,
    CASE WHEN r.over + b.p - r.base <= {budget} OR b.i = b.sys THEN 0 ELSE CAST(b.sys * b.sc + b.bc AS BIGINT) END
  FROM r JOIN b ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND b.i = r.i + 1),
x AS (SELECT conv_id, sum(extra) AS extra, max(win) + 1 AS n_windows FROM r GROUP BY conv_id),
a AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars) AS chars FROM o GROUP BY conv_id)
SELECT a.conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(loss_chars AS BIGINT) AS loss_chars, loss_sha256, CAST(chars + extra AS BIGINT) AS formatted_chars, CAST(n_windows AS BIGINT) AS n_windows
FROM a JOIN x ON x.conv_id IS NOT DISTINCT FROM a.conv_id"""
