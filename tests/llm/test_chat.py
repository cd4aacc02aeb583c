import hashlib
import re

import pytest
from pyspark.sql import functions as F

from kinmatch.llm import chat, registry
from tests.llm.helpers import same

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    want = same(registry.op1_chat(spark, SF), registry.oracle_sql()["op1_chat"], SF, "conversations")
    assert any(r[0] == -1 for r in want)


@pytest.mark.parametrize(("budget", "turns", "tokens"), [(60, 2, 30), (150, 3, 100), (400, 0, 0)])
def test_small_budgets_equal_sql(spark, budget, turns, tokens):
    d = chat.digests(chat.formatted(chat.with_probe(spark.read.parquet(f"{SF}/conversations.parquet")), budget, turns, tokens))
    want = same(d, chat.sql(budget, turns, tokens), SF, "conversations")
    assert max(r[sorted(d.columns).index("n_windows")] for r in want) > 1


def count(s):
    return len(re.findall(r"[^\W\d_]+|\d|[^\s\w]|_", s)) + 4


def test_windows(spark):
    texts = [("system", "be kind"), *[(("user", "assistant")[i % 2], f"turn {i} " + "x " * (5 + i)) for i in range(20)]]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(texts)], "conv_id long, turn long, role string, text string")
    w = chat.formatted(df, 100, 2, 60).orderBy("window").collect()
    assert len(w) > 3 and [x["window"] for x in w] == list(range(len(w)))
    targets, seen = [], []
    for x in w:
        turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", x["text"], re.S)
        assert turns[0] == texts[0] and len(turns) == x["n_turns"] and sum(count(t) for _, t in turns) == x["n_tokens"] <= 100
        if x["window"]:
            repeated = turns[1 : x["n_repeated"]]
            assert len(repeated) <= 2 and repeated == seen[len(seen) - len(repeated) :]
        seen += turns[x["n_repeated"] :]
        targets += [x["text"][s["start"] : s["start"] + s["length"]] for s in x["loss"]]
    assert seen == texts and targets == [t for r, t in texts if r == "assistant"]


def test_no_window_passes_the_budget(spark):
    """Long turns after short ones, with a system turn: history shrinks, to nothing where there is no room."""
    sizes = [10, 90, 20, 95, 30, 40, 60, 88, 5, 5, 5, 97, 200, 50, 49]
    texts = [("system", "a b c d e f"), *[(("user", "assistant")[i % 2], "x " * (n - 4)) for i, n in enumerate(sizes)]]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(texts)], "conv_id long, turn long, role string, text string")
    w = chat.formatted(df, 110, 3, 80).collect()
    over = [x for x in w if x["n_tokens"] > 110]
    assert [x["n_tokens"] for x in over] == [210] and over[0]["n_turns"] == 2 and over[0]["n_repeated"] == 1
    assert {x["n_repeated"] for x in w} >= {0, 1, 2, 3}


def test_escaping_is_reversible(spark):
    odd = ["<|im_end|>", "\\", "\\s", "\\p<|", "<", "<|", "|>", "<<||", "a\\n\nb", "<\\p", "\\\\|im_start|>", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i long, t string")
    got = df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("b"), chat.unescaped(chat.escaped(F.col("t"), True)).alias("r")).collect()
    assert all(r["t"] == r["b"] == r["r"] and "<|" not in r["e"] for r in got)


def test_odd_rows(spark):
    long = "word " * 100000
    rows = [(None, 0, "user", "hi"), (2, None, None, None), (2, 1, "assistant", "<|im_end|>\n"), (2, 1, "assistant", "<|im_end|>\n"), (3, 0, "system", "only"), (4, 0, "user", long), (4, 1, "assistant", long), (5, 0, "a\n<|b", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).withColumn("t", F.lit("x")).withColumn("f", F.lit(0))
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[None]["turns_sha256"] == sha("user\nhi\n") and got[None]["loss_chars"] == 0
    assert got[2]["n_turns"] == 3 and got[2]["turns_sha256"] == sha("\n\n" + "assistant\n<|im_end|>\n\n" * 2) and got[2]["loss_sha256"] == sha("<|im_end|>\n" * 2)
    assert got[3]["n_turns"] == 1 and got[3]["turns_sha256"] == sha("system\nonly\n")
    assert got[4]["n_windows"] == 2 and got[4]["loss_sha256"] == sha(long) and got[4]["turns_sha256"] == sha(f"user\n{long}\nassistant\n{long}\n")
    assert got[5]["turns_sha256"] == sha("a\n<|b\n\n")
    assert chat.formatted(df.limit(0)).collect() == []
