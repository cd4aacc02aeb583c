"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them, over the whole text. Each passage is encoded (rates
of character classes, forms and repetition of its words, then a learned layer); gated attention, tanh(hV) * sigmoid(hU),
gives each passage a weight; the weighted sum of the passages' codes is scored. Only documents have labels; the weights
learn by themselves which passages tell.

Learning takes labelled documents in the order of a hash of their ids, with all their passages: ``SAMPLE_DOCS`` documents
and ``SAMPLE_PASSAGES`` passages at most, all together. Scoring takes all passages of all documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.base import crc_fold, ship, small, written

PASSAGE, SAMPLE_DOCS, SAMPLE_PASSAGES = 64, 4000, 60_000
CODE, GATE, HASHED, EPOCHS, BATCH, RATE, DECAY = 24, 12, 32, 30, 64, 0.01, 1e-4
CUT, ROWS = 1 << 20, 500
THRESHOLD = 0.3

#: Character classes by byte; what isn't listed has a class of its own kind at the end.
_CLASSES = (b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!", b"?", b"|", b"#", b"$", b"%", b"&", b"*", b"@", b"<>", b"()[]{}", b"\"'`", b":;", b"-_=+~^/\\", bytes(range(0xC0, 256)), bytes(range(0x80, 0xC0)))
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i
N_CLASSES = len(_CLASSES) + 1
N_OTHERS = 11
N_FEATURES = N_CLASSES + N_OTHERS + HASHED
_BLANK = re.compile(rb"[ \t\n\r\x0b\x0c]")


def blocks(raw: bytes) -> Iterator[list[bytes]]:
    """A text's words, of about a megabyte at a time."""
    at = 0
    while at < len(raw):
        m = _BLANK.search(raw, at + CUT)
        to = m.end() if m else len(raw)
        yield raw[at:to].split()
        at = to


def passages(text: str | None) -> np.ndarray:
    """Features (passages x N_FEATURES); a text without words has one passage of zeros."""
    rows, left, before = [], [], frozenset()
    raw = text.encode("utf-8", "surrogatepass") if text else b""

    def add(w: list[bytes]) -> None:
        nonlocal before
        n, joined = len(w), b"".join(w)
        x = np.zeros(N_FEATURES, np.float32)
        x[:N_CLASSES] = np.bincount(_CLASS[np.frombuffer(joined, np.uint8)], minlength=N_CLASSES) / len(joined)
        own, pairs = set(w), frozenset(zip(w, w[1:], strict=False))
        chars = len(joined) / n
        ends = sum(y[-1:].isalnum() for y in w)
        x[N_CLASSES : N_CLASSES + N_OTHERS] = (
            n / PASSAGE, chars / 10, max(map(len, w)) / 50, len(own) / n, len(pairs) / max(1, n - 1), len(pairs & before) / max(1, len(pairs)),
            ends / n, sum(len(y) <= 3 for y in w) / n, sum(map(bytes.istitle, w)) / n, sum(map(bytes.isupper, w)) / n, sum(map(bytes.__eq__, w, w[1:])) / n,
        )
        for y in own:
            x[N_CLASSES + N_OTHERS + zlib.crc32(y) % HASHED] += 1 / len(own)
        before = pairs
        rows.append(x)

    for w in blocks(raw):
        w = left + w
        whole = len(w) - len(w) % PASSAGE
        for k in range(0, whole, PASSAGE):
            add(w[k : k + PASSAGE])
        left = w[whole:]
    if left:
        add(left)
    return np.stack(rows) if rows else np.zeros((1, N_FEATURES), np.float32)


@dataclass
class Bags:
    """Passages of many documents, one after the other; ``first`` is each document's first."""

    x: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, bags: list[np.ndarray]) -> Bags:
        n = np.array([len(b) for b in bags])
        return cls(np.concatenate(bags), np.concatenate([[0], np.cumsum(n)[:-1]]))

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.x)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        p, first, sizes = self.p, bags.first, bags.sizes()
        x = np.clip((bags.x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        weight = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-(z @ p["c"] + p["c0"])))}

    def gradients(self, bags: Bags, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, f, sizes = self.p, self.forward(bags), bags.sizes()
        d = (f["score"] - y) / len(y)
        dz = np.repeat(d[:, None] * p["c"], sizes, axis=0)
        dw = (dz * f["h"]).sum(axis=1)
        de = f["weight"] * (dw - np.repeat(np.add.reduceat(f["weight"] * dw, bags.first), sizes))
        dt = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["weight"][:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
        return {"c": f["z"].T @ d, "c0": np.array([d.sum()]), "a": (f["t"] * f["g"]).T @ de, "v": f["h"].T @ dt, "u": f["h"].T @ dg, "w": f["x"].T @ dh, "b": dh.sum(axis=0)}

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores, and the passages' attention weights."""
        b = Bags.of(bags)
        f = self.forward(b)
        return f["score"], np.split(f["weight"], b.first[1:])


def fit(bags: list[np.ndarray], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Model:
    """A model from documents' passages and labels; without any, or with one label only, it scores that label's share."""
    rng, y = np.random.default_rng(seed), np.array(labels, dtype=float)
    x = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES), np.float32)
    n, d = len(bags), N_FEATURES
    share = (y.sum() + 1) / (n + 2)
    p = {"w": rng.normal(size=(d, CODE)) / d**0.5, "b": np.zeros(CODE), "v": rng.normal(size=(CODE, GATE)) / CODE**0.5, "u": rng.normal(size=(CODE, GATE)) / CODE**0.5, "a": rng.normal(size=GATE) / GATE**0.5, "c": np.zeros(CODE), "c0": np.array([np.log(share / (1 - share))])}
    model = Model(x.mean(axis=0), x.std(axis=0) + 0.01, p)
    if len(set(labels)) < 2:
        return model
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(n)
        for k in range(0, n, BATCH):
            i = order[k : k + BATCH]
            step += 1
            for name, g in model.gradients(Bags.of([bags[j] for j in i]), y[i]).items():
                if name in "wvu":
                    g = g + DECAY * p[name]
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 5) == 0


def sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES) -> list[tuple[np.ndarray, int]]:
    """(passages, label) of the labelled documents to learn from, in the order of a hash of their ids: ``sample_docs`` and
    ``sample_passages`` at most. A document is taken with its whole text or not at all: one that doesn't fit into what is
    left is passed over.

    Several labels of a document are averaged; null labels and ids don't count. Rows that repeat an id are one document,
    with the text whose hash is the least. Empty tables give an empty sample."""
    spark = docs.sparkSession
    ship(spark)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg((F.avg("quality") >= 0.5).cast("int").alias("__y"))
    marks = marks.join(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id")), "__id", "left_semi")
    first = F.xxhash64("__id", F.lit("sample"))
    picked = written(marks.orderBy(first, "__id").limit(sample_docs), "quality-sample")
    text = F.xxhash64(F.coalesce("text", F.lit("")), F.lit("text"))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    sized = docs.select(F.col("doc_id").alias("__id"), F.struct(text.alias("h"), F.greatest(F.lit(1), F.ceil(words / PASSAGE)).alias("n")).alias("t"))
    rows = sized.join(small(picked, 16), "__id").groupBy("__id", "__y").agg(F.min("t").alias("t")).orderBy(first, "__id").select("__id", "t.h", "t.n").collect()
    left, chosen = sample_passages, []
    for r in rows:  # at most sample_docs rows of three numbers
        if r["n"] <= left:
            left -= r["n"]
            chosen.append((r["__id"], r["h"]))
    if not chosen:
        return []

    @F.pandas_udf("binary")
    def bag(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.llm import attention as own

        for s in parts:
            yield pd.Series([own.passages(t).tobytes() for t in s])

    wanted = written(spark.createDataFrame(chosen, "__id long, h long").join(picked, "__id"), "quality-chosen")
    same = (F.col("doc_id") == F.col("__id")) & (text == F.col("h"))
    bags = docs.select("doc_id", "text").join(small(wanted, 24), same).select("__id", "__y", bag("text").alias("x"))
    found = bags.groupBy("__id", "__y").agg(F.min("x").alias("x")).orderBy("__id").collect()
    return [(np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES), r["__y"]) for r in found]


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, quality 0 or 1); cases and ``bounds`` as in sample()."""
    rows = sample(docs, labels, **bounds)
    return fit([x for x, _ in rows], [y for _, y in rows])


def scored(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "quality", attention: bool = False) -> DataFrame:
    """docs with a further struct column: ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD`` on) and with
    ``attention`` the passages' weights. Only the text is looked at; null and empty texts are one empty passage.
    Repeated rows score alike; an empty table stays empty."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    @F.pandas_udf("score double, predicted int" + ", attention array<double>" * attention)
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm import attention as own

        m = held.value
        for s in parts:
            for k in range(0, len(s), own.ROWS):
                score, weights = m.score([own.passages(t) for t in s.iloc[k : k + own.ROWS]])
                score = np.round(score, 9)  # the last digits depend on what else is in the batch
                out = {"score": score, "predicted": (score >= own.THRESHOLD).astype("int32")}
                yield pd.DataFrame(out | ({"attention": weights} if attention else {}))

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out_col], of(F.col(f"`{text_col}`")).alias(out_col))
