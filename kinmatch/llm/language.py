"""Language identification by a linear-chain conditional random field over words.

Each word (a run of letters, lower-cased) has features: affixes, character n-grams, the word itself and the lexicons that
hold it. Their weights give a score for each language; learned transitions tie neighbours together, so in code-switched
text every word gets a language from its own form and its surroundings. Forward-backward gives each word's marginal
probabilities; a text's language is the one with the largest sum of them, its score that sum's share.

Learning: stochastic gradient (Adagrad) on the log likelihood of spliced sequences, made of spans of labelled documents
in which one span in ``SWITCH`` is followed by one of another language. The spans, of ``SPAN`` words, are all those of a
sample of whole texts, chosen by a hash of the text: ``SAMPLE_DOCS`` texts and ``SAMPLE_WORDS`` words at most, shared
equally between the languages. Everything else is done for all documents and whole texts.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.llm.base import crc_fold, ship

SAMPLE_DOCS, SAMPLE_WORDS, SPAN, SWITCH = 4000, 400_000, 20, 0.3
BUCKETS, LEXICON, EPOCHS, BATCH, RATE = 1 << 16, 2000, 3, 64, 0.3
CACHE_WORDS, GROUP_WORDS = 300_000, 1_000_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    found = _WORD.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]  # the expression also takes signs like 1/2 and superscripts


def features(word: str) -> list[int]:
    """Hashed affixes (1 to 4 letters), n-grams (2 and 3, with the word's ends) and the word."""
    crc, raw = zlib.crc32, f"^{word}$"
    out = [crc(f"w{word}".encode())]
    for n in (1, 2, 3, 4):
        out.append(crc(f"p{word[:n]}".encode()))
        out.append(crc(f"s{word[-n:]}".encode()))
    out += [crc(raw[k : k + n].encode()) for n in (2, 3) for k in range(len(raw) - n + 1)]
    return [h % BUCKETS for h in out]


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray  # (BUCKETS + languages, languages): hashed features, then one for each language's lexicon
    lexicon: dict[str, tuple[int, ...]]
    start: np.ndarray
    moves: np.ndarray
    known: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)

    def indices(self, word: str) -> list[int]:
        return features(word) + [BUCKETS + k for k in self.lexicon.get(word, ())]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "table")} | {"known": {}, "table": None}

    def rows(self, words: list[str]) -> np.ndarray:
        """Places of the words' emissions in ``table``; new words are added."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
            self.table = None
        new = list(dict.fromkeys(w for w in words if w not in known))
        if new:
            found = [self.indices(w) for w in new]
            flat = np.concatenate([np.array(x, dtype=np.int64) for x in found])
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])[:-1]])
            e = np.add.reduceat(self.weights[flat], at, axis=0)
            e = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
            n = len(known)
            if self.table is None or n + len(new) > len(self.table):
                grown = np.empty((max(1024, 2 * (n + len(new))), len(self.langs)), np.float32)
                if n:
                    grown[:n] = self.table[:n]
                self.table = grown
            self.table[n : n + len(new)] = e
            known.update(zip(new, range(n, n + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def marginals(self, emissions: list[np.ndarray], whole: bool = False) -> list[np.ndarray]:
        """For each sequence (words x languages) the sum of its words' marginal probabilities, or all of them.

        All sequences advance together, the longest first, so a step is one small matrix product."""
        order = sorted(range(len(emissions)), key=lambda i: -len(emissions[i]))
        lens = np.array([len(emissions[i]) for i in order])
        k, steps = len(self.langs), int(lens[0]) if len(lens) else 0
        out: list[np.ndarray] = [np.zeros((0, k) if whole else k)] * len(emissions)
        if not steps:
            return out
        active = np.searchsorted(-lens, -np.arange(steps), side="left")  # sequences longer than t
        first = np.concatenate([[0], np.cumsum(active)])
        e = np.empty((first[-1], k), np.float32)
        for rank, i in enumerate(order):
            if lens[rank]:
                e[first[: lens[rank]] + rank] = emissions[i]
        moves, alpha = np.exp(self.moves - self.moves.max()).astype(np.float32), np.empty_like(e)
        a = np.exp(self.start - self.start.max()).astype(np.float32) * e[: active[0]]
        for t in range(steps):
            n, s = active[t], first[t]
            if t:
                a = (a[:n] @ moves) * e[s : s + n]
            a = a / a.sum(axis=1, keepdims=True)
            alpha[s : s + n] = a
        total, beta, back = np.zeros((len(order), k)), np.ones((active[-1], k), np.float32), moves.T.copy()
        for t in range(steps - 1, -1, -1):
            n, s = active[t], first[t]
            if len(beta) < n:
                beta = np.concatenate([beta, np.ones((n - len(beta), k), np.float32)])
            g = alpha[s : s + n] * beta
            g /= g.sum(axis=1, keepdims=True)
            if whole:
                alpha[s : s + n] = g
            total[:n] += g
            beta = (e[s : s + n] * beta) @ back
            beta /= beta.max(axis=1, keepdims=True)
        for rank, i in enumerate(order):
            out[i] = alpha[first[: lens[rank]] + rank] if whole else total[rank]
        return out

    def label(self, texts, spans: bool = False) -> list[tuple]:
        """(language, score) of each text, and with ``spans`` the runs (language, first word, words) of its words."""
        out: list[tuple] = []
        group: list[np.ndarray] = []

        def flush() -> None:
            for g in self.marginals([self.table[r] if len(r) else np.zeros((0, len(self.langs)), np.float32) for r in group], spans):
                m = g.sum(axis=0) if spans else g
                if not m.sum():
                    out.append(("und", 0.0, []) if spans else ("und", 0.0))
                    continue
                best = int(m.argmax())
                one = (self.langs[best], float(min(1.0, m[best] / m.sum())))
                if spans:
                    tag = g.argmax(axis=1)
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(tag)) + 1, [len(tag)]])
                    one += ([{"lang": self.langs[tag[a]], "first": int(a), "words": int(b - a)} for a, b in zip(cut[:-1], cut[1:], strict=True)],)
                out.append(one)
            group.clear()

        n = 0
        for t in texts:
            w = words_of(t) if self.langs else []
            if group and (n + len(w) > GROUP_WORDS or len(self.known) > CACHE_WORDS):
                flush()
                n = 0
            group.append(self.rows(w) if w else np.zeros(0, np.int32))
            n += len(w)
        flush()
        return out


def fit(spans: list[tuple[str, list[str]]], seed: int = 7, epochs: int = EPOCHS) -> Crf:
    """A model from (language, words) spans."""
    spans = sorted((lang, w) for lang, w in spans if w)
    langs = sorted({lang for lang, _ in spans})
    k, place = len(langs), {lang: i for i, lang in enumerate(langs)}
    counts = [Counter() for _ in langs]
    for lang, w in spans:
        counts[place[lang]].update(w)
    held: dict[str, list[int]] = {}
    for i, c in enumerate(counts):
        for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if n > 1:
                held.setdefault(w, []).append(i)
    model = Crf(langs, np.zeros((BUCKETS + k, k)), {w: tuple(x) for w, x in held.items()}, np.zeros(k), np.zeros((k, k)))
    if k < 2:
        return model
    rng = random.Random(seed)
    of = {lang: [w for x, w in spans if x == lang] for lang in langs}
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in spans for w in ws))}
    found = [model.indices(w) for w in vocabulary]
    widest = max(map(len, found))
    pad = model.weights.shape[0]  # an index past the end, without weight
    table = np.full((len(found), widest), pad, np.int32)
    for i, x in enumerate(found):
        table[i, : len(x)] = x
    weights = np.zeros((pad + 1, k))
    square = [np.full_like(weights, 1e-6), np.full(k, 1e-6), np.full((k, k), 1e-6)]
    n_batches = max(1, epochs * len(spans) // (3 * BATCH))
    for _ in range(n_batches):
        seqs = []
        for _ in range(BATCH):
            lang, ws, ys = rng.choice(langs), [], []
            for _ in range(3):
                if k > 1 and rng.random() < SWITCH:
                    lang = rng.choice([x for x in langs if x != lang])
                w = rng.choice(of[lang])
                ws += w
                ys += [place[lang]] * len(w)
            seqs.append((ws, ys))
        steps = max(len(w) for w, _ in seqs)
        ids, y, on = np.zeros((BATCH, steps), np.int64), np.zeros((BATCH, steps), np.int64), np.zeros((BATCH, steps), bool)
        for b, (ws, ys) in enumerate(seqs):
            ids[b, : len(ws)], y[b, : len(ws)], on[b, : len(ws)] = [vocabulary[w] for w in ws], ys, True
        idx = table[ids]
        score = weights[idx].sum(axis=2)
        e = np.exp(score - score.max(axis=2, keepdims=True))
        move, start = np.exp(model.moves), np.exp(model.start)
        alpha, beta = np.zeros_like(e), np.ones_like(e)
        for t in range(steps):
            a = start * e[:, 0] if t == 0 else (alpha[:, t - 1] @ move) * e[:, t]
            a = np.where(on[:, t : t + 1], a, alpha[:, t - 1] if t else a)
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        for t in range(steps - 2, -1, -1):
            b = (e[:, t + 1] * beta[:, t + 1]) @ move.T
            beta[:, t] = np.where(on[:, t + 1 : t + 2], b / b.sum(axis=1, keepdims=True), 1.0)
        g = alpha * beta
        g /= g.sum(axis=2, keepdims=True)
        gold = np.eye(k)[y]
        grad_e = np.where(on[:, :, None], gold - g, 0.0)
        pair = alpha[:, :-1, :, None] * move * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        both = on[:, 1:, None, None]
        grad_m = np.where(both, gold[:, :-1, :, None] * gold[:, 1:, None, :] - pair, 0.0).sum(axis=(0, 1)) / BATCH
        grad_s = (gold[:, 0] - g[:, 0]).sum(axis=0) / BATCH
        flat, own = idx[on].ravel(), np.repeat(grad_e[on] / BATCH, widest, axis=0)
        grad_w = np.stack([np.bincount(flat, own[:, c], len(weights)) for c in range(k)], axis=1)
        grad_w[pad] = 0
        for s, p, d in zip(square, (weights, model.start, model.moves), (grad_w, grad_s, grad_m), strict=True):
            s += d * d
            p += RATE * d / np.sqrt(s)
    model.weights = weights[:pad].astype(np.float32)
    return model


def sample_spans(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, span: int = SPAN) -> list[tuple[str, list[str]]]:
    """(language, words) spans of the texts to learn from. A text is taken whole or not at all: one that doesn't fit into
    its language's share of ``sample_words`` that is left is passed over (a word of over 8 letters counts as several).

    Rows without text or lang don't count, and rows that repeat a text and its lang are one text. Ids play no part. Empty
    tables give no spans."""
    spark = docs.sparkSession
    ship(spark)
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text", F.lit("sample")).alias("h"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # texts, one row per language
    if not sizes:
        return []
    each, words_each = max(1, sample_docs // len(sizes)), sample_words // len(sizes)
    # texts by hash before the exact cut, so that the window holds few: eight times as many as are wanted
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, (8 * each + 100) / n) * 2**31))])
    n = F.greatest(F.regexp_count("text", F.lit(r"\p{L}+")), F.ceil(F.length("text") / 8))
    near = known.where(F.pmod("h", F.lit(2**31)) < share[F.col("lang")]).groupBy("lang", "h").agg(F.max(n).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    left, chosen = dict.fromkeys(sizes, words_each), []
    for r in near.withColumn("place", place).where(F.col("place") <= each).orderBy("lang", "h").collect():  # sample_docs rows of numbers
        if r["n"] <= left[r["lang"]]:
            left[r["lang"]] -= r["n"]
            chosen.append((r["lang"], r["h"]))
    if not chosen:
        return []

    @F.pandas_udf("array<string>")
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.llm.language import words_of as words

        for s in parts:
            yield pd.Series([words(t) for t in s])

    wanted = F.broadcast(spark.createDataFrame(chosen, "lang string, h long"))  # sample_docs rows at most
    rows = known.join(wanted, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "h", cut("text").alias("w")).orderBy("lang", "h").collect()
    return [(r["lang"], list(r["w"][k : k + span])) for r in rows for k in range(0, len(r["w"]), span)]


def train(docs: DataFrame, **bounds) -> Crf:
    """A model from docs (lang, text); cases and ``bounds`` as in sample_spans()."""
    return fit(sample_spans(docs, **bounds))


def labelled(docs: DataFrame, model: Crf, text_col: str = "text", out_col: str = "language", spans: bool = False) -> DataFrame:
    """docs with a further struct column: ``lang`` (``und`` for null texts and texts without a letter), ``score`` (0 to 1)
    and with ``spans`` the runs of words by language (lang, first, words). Only the text is looked at.

    Repeated rows are labelled alike; an empty table stays empty; a model that has seen no language says ``und``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS, LEXICON and the number of languages
    kind = "lang string, score double" + ", spans array<struct<lang:string,first:int,words:int>>" * spans

    @F.pandas_udf(kind)
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm import language  # noqa: F401

        crf = held.value
        for s in parts:
            yield pd.DataFrame(crf.label(s, spans), columns=["lang", "score", "spans"][: 2 + spans])

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out_col], of(F.col(f"`{text_col}`")).alias(out_col))


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 4) == 2
