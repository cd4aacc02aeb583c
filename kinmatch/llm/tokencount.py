"""Edit-aware token counts over per-document segment trees.

A text is cut into pre-tokens by the tokenizer's expression; byte-pair merges never cross them, so a text's token count
is the sum over its pre-tokens. A document keeps the lengths and counts of its pre-tokens in blocks, under a segment
tree with sums of characters and tokens. An edit (characters start to end replaced by a text) descends to its block by
characters, cuts and counts anew from two pre-tokens before the edit until a boundary behind it falls on an old
boundary, puts the new pre-tokens in, and updates the sums on the way to the root.

Why two: matching looks ahead over the end of a pre-token by two characters at most (a white-space run gives its last
character to the next word; a contraction needs two letters), never back. So what ends two pre-tokens before the
edit's neighbourhood cannot change, and from an old boundary behind the edit everything comes out as before.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm.base import ship

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RANKS_SETTING = "spark.kinmatch.tokens.ranks"
#: The pre-token expression that the vocabulary was made with. Fixed value of the published tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK, CACHE_WORDS, BACK = 64, 400_000, 2


class Counter:
    """Pre-tokens of a text and their token counts."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}  # the pre-tokens of late,
        self.older: dict[str, int] = {}  # and those from before

    def count(self, pre_token: str) -> int:
        n = self.known.get(pre_token) or self.older.get(pre_token)
        if n is None:
            n = len(self.encoding.encode_ordinary(pre_token))
        if len(pre_token) <= 64:
            if len(self.known) >= CACHE_WORDS // 2:
                self.known, self.older = {}, self.known
            self.known[pre_token] = n
        return n

    def leaves(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and token counts of a text's pre-tokens."""
        found = self.pattern.findall(text or "")
        return np.fromiter(map(len, found), np.int32, len(found)), np.fromiter(map(self.count, found), np.int32, len(found))


class TokenTree:
    def __init__(self, text: str, lens: np.ndarray, counts: np.ndarray):
        self.text, self.reencoded = text, 0
        self._build(lens, counts)

    def _build(self, lens: np.ndarray, counts: np.ndarray) -> None:
        cuts = range(0, max(1, len(lens)), BLOCK)
        self.blocks = [(lens[k : k + BLOCK], counts[k : k + BLOCK]) for k in cuts]
        self.size = 1 << max(0, len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * 2 * self.size, [0] * 2 * self.size
        for k, (a, b) in enumerate(self.blocks):
            self.chars[self.size + k], self.tokens[self.size + k] = int(a.sum()), int(b.sum())
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        for s in (self.chars, self.tokens):
            s[node] = s[2 * node] + s[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate([b[k] for b in self.blocks]) for k in (0, 1))

    def _at(self, pos: int) -> tuple[int, int, int]:
        """Block, place in it and first character of the pre-token that holds a character; (0, 0, 0) in an empty text."""
        node, left = 1, min(pos, max(0, self.chars[1] - 1))
        start = left
        while node < self.size:
            node *= 2
            if left >= self.chars[node]:
                left -= self.chars[node]
                node += 1
        b = node - self.size
        if b >= len(self.blocks) or not len(self.blocks[b][0]):
            return 0, 0, 0
        upto = np.cumsum(self.blocks[b][0])
        k = int(np.searchsorted(upto, left, side="right"))
        return b, k, start - left + (int(upto[k - 1]) if k else 0)

    def _before(self, b: int, k: int, pos: int) -> tuple[int, int, int]:
        while k == 0 and b > 0:
            b -= 1
            k = len(self.blocks[b][0])
        return (b, k - 1, pos - int(self.blocks[b][0][k - 1])) if k else (b, 0, pos)

    def edit(self, start: int, end: int, new: str, counter: Counter) -> None:
        """Replaces characters start to end (clipped to the text) by ``new``."""
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        text = self.text[:start] + new + self.text[end:]
        b, k, pos = self._at(max(0, start - 1))
        for _ in range(BACK):
            b, k, pos = self._before(b, k, pos)
        first, shift, behind = (b, k), len(new) - (end - start), start + len(new)
        lens, counts = [], []
        old = pos  # an old boundary, before pre-token k of block b
        for m in counter.pattern.finditer(text, pos):
            s = m.start()
            if s >= behind:
                while old < s - shift and b < len(self.blocks):
                    if k < len(self.blocks[b][0]):
                        old += int(self.blocks[b][0][k])
                        k += 1
                    else:
                        b, k = b + 1, 0
                if old == s - shift:
                    break
            lens.append(len(m.group()))
            counts.append(counter.count(m.group()))
        else:
            b, k = len(self.blocks) - 1, len(self.blocks[-1][0])
        if b >= len(self.blocks):
            b, k = len(self.blocks) - 1, len(self.blocks[-1][0])
        self.reencoded += len(lens)
        self.text = text
        (b0, k0), parts = first, []
        for i, x in ((0, lens), (1, counts)):
            parts.append(np.concatenate([self.blocks[b0][i][:k0], np.array(x, dtype=np.int32), self.blocks[b][i][k:]]))
        for j in range(b0, b + 1):
            self.blocks[j] = tuple(parts) if j == b0 else (parts[0][:0], parts[1][:0])
        if len(parts[0]) > 8 * BLOCK:
            self._build(*self.leaves())
            return
        for j in range(b0, b + 1):
            node = self.size + j
            self.chars[node], self.tokens[node] = int(self.blocks[j][0].sum()), int(self.blocks[j][1].sum())
        nodes = {(self.size + j) // 2 for j in range(b0, b + 1)}
        while nodes and max(nodes) >= 1:
            for node in nodes:
                self._sum(node)
            nodes = {x // 2 for x in nodes if x > 1}


    def edit_all(self, edits, counter: Counter) -> None:
        for e in () if edits is None else edits:
            if e is not None and e["start"] is not None and e["end"] is not None:
                self.edit(int(e["start"]), int(e["end"]), e["new"] or "", counter)


_loaded: dict[bytes, Counter] = {}


def load(ranks: bytes) -> Counter:
    """The counter for a rank file's bytes; a worker process keeps the last."""
    if ranks not in _loaded:
        _loaded.clear()
        _loaded[ranks] = Counter(ranks)
    return _loaded[ranks]


def _ranks(spark: SparkSession, path: str | None):
    """The rank file's bytes (under a MB) for all executors; only the driver reads the file."""
    with open(path or spark.conf.get(RANKS_SETTING, RANKS), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


LEAVES = "lens array<int>, counts array<int>"


def trees(docs: DataFrame, text_col: str = "text", tree_col: str = "token_tree", ranks: str | None = None) -> DataFrame:
    """docs with a further column, a struct of the lengths and token counts of the text's pre-tokens (the leaves of its
    tree), in place of one of that name. Null and empty texts have no leaves."""
    ship(docs.sparkSession, small_batches=True)
    held = _ranks(docs.sparkSession, ranks)

    @F.pandas_udf(LEAVES)
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.tokencount import load as get

        counter = get(held.value)
        for s in parts:
            yield pd.DataFrame([counter.leaves(t) for t in s], columns=["lens", "counts"])

    return _with(docs, tree_col, of(F.col(f"`{text_col}`")))


def edited(docs: DataFrame, edits_col: str = "edits", text_col: str = "text", tree_col: str = "token_tree", out_col: str = "edited", ranks: str | None = None) -> DataFrame:
    """docs with a further struct column: the text after its edits, its tree's leaves, ``n_tokens`` before and
    ``n_tokens_after``, and ``n_reencoded``, the pre-tokens that were counted for the edits.

    ``edits_col``: array of struct start, end, new (code points of the text as it is when the edit's turn comes), done in
    order; ends outside the text are clipped, null edits skipped, a null ``new`` is empty. A null text stays null and has
    no tokens. Repeated rows are edited each; an empty table stays empty.
    """
    ship(docs.sparkSession, small_batches=True)
    held = _ranks(docs.sparkSession, ranks)

    @F.pandas_udf(f"text string, {LEAVES}, n_tokens long, n_tokens_after long, n_reencoded long")
    def of(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.tokencount import TokenTree as Tree
        from kinmatch.llm.tokencount import load as get

        counter, none = get(held.value), np.zeros(0, np.int32)
        for texts, leaf, edits in parts:
            out = []
            for text, lens, counts, todo in zip(texts, leaf["lens"], leaf["counts"], edits, strict=True):
                if text is None:
                    out.append((None, none, none, 0, 0, 0))
                    continue
                tree = Tree(text, lens, counts)
                before = tree.n_tokens
                tree.edit_all(todo, counter)
                out.append((tree.text, *tree.leaves(), before, tree.n_tokens, tree.reencoded))
            yield pd.DataFrame(out, columns=["text", "lens", "counts", "n_tokens", "n_tokens_after", "n_reencoded"])

    tree = F.struct(F.col(f"`{tree_col}`")["lens"].alias("lens"), F.col(f"`{tree_col}`")["counts"].alias("counts"))
    return _with(docs, out_col, of(F.col(f"`{text_col}`"), tree, F.col(f"`{edits_col}`")))


def recounted(docs: DataFrame, edits_col: str = "edits", text_col: str = "text", out_col: str = "counted", ranks: str | None = None) -> DataFrame:
    """trees() and edited() in one pass, for trees that needn't be kept: docs with a further struct column of
    ``n_pretokens``, ``n_tokens``, ``n_tokens_after`` and ``n_reencoded``. Cases as in edited()."""
    ship(docs.sparkSession, small_batches=True)
    held = _ranks(docs.sparkSession, ranks)
    names = ["n_pretokens", "n_tokens", "n_tokens_after", "n_reencoded"]

    @F.pandas_udf(", ".join(f"{c} long" for c in names))
    def of(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.tokencount import TokenTree as Tree
        from kinmatch.llm.tokencount import load as get

        counter = get(held.value)
        for texts, edits in parts:
            out = []
            for text, todo in zip(texts, edits, strict=True):
                lens, counts = counter.leaves(text)
                tree = Tree(text or "", lens, counts)
                before = tree.n_tokens
                if text is not None:
                    tree.edit_all(todo, counter)
                out.append((len(lens), before, tree.n_tokens, tree.reencoded))
            yield pd.DataFrame(out, columns=names)

    return _with(docs, out_col, of(F.col(f"`{text_col}`"), F.col(f"`{edits_col}`")))


def _with(docs: DataFrame, name: str, value: Column) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name], value.alias(name))


def revision(doc_id: Column, text: Column) -> Column:
    """A revision of a document as edits: a word in the middle struck out, a number put in at a place that depends on the
    id, the first letters replaced, a line added."""
    n = F.length(text)
    at = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), n + 1).cast("int")

    def one(start: Column, end: Column, new: str) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(new).alias("new"))

    return F.array(one(F.floor(n / 2), F.floor(n / 2) + 7, ""), one(at, at, " 1234 we'll"), one(F.lit(0), F.lit(3), "A new"), one(n + 100, n + 100, "\n\nRevised."))
