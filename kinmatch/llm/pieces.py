"""SentencePiece encoding and decoding by a streaming Viterbi pass.

Over the positions of a text a lattice of pieces is searched from left to right; every position keeps its best way in as
one backpointer, and only a window as long as the longest piece is retained. As soon as the backpointer paths of all
positions in the window go through one boundary, everything before it is committed and forgotten, so memory doesn't
grow with the text.

Two kinds of models fix what the best way is:
  * unigram: the highest sum of piece scores.
  * BPE: merges must come out in the order of the piece scores. A segmentation is the merges' result if and only if
    merging each pair of neighbours on its own gives back that pair. So a way into a position is open only if its last
    two pieces are such a pair, exactly one way is open for each prefix, and it is the model's own segmentation.

Where no piece has a space mark after another character, every path goes through the boundary before each mark that
follows another character, and around each character that is in no longer piece, and between two that are side by side in
no piece. A pass from one such boundary to the next depends on nothing else, so what it commits is remembered by its
characters in a bounded cache; each stretch that isn't remembered goes through the streaming pass, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.base import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_SETTING = "spark.kinmatch.pieces.model"
#: Sizes of what a worker remembers: words, pairs of pieces, and the longest word that is remembered (memory only).
CACHE_WORDS, CACHE_PAIRS, KEPT, ROWS, CUT = 400_000, 500_000, 64, 500, 1 << 20
SPACE = "▁"
_NONE: dict = {}


class Pieces:
    """A model's pieces, with encode and decode."""

    def __init__(self, model: bytes, bpe: bool | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)  # reads the model; encoding and decoding are done here
        n = sp.vocab_size()
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.id = {p: i for i, p in enumerate(self.piece) if not special(i)}
        self.score = [sp.get_score(i) for i in range(n)]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if sp.is_byte(i)}
        self.byte_value = {i: b for b, i in self.byte.items()}
        self.unk = sp.unk_id()
        self.control = {i for i in range(n) if sp.is_control(i)}
        #: unigram scores are log probabilities, BPE scores are minus the merge's rank: whole numbers
        self.bpe = all(s == int(s) for s in self.score) if bpe is None else bpe
        self.prefix = sp.encode("a", out_type=str)[0].startswith(SPACE)
        self.longest = max(map(len, self.id))
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p in self.id)
        self.worst = min(self.score[i] for i in self.id.values()) - 10
        self.inside = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        in_pieces = {c for p in self.id if len(p) > 1 for c in p}
        alone = {c for c in map(chr, range(128)) if c not in in_pieces}  # never share a piece
        latin, new = set(), {"e"}  # the characters that are linked to a letter by being side by side in pieces
        beside: dict[str, set[str]] = {}
        for x, y in self.inside:
            beside.setdefault(x, set()).add(y)
            beside.setdefault(y, set()).add(x)
        while new:
            latin |= new
            new = {y for x in new for y in beside.get(x, ())} - latin - {SPACE}
        a, s = re.escape("".join(sorted(alone - latin))), re.escape("".join(sorted(latin)))
        self.word = re.compile(f"{SPACE}*[{s}]+|{SPACE}*[^{SPACE}{a}{s}]+|{SPACE}+" + f"|[{a}]" * bool(a))
        self.trie: dict = {}  # by character; "" holds the id of the piece that ends there
        for p, i in self.id.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.begin = re.compile(f"[^{SPACE}]{SPACE}")
        #: what each id stands for; None for a byte that is no character of its own
        self.said = ["" if i in self.control else " \u2047 " if i == self.unk else (chr(b) if (b := self.byte_value[i]) < 128 else None) if i in self.byte_value else p.replace(SPACE, " ") for i, p in enumerate(self.piece)]
        self.words: dict[str, tuple[int, ...]] = {}  # the words of late,
        self.older: dict[str, tuple[int, ...]] = {}  # and those from before
        self.parts: dict[str, tuple[int, ...]] = {}
        self.parts_before: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.seen = 0  # characters that went through commits()

    def merged(self, s: str) -> list[str]:
        """Pieces of a short string by merging the best neighbours again and again, the first of equals."""
        parts, ids, score = list(s), self.id, self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def joins(self, a: int, b: int) -> bool:
        """Whether merging pieces a and b side by side leaves the two."""
        if self.n_pairs >= CACHE_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        x, y = self.piece[a], self.piece[b]
        got = self.pairs.setdefault(a, {})[b] = self.merged(x + y) == [x, y]
        return got

    def commits(self, text: str) -> Iterator[list[tuple[int, int, int]]]:
        """The text's pieces (start, end, id; id -1 for a character without a piece) in committed groups. What is kept are
        the ways into the positions of one window."""
        ids, root, joins, score, bpe, worst, pairs = self.id, self.trie, self.joins, self.score, self.bpe, self.worst, self.pairs
        self.seen += len(text)
        longest = self.longest
        into, total, done, n = {0: (0, -1)}, {0: 0.0}, 0, len(text)  # for each position that can be reached: the best way's last piece, its score
        for j in range(n):
            before = into.get(j)
            if before is None:
                continue
            a = before[1]  # -1 at the start and after a character without a piece: everything joins
            row = pairs.get(a, _NONE)
            node, i = root, j
            for c in text[j : j + longest]:
                node = node.get(c)
                if node is None:
                    break
                i += 1
                if bpe and i in into:  # no second way is open
                    continue
                k = node.get("")
                if k is None:
                    continue
                if bpe:
                    if a < 0 or (row[k] if k in row else joins(a, k)):
                        into[i] = (j, k)
                elif i not in into or total[j] + score[k] > total[i]:
                    into[i], total[i] = (j, k), total[j] + score[k]
            if text[j] not in ids:
                if bpe:
                    into.setdefault(j + 1, (j, -1))
                elif j + 1 not in into or total[j] + worst > total[j + 1]:
                    into[j + 1], total[j + 1] = (j, -1), total[j] + worst
            if (j + 1) % longest == 0 and j + 1 < n:
                ends = {x for x in into if x > j}  # ways into these are all that go on
                while len(ends) > 1:  # back along them to the boundary that they share
                    x = max(ends)
                    ends.remove(x)
                    ends.add(into[x][0] if x > done else done)
                to = max(ends.pop(), done)
                if to > done:
                    yield self._path(into, done, to)
                    for x in [x for x in into if x < to]:
                        del into[x]
                        total.pop(x, None)
                    done = to
        yield self._path(into, done, n)

    def stream(self, text: str) -> Iterator[list[str]]:
        """The text's pieces in committed groups; characters without a piece stand for themselves."""
        for group in self.commits(text):
            yield [text[x:y] for x, y, _ in group]

    def _path(self, into: dict[int, tuple[int, int]], start: int, end: int) -> list[tuple[int, int, int]]:
        out = []
        while end > start:
            at, k = into[end]
            out.append((at, end, k))
            end = at
        return out[::-1]

    def _ids(self, piece: str) -> tuple[int, ...]:
        k = self.id.get(piece)
        if k is not None:
            return (k,)
        return tuple(self.byte[b] for b in piece.encode("utf-8", "surrogatepass")) if self.byte else (self.unk,)

    def segment_ids(self, s: str) -> tuple[int, ...]:
        """Ids of a stretch that every path begins and ends at, by one streaming pass."""
        out: list[int] = []
        for group in self.commits(s):
            for x, y, k in group:
                if k >= 0:
                    out.append(k)
                else:
                    out += self._ids(s[x:y])
        return tuple(out)

    def _word(self, w: str) -> tuple[int, ...]:
        """Ids of a word that isn't among those of late. It is cut wherever no piece has the two characters side by side."""
        ids = self.older.get(w)
        if ids is None:
            inside, at, ids = self.inside, 0, ()
            for k in range(1, len(w)):
                if w[k - 1 : k + 1] not in inside:
                    ids += self._part(w[at:k])
                    at = k
            ids += self._part(w[at:]) if at else self.segment_ids(w)  # an uncut word is remembered once, as a word
        if len(w) <= KEPT:
            if len(self.words) >= CACHE_WORDS // 2:
                self.words, self.older = {}, self.words
            self.words[w] = ids
        return ids

    def _part(self, s: str) -> tuple[int, ...]:
        ids = self.parts.get(s)
        if ids is None:
            ids = self.parts_before.get(s) or self.segment_ids(s)
            if len(s) <= KEPT:
                if len(self.parts) >= CACHE_WORDS // 2:
                    self.parts, self.parts_before = {}, self.parts
                self.parts[s] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; none for null and empty."""
        if not text:
            return []
        marked = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        if not self.by_word:
            return list(self.segment_ids(marked))
        out: list[int] = []
        end = 0
        while end < len(marked):  # about CUT characters at a time, up to where a word begins
            start, end = end, self._boundary(marked, end + CUT)
            found = self.word.findall(marked, start, end)
            got = list(map(self.words.get, found))
            if None in got:
                got = [self._word(w) if x is None else x for w, x in zip(found, got, strict=True)]
            out += chain.from_iterable(got)
        return out

    def _boundary(self, marked: str, at: int) -> int:
        """The first place from ``at`` on where a word begins with a mark, or the end."""
        m = self.begin.search(marked, at)
        return m.start() + 1 if m else len(marked)

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD each."""
        found = list(map(self.said.__getitem__, ids))
        if None in found:  # parts of characters
            out, raw = [], bytearray()
            for i, x in zip(ids, found, strict=True):
                b = self.byte_value.get(i)
                if b is not None:
                    raw.append(b)
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw = bytearray()
                out.append(x)
            found = [*out, raw.decode("utf-8", "replace")]
        text = "".join(found)
        return text[1:] if self.prefix and text.startswith(" ") else text


_loaded: dict[bytes, Pieces] = {}


def load(model: bytes) -> Pieces:
    """The pieces of a model file's bytes; a worker process keeps the last model."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = Pieces(model)
    return _loaded[model]


def _model(spark, path: str | None):
    """The model's bytes (some hundred kB) for all executors; only the driver reads the file."""
    with open(path or spark.conf.get(MODEL_SETTING, MODEL), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", model: str | None = None, check_col: str | None = None) -> DataFrame:
    """docs with a further column of the texts' piece ids (array of int), in place of one of that name, and with
    ``check_col`` one that tells whether decoding them gives the text back.

    Null and empty texts have no ids. Repeated rows are encoded alike; an empty table stays empty. ``model``: path of a
    SentencePiece model whose normaliser changes nothing but spaces; the session's spark.kinmatch.pieces.model if not given.
    """
    ship(docs.sparkSession, small_batches=True)
    held = _model(docs.sparkSession, model)

    @F.pandas_udf("ids array<int>, same boolean")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from kinmatch.llm.pieces import load as get

        own = get(held.value)
        for s in parts:
            for k in range(0, len(s), ROWS):  # a few rows' ids at a time
                texts = s.iloc[k : k + ROWS]
                ids = [own.encode(t) for t in texts]
                same = [own.decode(x) == (t or "") for x, t in zip(ids, texts, strict=True)] if check_col else None
                yield pd.DataFrame({"ids": [np.array(x, dtype=np.int32) for x in ids], "same": same})

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), of(F.col(f"`{text_col}`")).alias("__p"))
    new = [F.col("__p.ids").alias(ids_col)] + ([F.col("__p.same").alias(check_col)] if check_col else [])
    return out.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns if c not in (ids_col, check_col)], *new)


def decoded(docs: DataFrame, ids_col: str = "piece_ids", text_col: str = "decoded", model: str | None = None) -> DataFrame:
    """docs with a further column of the ids' texts, in place of one of that name.

    Null ids give null, no ids the empty text; long lists are decoded whole, repeated rows alike; an empty table stays
    empty."""
    ship(docs.sparkSession, small_batches=True)
    held = _model(docs.sparkSession, model)

    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from kinmatch.llm.pieces import load as get

        decode = get(held.value).decode
        for s in parts:
            yield pd.Series([None if x is None else decode(x.tolist()) for x in s], dtype=object)

    return _with(docs, text_col, of(F.col(f"`{ids_col}`")))


def _with(docs: DataFrame, name: str, value: Column) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name], value.alias(name))
