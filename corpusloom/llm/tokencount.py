"""Edit-aware token counts: a segment tree of pre-tokens per document.

The leaves hold runs of ``LEAF`` pre-tokens with their code points and tokens; inner nodes hold sums,
so the total is at the root and the leaf of a position is found in logarithmic time.  An edit
re-splits from the start of the leaf that lies ``BEFORE`` code points before it (the pattern looks
ahead by fewer) until a new boundary meets an old one at the end of a leaf; from there on the
split can't differ, since the pattern never looks back.  Only that region is split and encoded anew,
and the sums above its leaves are updated.  A leaf that has grown ``GROWN`` times is dealt out anew,
without encoding.

The operator works row by row and needs no shuffle.  Defined results: null text counts as empty;
positions beyond the end are the end, and an end before its start is its start; null edits are none.
Edits apply one after another, each to the text that the one before has left.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .bpe import load_ranks, public_vocabulary
from .common import small_batches, table

LEAF, BEFORE, GROWN = 16, 4, 8
REMEMBER = 350_000


class Counter:
    """Splits text into pre-tokens and counts the tokens of each; remembers counts, in two generations."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.find: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.encode = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _count(self, piece: str) -> int:
        n = self.older.get(piece) or len(self.encode(piece))
        if len(piece) <= 64:
            if len(self.known) >= REMEMBER:
                self.older, self.known = self.known, {}
            self.known[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known.get
        return [known(x) or self._count(x) for x in pieces]


class TokenTree:
    """Token counts of one text that may be edited."""

    def __init__(self, counter: Counter, text: str = "", pieces: list[str] | None = None, tokens: list[int] | None = None):
        self.counter = counter
        self.recoded = 0
        pieces = counter.find(text) if pieces is None else pieces
        self._deal(pieces, counter.counts(pieces) if tokens is None else tokens)

    def _deal(self, pieces: list[str], tokens: list[int]) -> None:
        self.pieces = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.tokens = [tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF)] or [[]]
        self.cap = 1 << (len(self.pieces) - 1).bit_length()
        self.chars_sum, self.tokens_sum = [0] * (2 * self.cap), [0] * (2 * self.cap)
        for i, (p, t) in enumerate(zip(self.pieces, self.tokens, strict=True)):
            self.chars_sum[self.cap + i], self.tokens_sum[self.cap + i] = sum(map(len, p)), sum(t)
        for i in range(self.cap - 1, 0, -1):
            self.chars_sum[i] = self.chars_sum[2 * i] + self.chars_sum[2 * i + 1]
            self.tokens_sum[i] = self.tokens_sum[2 * i] + self.tokens_sum[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens_sum[1]

    @property
    def chars(self) -> int:
        return self.chars_sum[1]

    def text(self) -> str:
        return "".join(x for p in self.pieces for x in p)

    def state(self) -> tuple[list[int], list[int]]:
        """Code points and tokens of each pre-token, from which restore() makes the tree again."""
        return [len(x) for p in self.pieces for x in p], [n for t in self.tokens for n in t]

    @classmethod
    def restore(cls, counter: Counter, text: str, chars: list[int], tokens: list[int]) -> TokenTree:
        """The tree of a text whose state is known; nothing is split or encoded."""
        at = np.concatenate([[0], np.cumsum(chars)]).astype(int).tolist()
        return cls(counter, pieces=[text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], tokens=list(tokens))

    def _leaf(self, position: int) -> tuple[int, int]:
        """Leaf that holds the code point at a position (the last leaf beyond the end), and the leaf's start."""
        node, before = 1, 0
        while node < self.cap:
            node *= 2
            if position - before >= self.chars_sum[node] and self.chars_sum[node + 1]:
                before += self.chars_sum[node]
                node += 1
        return node - self.cap, before

    def _set(self, leaf: int, pieces: list[str], tokens: list[int]) -> None:
        self.pieces[leaf], self.tokens[leaf] = pieces, tokens
        node = self.cap + leaf
        self.chars_sum[node], self.tokens_sum[node] = sum(map(len, pieces)), sum(tokens)
        while node > 1:
            node //= 2
            self.chars_sum[node] = self.chars_sum[2 * node] + self.chars_sum[2 * node + 1]
            self.tokens_sum[node] = self.tokens_sum[2 * node] + self.tokens_sum[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Put new in place of the code points from start to end."""
        start = max(0, min(start, self.chars))
        end = max(start, min(end, self.chars))
        first, begin = self._leaf(max(0, start - BEFORE))
        last, _ = self._leaf(end)
        read = lambda leaf: "".join(self.pieces[leaf])
        region = "".join(read(i) for i in range(first, last + 1))
        region = region[: start - begin] + new + region[end - begin :]
        while True:
            following = last + 1
            while following < len(self.pieces) and not self.pieces[following]:
                following += 1
            ahead = read(following) if following < len(self.pieces) else ""
            found, size = [], 0
            for piece in self.counter.find(region + ahead):
                if size >= len(region):
                    break
                found.append(piece)
                size += len(piece)
            if size == len(region) or not ahead:
                break
            region, last = region + ahead, following
        self.recoded += len(found)
        tokens = self.counter.counts(found)
        share = -(-len(found) // (last - first + 1)) or 1
        for i in range(first, last + 1):
            a = (i - first) * share
            self._set(i, found[a : a + share], tokens[a : a + share])
        if share > GROWN * LEAF:
            self._deal([x for p in self.pieces for x in p], [n for t in self.tokens for n in t])


_made: dict[tuple[str, str], Counter] = {}


def release() -> None:
    """Drop this worker's caches (a function of the module, so that tasks mean the worker's own and no pickled copy)."""
    _made.clear()


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _made:
        _made[path, pattern] = Counter(path, pattern)
    return _made[path, pattern]


EDITS = "array<struct<start:bigint,stop:bigint,new:string>>"


def _fields(df: DataFrame, keep: list[str]) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]


def trees(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """df with n_tokens and the state of each text's tree: piece_chars and piece_tokens."""
    small_batches(df.sparkSession)
    new = ["n_tokens", "piece_chars", "piece_tokens"]
    keep = [c for c in df.columns if c not in new]
    which = keep.index(text)

    def run(batches):
        K.own("tokencount", release)
        own = counter(path, pattern)
        for batch in batches:
            made = [TokenTree(own, x or "") for x in batch.column(which).to_pylist()]
            state = [t.state() for t in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.total for t in made], pa.int64()), *(pa.array([s[i] for s in state], pa.list_(pa.int32())) for i in (0, 1))], names=[*keep, *new])

    return df.select(*keep).mapInArrow(run, ", ".join([*_fields(df, keep), "n_tokens bigint, piece_chars array<int>, piece_tokens array<int>"]))


def apply_edits(kept: DataFrame, path: str, pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Trees (as trees() gives them, with a column of edits) after these: text, state and n_tokens anew, n_recoded added."""
    new = [text, "n_tokens", "piece_chars", "piece_tokens", "n_recoded"]
    keep = [c for c in kept.columns if c not in {*new, edits}]

    def run(batches):
        K.own("tokencount", release)
        own = counter(path, pattern)
        for batch in batches:
            out = []
            for x, chars, tokens, changes in zip(*(batch.column(len(keep) + i).to_pylist() for i in range(4)), strict=True):
                tree = TokenTree.restore(own, x or "", chars, tokens)
                for c in changes or []:
                    tree.edit(c["start"], c["stop"], c["new"] or "")
                out.append((tree.text(), tree.total, *tree.state(), tree.recoded))
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))], names=[*keep, *new])

    shape = ", ".join([*_fields(kept, keep), f"`{text}` string, n_tokens bigint, piece_chars array<int>, piece_tokens array<int>, n_recoded bigint"])
    return kept.select(*keep, text, "piece_chars", "piece_tokens", F.col(edits).cast(EDITS)).mapInArrow(run, shape)


def count_edits(df: DataFrame, path: str, pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """df without text and edits, with tokens before and after the edits, pre-tokens, and how many were split anew."""
    small_batches(df.sparkSession)
    new = ["n_pieces", "n_tokens", "n_recoded", "n_tokens_after", "n_chars_after"]
    keep = [c for c in df.columns if c not in {text, edits, *new}]

    def run(batches):
        K.own("tokencount", release)
        own = counter(path, pattern)
        for batch in batches:
            out = []
            for x, changes in zip(*(batch.column(len(keep) + i).to_pylist() for i in range(2)), strict=True):
                tree = TokenTree(own, x or "")
                row = [sum(map(len, tree.pieces)), tree.total]
                for c in changes or []:
                    tree.edit(c["start"], c["stop"], c["new"] or "")
                out.append((*row, tree.recoded, tree.total, tree.chars))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array([r[i] for r in out], pa.int64()) for i in range(5))], names=[*keep, *new])

    shape = ", ".join([*_fields(df, keep), *(f"{c} bigint" for c in new)])
    return df.select(*keep, text, F.col(edits).cast(EDITS)).mapInArrow(run, shape)


def sample_edits(text: Column) -> Column:
    """Three edits for a text of n code points: a replacement at n/4, an insertion at n/2, a deletion at 3n/4."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")
    at = lambda k: F.floor(n * k / 4).cast("long")
    edit = lambda a, b, x: F.struct(a.alias("start"), b.alias("stop"), F.lit(x).alias("new"))
    return F.array(edit(at(1), at(1) + 7, "Edited 42 times"), edit(at(2), at(2), "\n\n'twas "), edit(at(3), at(3) + 12, ""))


def op8_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after the edits of sample_edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edits(docs.withColumn("edits", sample_edits(F.col("text"))), *public_vocabulary())
