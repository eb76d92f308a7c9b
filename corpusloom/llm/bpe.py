"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by the pre-token pattern; each pre-token is merged by itself.  Its bytes form a
linked list.  Every adjacent pair that has a rank is put, by position, into the bucket of its rank;
a bitmap in two levels marks which buckets hold anything, so the lowest rank is found by two
find-first-set steps, however long the pre-token is.  A popped bucket is worked off from left to
right; an entry whose pair has changed since is stale and skipped.  The cost is about linear in the
pre-token (the sort of each bucket aside), where scanning for the lowest rank is quadratic.

Merged pre-tokens are remembered per worker, short ones only, in two generations of up to
``REMEMBER``; the memory thus stays bounded and results don't depend on it.

Defined results: null text encodes as empty text; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, table

REMEMBER, SHORT = 350_000, 64
BITS = 8
LOW = (1 << BITS) - 1
_NONE: dict[int, int] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.byte = [ranks[bytes([i])] for i in range(256)]
        size = max(ranks.values()) + 1
        #: right[a][b] is the rank of the pair (a, b); most tokens begin no pair and share one empty table.
        self.right: list[dict[int, int]] = [_NONE] * size
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    if self.right[a] is _NONE:
                        self.right[a] = {}
                    self.right[a][b] = rank
        #: the lower level of the bitmap; all zero between calls, since a merge empties its queue
        self.words = [0] * ((size >> BITS) + 1)
        self.masks = [1 << i for i in range(max(LOW + 1, len(self.words)))]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        self.length = np.zeros(size, np.int64)
        for token, rank in by_id:
            self.length[rank] = len(token)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(token for token, _ in by_id), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by the rank queue."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        right, words, masks, byte = self.right, self.words, self.masks, self.byte
        ids = [byte[x] for x in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, list[int]] = {}
        top = 0
        for i in range(n - 1):
            r = right[ids[i]].get(ids[i + 1])
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> BITS
                    words[w] |= masks[r & LOW]
                    top |= masks[w]
        while top:
            lowest = top & -top
            w = lowest.bit_length() - 1
            word = words[w]
            bit = word & -word
            rank = w << BITS | bit.bit_length() - 1
            words[w] = word = word ^ bit
            if not word:
                top ^= lowest
            todo = buckets.pop(rank)
            if len(todo) > 1:
                todo.sort()
            for k, i in enumerate(todo):
                j = after[i]
                if j >= n or ids[i] < 0 or right[ids[i]].get(ids[j]) != rank:
                    continue  # stale
                ids[i], ids[j] = rank, -1
                q = after[i] = after[j]
                lower = False
                p = before[i]
                if p >= 0:
                    r = right[ids[p]].get(rank)
                    if r is not None:
                        lower = r < rank
                        if r in buckets:
                            buckets[r].append(p)
                        else:
                            buckets[r] = [p]
                            w = r >> BITS
                            words[w] |= masks[r & LOW]
                            top |= masks[w]
                if q < n:
                    before[q] = i
                    r = right[rank].get(ids[q])
                    if r is not None:
                        lower |= r < rank
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            w = r >> BITS
                            words[w] |= masks[r & LOW]
                            top |= masks[w]
                if lower and k + 1 < len(todo):  # the rest waits: a lower rank goes first
                    buckets[rank] = todo[k + 1 :]
                    w = rank >> BITS
                    words[w] |= masks[rank & LOW]
                    top |= masks[w]
                    break
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            ids = self.merge(piece.encode())
            found = struct.pack(f"<{len(ids)}i", *ids)
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBER:
                self.older, self.known = self.known, {}
            self.known[piece] = found
        return found

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        known, piece = self.known.get, self._piece
        return b"".join([known(x) or piece(x) for x in self.find(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode_many(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and bounds of the documents whose ids lie between the bounds off."""
        n = self.length[ids]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        source = np.repeat(self.start[ids] - (end - n), n) + np.arange(total)
        return self.bytes[source], np.concatenate([[0], end])[off]

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_many(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0].tobytes()


_made: dict[tuple[str, str], Tokenizer] = {}


def release() -> None:
    """Drop this worker's caches (a function of the module, so that tasks mean the worker's own and no pickled copy)."""
    _made.clear()


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One per worker and vocabulary."""
    if (path, pattern) not in _made:
        _made[path, pattern] = Tokenizer(load_ranks(path), pattern)
    return _made[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """df without text, with the ids of its text; with decoded, also the bytes that these ids stand for.

    A column of df called like a new one is replaced.
    """
    small_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in {text, ids, decoded}]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), f"`{ids}` array<int>", *([f"`{decoded}` binary"] if decoded else [])])

    def run(batches):
        K.own("bpe", release)
        t = tokenizer(path, pattern)
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # a few MB of text at a time
                part = batch.slice(at, 128)
                at += part.num_rows
                coded = [t.encode_bytes(x) if x else b"" for x in part.column(part.num_columns - 1).to_pylist()]
                off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
                flat = np.frombuffer(b"".join(coded), np.int32)
                made = [pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()))]
                if decoded:
                    data, bounds = t.decode_many(flat, off)
                    made.append(pa.Array.from_buffers(pa.binary(), len(coded), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*keep, ids, *([decoded] if decoded else [])])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the bytes that its ids stand for; null ids give empty bytes."""
    keep = [c for c in df.columns if c != out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), f"`{out}` binary"])
    which = keep.index(ids)

    def run(batches):
        K.own("bpe", release)
        t = tokenizer(path, pattern)
        for batch in batches:
            made = [t.decode(x or []) for x in batch.column(which).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*keep, out])

    return df.select(*keep).mapInArrow(run, schema)


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def public_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode(docs, *public_vocabulary(), decoded="decoded"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and decoded bytes of each document."""
    return digests(encode(docs.select("doc_id", "text"), *public_vocabulary(), decoded="decoded"))
