"""Vectorised text primitives shared by the operators that run on Arrow batches.

A block is a run of whole documents whose UTF-8 bytes lie one after another in one array.  Blocks
hold about ``BLOCK_BYTES``, so that their arrays stay in a core's cache and a worker stays small; a longer document makes a block of its own, so memory per worker
follows the longest document and not the batch.  Words are maximal runs of bytes outside
``[\\x20\\x09-\\x0D]``; these delimiters are ASCII, hence never part of a longer UTF-8 sequence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
#: Rows in one Arrow batch; long rows make 10,000 of them too heavy for a worker.
BATCH_ROWS = 256
U64 = np.uint64

DELIM = np.zeros(256, bool)
DELIM[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


class Block(NamedTuple):
    """rows: first and last + 1 row of the batch; data: bytes; off: bounds of the documents."""

    rows: slice
    data: np.ndarray
    off: np.ndarray


_owner: list = [None, None]


def own(name: str, clear=None) -> None:
    """Called as an operator's task begins: a worker, which Spark uses again and again, keeps the caches of one operator at a time.

    What earlier tasks have freed goes back to the system; an executor's limit counts it otherwise.
    """
    if _owner[0] != name:
        if _owner[1]:
            _owner[1]()
        _owner[:] = name, clear
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits, so that sums of products spread over all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h = h * U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def string_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    bounds, data = column.buffers()[1:3]
    if not n or bounds is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole documents."""
    data, off = string_column(column)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield Block(slice(a, b), data[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of True that stays in one document."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~DELIM[block.data], block.off)


def lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each piece between \\n; an empty document has one empty line."""
    cut = np.flatnonzero(block.data == 10)
    s = np.sort(np.concatenate([block.off[:-1], cut + 1]))
    owner = np.sort(np.concatenate([np.arange(len(block.off) - 1), np.searchsorted(block.off, cut, "right") - 1]))
    e = np.empty_like(s)
    last = np.r_[owner[1:] != owner[:-1], True]
    e[~last] = s[1:][~last[:-1]] - 1
    e[last] = block.off[owner[last] + 1]
    return s, e, owner


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        m = max(n + 1, BLOCK_BYTES + 1)
        up, down = np.full(m, _BASE, U64), np.full(m, _INVERSE, U64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        if m > 8 * BLOCK_BYTES:  # not kept: one very long document shouldn't hold memory for good
            return up, down
        _powers[:] = up, down
    return _powers[0], _powers[1]


class Hasher:
    """64-bit hashes of any substrings of a block, from prefix sums of a polynomial; kind 1 is independent of kind 0."""

    def __init__(self, data: np.ndarray, kind: int = 0):
        n = len(data)
        self.up, self.down = _tables(n)
        self.sum = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[kind][data] * self.up[:n], out=self.sum[1:])

    def __call__(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sum[e] - self.sum[s]) * self.down[s] + (e - s).astype(U64))


def shingles(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each window of k words that stays in one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = (out + h[i : i + n]) * _BASE
    whole = doc[:n] == doc[k - 1 : k - 1 + n]
    return mix(out[whole]), doc[:n][whole]


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix counts of code points: out[i] lie before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def per_doc(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n).astype(np.int64)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + 32, data)


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters, byte for byte."""
    out = lower_ascii(data)
    after = np.concatenate([[0], data[:-1]]) == 0xC3
    return np.where(after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, out).astype(np.uint8)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
