"""Phrases of whole corpora in slices: which may be widespread is found from hashes, only their uses become rows.

Most phrases are used once, and as rows of text they fill many times the input's disk.  So a slice of the
phrases, by hash, is taken at a time.  Hashes and authors of its uses, packed into 64 bits, meet by hash;
those that enough authors share set a bit, and only uses whose bit is set become rows, which are counted by
their text as before.  Hashes that coincide let a phrase too many through and never one too few.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions import text as X
from .graph import cut, drop

#: Phrase uses of one slice: the disk for its hashes and rows.
SLICE_USES = 150_000_000
#: Slices at most.  All tokens are read for each, so beyond that slices grow with the input and not in number.
MOST_SLICES = 4
#: Words that one block of a worker holds, a document at least.
BLOCK_WORDS = 500_000
#: Bytes of texts that are taken apart at once, a document at least.
BLOCK_BYTES = 4_000_000
#: Bits of the filter (8 MB), and of the hash by which its parts are dealt out (more for larger slices).
BITS, PARTS = 26, 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_INSIDE = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789-", np.uint8))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def distinct(a: np.ndarray) -> np.ndarray:
    """The values of a in order, each once.  Sorted: np.unique hashes them, which takes 50 times as long."""
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])[: len(a)]]


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """A polynomial of each word's bytes, mixed."""
    words = words.cast(pa.large_binary())
    n = len(words)
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].astype(np.uint64) + np.uint64(1)
    at = at - at[0]
    size = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], size)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(size.max(initial=0), 1), _ODD)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(data * power[place], dtype=np.uint64)])
    return mix(sums[at[1:]] - sums[at[:-1]] + size.astype(np.uint64) * _MIX)


def squeeze(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts that X.spelled_out made, one space between two of them; and their numbers."""
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))  # each ends outside of a token
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    inside = _INSIDE[data]
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    upto = np.searchsorted(ends, at)
    n = np.diff(upto)
    kept = inside.copy()
    kept[ends] = True
    kept[ends[upto[1:][n > 0] - 1]] = False
    size = np.add.reduceat(kept, at[:-1], dtype=np.int64)
    out = np.where(inside, data, np.uint8(32))[kept]
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(out)).cast(pa.string()), n


def _tokens(batches):
    """Rows whose text becomes tokens, and size their number."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("tokens")).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
        ends = [*(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for start, end in zip([0, *ends], ends):
            if end > start:
                part = batch.slice(start, end - start)
                tokens, n = squeeze(part.column("tokens"))
                new = {"tokens": tokens, "size": pa.array(n, pa.int32())}
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)


class Block:
    """Some posts' tokens as numbers."""

    def __init__(self, rows: pa.RecordBatch, low: int, high: int, stop: list[str]):
        self.rows, self.low, self.high = rows, low, high
        tokens = pc.split_pattern(rows.column("tokens"), " ")
        flat = tokens.flatten()
        n = np.diff(tokens.offsets.to_numpy())
        coded = flat.dictionary_encode()
        self.words, self.ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(len(n)), n)
        weak = pc.is_in(self.words, value_set=pa.array(stop, pa.string())).to_numpy(zero_copy_only=False)
        digits = pc.match_substring_regex(self.words, "^[0-9]+$").to_numpy(zero_copy_only=False)
        self.weak, self.idle = weak[self.ids], (weak | digits)[self.ids]
        self.hash = word_hashes(self.words)[self.ids] if len(self.ids) else np.zeros(0, np.uint64)

    def grams(self):
        """For each length: n, the places of the phrases that X.ngrams lists too, their hashes."""
        h, idle = self.hash.copy(), self.idle.copy()
        for n in range(1, self.high + 1):
            if n > 1:
                k = max(len(self.ids) - n + 1, 0)
                h = mix(h[:k] * _ODD + self.hash[n - 1 :][:k] + np.uint64(n))
                idle = idle[:k] & self.idle[n - 1 :][:k]
            if n >= self.low and len(h):
                good = ~idle & ~self.weak[: len(h)] & ~self.weak[n - 1 :][: len(h)] & (self.doc[: len(h)] == self.doc[n - 1 :][: len(h)])
                at = np.flatnonzero(good)
                yield n, at, h[at]

    def text(self, at: np.ndarray, n: int) -> pa.Array:
        words = [self.words.take(pa.array(self.ids[at + i])) for i in range(n)]
        return pc.binary_join_element_wise(*words, " ")


def blocks(batches, low: int, high: int, stop: list[str]):
    for batch in batches:
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        group = np.maximum(np.cumsum(sizes) - sizes, 0) // BLOCK_WORDS
        ends = [*(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        start = 0
        for end in ends:
            if end > start:
                yield Block(batch.slice(start, end - start), low, high, stop)
            start = end


def store(posts: DataFrame, keys: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Posts that are no retweets as tokens, written once, an author's side by side; and the number of authors.

    posts: post_id, author_id, created, type, text, keys.  code: the author's place; key: hash of the keys.
    """
    every = posts.filter("type <> 'retweet'")
    # people are few beside texts, so one task numbers them
    authors = cut(every.select(F.col("author_id").alias("_a")).distinct().select("_a", (F.row_number().over(Window.orderBy("_a")) - 1).cast("bigint").alias("code")))
    own = every.select("post_id", "author_id", "created", *keys, X.spelled_out(F.col("text")).alias("tokens"), F.lit(0).alias("size"), F.xxhash64(F.lit(0), *keys).alias("key"))
    own = own.mapInArrow(_tokens, ", ".join(f"`{c}` {kind}" for c, kind in own.dtypes))
    spark = every.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = own.join(authors, F.col("author_id").eqNullSafe(F.col("_a"))).drop("_a")
    # no range partitioning, whose sample would compute the tokens again; an author's posts go to several tasks
    salt = F.pmod(F.xxhash64("post_id"), F.lit(max(8, parts // 8)))
    return cut(own.repartition(parts, *keys, "author_id", salt).sortWithinPartitions(*keys, "author_id")), authors.count()


def slices(tokens: DataFrame, lengths: int = 3) -> tuple[int, int]:
    """Number of slices, and the bits by which the filter of each is dealt out, so that its parts don't grow."""
    n = max(1, -(-(tokens.agg(F.sum("size")).first()[0] or 0) * lengths // SLICE_USES))
    parts = min(n, MOST_SLICES)
    return parts, min(PARTS + (-(-n // parts) - 1).bit_length(), BITS - 8)


def _inside(h: np.ndarray, part: int, parts: int) -> np.ndarray:
    return (h & np.uint64(0xFFFFFF)) % np.uint64(parts) == np.uint64(part)


def _found(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1


def candidates(tokens: DataFrame, authors: int, least: int, part: int = 0, parts: int = 1, low: int = 2, high: int = 4, stop: list[str] | None = None, dealt: int = PARTS) -> np.ndarray:
    """A bit for each hash of a slice that enough authors use, as bytes."""
    words = list(stop if stop is not None else fixed.PHRASE_STOP)
    b = np.uint64(max(1, (max(authors, 1) - 1).bit_length()))

    def send(batches):
        held, n = [], 0

        def out():
            keys = distinct(np.concatenate(held))
            cuts = np.searchsorted(keys >> np.uint64(64 - dealt), np.arange(2**dealt + 1))
            at = [p for p in range(2**dealt) if cuts[p] < cuts[p + 1]]
            for p in at:
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int32()), "keys": pa.array([keys[cuts[p] : cuts[p + 1]].tobytes()], pa.binary())})

        for block in blocks(batches, low, high, words):
            key, code = block.rows.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), block.rows.column("code").to_numpy(zero_copy_only=False).astype(np.uint64)
            for _, at, h in block.grams():
                h = mix(h + key[block.doc[at]] * _ODD)
                mine = _inside(h, part, parts)
                held.append(distinct(((h[mine] >> b) << b) | code[block.doc[at[mine]]]))
                n += len(held[-1])
            if n > 6_000_000:
                yield from out()
                held, n = [], 0
        if n:
            yield from out()

    def meet(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for p, keys in zip(batch.column("p").to_pylist(), batch.column("keys"), strict=True):
                found.setdefault(p, []).append(np.frombuffer(keys.as_buffer(), np.uint64))
        while found:
            p, own = found.popitem()
            own = distinct(np.concatenate(own)) >> b
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            enough = own[first[np.diff(np.append(first, len(own))) >= least]] << b
            bits = np.zeros(1 << (BITS - dealt), np.uint8)
            bits[(enough >> np.uint64(64 - BITS)) & np.uint64((1 << (BITS - dealt)) - 1)] = 1
            yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    rows = tokens.select("tokens", "size", "key", "code").mapInArrow(send, "p int, keys binary").repartition(2**dealt, "p").mapInArrow(meet, "p int, bits binary").collect()
    out = np.zeros((2**dealt, 1 << (BITS - dealt - 3)), np.uint8)
    for r in rows:
        out[r.p] |= np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def uses_of(tokens: DataFrame, phrases: list[str], low: int = 2, high: int = 4, stop: list[str] | None = None) -> DataFrame:
    """Uses of a few phrases, a row per post and phrase: post_id, author_id, created, keys, phrase, posts."""
    known = set(phrases)
    wanted = {}
    for p in known:
        block = Block(pa.RecordBatch.from_pydict({"tokens": pa.array([p], pa.string())}), low, high, [])
        for n, at, h in block.grams():
            if n == len(block.ids):
                wanted[p] = h[at[at == 0]]
    # the keys' hash is left out here: what has the words is found whatever its keys
    bits = np.zeros(1 << BITS, np.uint8)
    for h in wanted.values():
        bits[h >> np.uint64(64 - BITS)] = 1
    rows = _rows(tokens, np.packbits(bits), 0, 1, low, high, stop, False)
    return rows.filter(F.col("phrase").isin(*known)) if known else rows.limit(0)


def rows_of(tokens: DataFrame, bits: np.ndarray, part: int = 0, parts: int = 1, low: int = 2, high: int = 4, stop: list[str] | None = None) -> DataFrame:
    """Uses whose bit is set, summed per block, keys, phrase and author: keys, phrase, author_id, posts, and created and post_id of the first."""
    return _rows(tokens, bits, part, parts, low, high, stop, True)


def _rows(tokens, bits, part, parts, low, high, stop, by_author: bool) -> DataFrame:
    words = list(stop if stop is not None else fixed.PHRASE_STOP)
    extra = [c for c in tokens.columns if c not in ("tokens", "size", "key", "code")]
    sent = tokens.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        filled = sent.value
        in_order = (b.take(pc.sort_indices(b, [("created", "ascending"), ("post_id", "ascending")], null_placement="at_end")) for b in batches if b.num_rows)
        for block in blocks(in_order, low, high, words):
            docs = block.rows
            key = docs.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            # docs of one group agree in author and keys themselves, not in hashes only
            group = pd.DataFrame({c: docs.column(c).to_pandas() for c in extra if c not in ("post_id", "created")}).groupby([c for c in extra if c not in ("post_id", "created")], dropna=False).ngroup().to_numpy() if by_author else np.arange(docs.num_rows)
            for n, at, h in block.grams():
                full = mix(h + key[block.doc[at]] * _ODD) if by_author else h
                mine = _found(filled, full) & _inside(full, part, parts)
                at, h = at[mine], h[mine]
                if not len(at):
                    continue
                own, doc = group[block.doc[at]], block.doc[at]
                seed = np.uint64(1)
                while True:
                    mark = mix(h * seed + own.astype(np.uint64) * _MIX + seed)
                    order = np.argsort(mark, kind="stable")
                    new = np.concatenate([[True], mark[order][1:] != mark[order][:-1]])
                    first = np.flatnonzero(new)
                    head = order[first[np.cumsum(new) - 1]]
                    same = own[order] == own[head]
                    for i in range(n):
                        same &= block.ids[at[order] + i] == block.ids[at[head] + i]
                    if same.all():
                        break
                    if seed > 64:
                        raise ValueError("hashes of different phrases coincide")
                    seed += np.uint64(2)
                fresh = new | np.concatenate([[True], doc[order][1:] != doc[order][:-1]])
                posts = np.add.reduceat(fresh.astype(np.int64), first)
                one = order[first]
                took = docs.select(extra).take(pa.array(doc[one]))  # without the tokens, which would be copied for each row
                yield pa.RecordBatch.from_arrays([*[took.column(c) for c in extra], block.text(at[one], n), pa.array(posts)], names=[*extra, "phrase", "posts"])

    kinds = dict(tokens.dtypes)
    return tokens.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in extra), "phrase string", "posts bigint"]))


def each_slice(posts: DataFrame, least: int, keys: tuple[str, ...], finish) -> DataFrame:
    """finish(rows of possible phrases) of each slice, written; all of them together."""
    tokens, authors = store(posts, keys)
    (parts, dealt), out = slices(tokens), None
    for part in range(parts):
        done = cut(finish(rows_of(tokens, candidates(tokens, authors, least, part, parts, dealt=dealt), part, parts)))
        out = done if out is None else out.unionByName(done)
        release(posts.sparkSession)
    drop(tokens)
    return out


def release(spark) -> None:
    """Have the shuffle files of what ended deleted now, not when the driver next collects its garbage."""
    import gc

    gc.collect()
    spark._jvm.System.gc()
