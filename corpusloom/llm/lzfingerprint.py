"""Lempel-Ziv phrase fingerprints.

A document is parsed as LZ78 does, byte by byte: the longest phrase in the dictionary plus one byte
is a new phrase.  The phrases' hashes form a set, whose signature is one minimum per bin: a phrase
falls in the bin that its hash names, and each of the ``BINS`` bins keeps 16 bits of its least hash
(ffff: an empty bin), written as four hexadecimal digits.  Two documents are alike as far as the bins
that either fills hold the same minimum: an estimate of the similarity of the phrase sets, which
nears that of compression distances.

The next document, whose beginning replaces the end of a text, is found without a global sort: ids
are cut into ranges at approximate quantiles, each range is sorted by itself, and each gets a copy of
the first document of the range that follows.  An edited text shares its beginning with the original;
the parse goes on from a copy of the dictionary there.

Defined results: null text counts as empty; an empty text has no phrases and is like another only if
that is empty too.  Documents follow each other by descending doc_id, null last, ties by text, rows
that agree in both in any order; after the last comes the first, which may be the document itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, table

BINS = 128
EMPTY = 0xFFFF
#: Ranges of ids for each shuffle partition; several even out what hashing deals them.
RANGES_PER_PARTITION = 4


def parse(data: bytes, at: int, stop: int, phrases: dict[int, int], node: int, ends: list[int]) -> int:
    """Go on with an LZ78 parse from byte at to stop; phrases maps node << 8 | byte to a node << 8.

    ends gets the end of each phrase; the node that the last, unfinished phrase has reached is returned.
    """
    get, add = phrases.get, ends.append
    for i in range(at, stop):
        key = node | data[i]
        following = get(key)
        if following is None:
            phrases[key] = (len(phrases) + 1) << 8
            add(i + 1)
            node = 0
        else:
            node = following
    return node


def signature(data: np.ndarray, ends: list[int]) -> np.ndarray:
    """Minimum of each bin over the phrases that end at ends; what follows the last is a phrase too."""
    e = np.array(ends, np.int64)
    if len(data) and (not len(e) or e[-1] < len(data)):
        e = np.append(e, len(data))
    out = np.full(BINS, EMPTY, np.uint16)
    if len(e):
        s = np.concatenate([[0], e[:-1]])
        h = K.Hasher(data)(s, e)
        np.minimum.at(out, (h % K.U64(BINS)).astype(np.int64), np.minimum(h >> K.U64(48), EMPTY - 1).astype(np.uint16))
    return out


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    full = (a != EMPTY) | (b != EMPTY)
    n = int(full.sum())
    return float(((a == b) & full).sum() / n) if n else 1.0


def _values(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u2").astype(np.uint16)


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    return likeness(_values(a), _values(b))


def fingerprint_text(text: str) -> str:
    raw = text.encode()
    ends: list[int] = []
    parse(raw, 0, len(raw), {}, 0, ends)
    return as_text(signature(np.frombuffer(raw, np.uint8), ends))


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """df with the fingerprint of each text."""
    small_batches(df.sparkSession)
    keep = [c for c in df.columns if c != out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), f"`{out}` string"])
    which = keep.index(text)

    def run(batches):
        K.own("lz")
        for batch in batches:
            made = [fingerprint_text(x or "") for x in batch.column(which).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*keep, out])

    return df.select(*keep).mapInArrow(run, schema)


def both(text: str, following: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Signatures of a text and of its edited text, and the edited text."""
    third = len(text) // 3
    edited = (text[: len(text) - third] + following[:third]).encode()
    raw = text.encode()
    shared = len(text[: len(text) - third].encode())
    phrases: dict[int, int] = {}
    ends: list[int] = []
    node = parse(raw, 0, shared, phrases, 0, ends)
    more, other = dict(phrases), list(ends)
    parse(raw, shared, len(raw), phrases, node, ends)
    parse(edited, shared, len(edited), more, node, other)
    return signature(np.frombuffer(raw, np.uint8), ends), signature(np.frombuffer(edited, np.uint8), other), edited


def followed(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of df (key, text) with part (a range of keys, in descending order) and last: a copy of the row that follows the range.

    Within a part, by descending key and text, each row's next is the one below; the last row of a part is a copy.
    Keys are numbers, which quantiles are taken of.
    """
    spark = df.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = df.select(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    bounds = sorted(set(at), reverse=True)
    # one literal, however many bounds; the number of bounds above a key is found by halving
    limits = F.split(F.lit(",".join(map(str, bounds))), ",").cast(f"array<{df.schema[key].dataType.simpleString()}>") if bounds else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(bounds).bit_length())))])
    above = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(limits, at + step - 1) > F.col(key), at + step).otherwise(at))
    # null last: after all bounds
    part = F.when(F.col(key).isNull(), len(bounds) + 1).otherwise(above)
    rows = df.withColumn("part", part.cast("int")).withColumn("copy", F.lit(False))
    heads = rows.groupBy("part").agg(F.max(key).alias("head")).collect()  # one row per range
    order = sorted(r["part"] for r in heads)
    head = {r["part"]: r["head"] for r in heads}
    if not order:
        return rows
    before = {p: order[i - 1] for i, p in enumerate(order)}
    follows = spark.createDataFrame([(p, head[p], before[p]) for p in order], f"p int, head {df.schema[key].dataType.simpleString()}, to int")
    first = rows.join(F.broadcast(follows), (F.col("part") == F.col("p")) & F.col(key).eqNullSafe(F.col("head")))
    first = first.groupBy("p", "to", key).agg(F.max("text").alias("text"))  # ties by text, the greatest first
    copies = first.select(*[F.col(c) for c in df.columns], F.col("to").alias("part"), F.lit(True).alias("copy"))
    return rows.unionByName(copies)


def edited_pairs(df: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next of each row of df (doc_id, text)."""
    spark = df.sparkSession
    small_batches(spark)
    rows = followed(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    kind = df.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        K.own("lz")
        held = None  # a row that waits for its next: id, part, copy, text
        waiting = None  # its results, without near_next
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3)), strict=True):
                if held is not None and held[1] == row[1]:
                    made = both(held[3], row[3])
                    if waiting is not None:
                        out.append((*waiting[:-1], likeness(waiting[-1], made[0])))
                    waiting = (held[0], len(held[3]), hashlib.sha256(made[2]).hexdigest(), as_text(made[0]), as_text(made[1]), likeness(made[0], made[1]), made[0])
                    if row[2]:  # the copy itself is no row
                        last = signature_of(row[3])
                        out.append((*waiting[:-1], likeness(waiting[-1], last)))
                        waiting = None
                held = None if row[2] else row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], names=names)

    sorted_rows = rows.repartition("part").sortWithinPartitions(F.asc("part"), F.asc("copy"), F.desc_nulls_last("doc_id"), F.desc("text"))
    return sorted_rows.select("doc_id", "part", "copy", "text").mapInArrow(run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def signature_of(text: str) -> np.ndarray:
    return _values(fingerprint_text(text))


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
