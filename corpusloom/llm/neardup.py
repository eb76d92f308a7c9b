"""MinHash near-dedup with HyperMinHash registers.

Signature.  ``M`` buckets each keep the minimum of their own hash over all shingles of a document,
stored as a count of leading zeros (6 bits) and the ``R`` mantissa bits that follow the first one:
16 bits a bucket.  Four registers make a band, 32 bands a signature, so two sets of similarity
0.75 miss each other in all bands with a probability of (1 - 0.75**4)**32 < 6e-6.  The share of
equal registers, corrected for those that agree by chance (``chance``), estimates the similarity;
candidates far below the threshold go, all others are verified on their full shingle sets.

Scale.  Documents with equal shingle sets are one class before anything is paired.  Buckets are
found by a partially aggregated minimum.  First every class is compared with the least class of
each of its buckets only (a star); the links found give components.  Then, in buckets that still
hold several components, classes of different components are compared, in blocks of ``BLOCK``
classes spread over tasks; pairs live only inside a block, and only links leave it.  Pairs inside one
component are never made, so a group of n near copies costs about n comparisons, and no link between
components is lost.  Components come from
alternating star contractions on the links.

Defined results: null, empty or blank text has no shingles and stays alone; fewer than k words make
one shingle of the whole sequence.  A null doc_id
never names a component unless nothing else can; such rows are kept if they are alone with null.  Texts that differ are classes of their own,
also under one doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import cut, drop, join_small, small_batches, table

M, R, BANDS = 128, 10, 32
WORDS, SHARE = 5, 75
#: Five standard deviations of an estimate from M registers below 0.75.
NEAR = 0.75 - 5 * (0.75 * 0.25 / M) ** 0.5
BLOCK = 1024
#: Ids that a broadcast may hold, eight bytes each, or sixteen with the hash of a text.
IDS = 250_000

_rng = np.random.default_rng(77)
_ODD = _rng.integers(0, 2**63, M, dtype=np.uint64) * K.U64(2) + K.U64(1)
_ADD = _rng.integers(0, 2**63, M, dtype=np.uint64)


def shingle_sets(b: K.Block, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document of a block, ordered by document."""
    n = len(b.off) - 1
    s, e, doc = K.words(b)
    h = K.Hasher(K.lower_ascii(b.data))(s, e)
    grams, owner = K.shingles(h, doc, k)
    count = K.per_doc(doc, n)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        at = np.concatenate([[0], np.cumsum(count)])
        whole = np.zeros(len(few), K.U64)
        for i in range(k - 1):
            has = count[few] > i
            whole[has] = K.mix(whole[has] * K.U64(31) + h[at[few[has]] + i])
        grams = np.concatenate([grams, K.mix(whole + count[few].astype(K.U64))])
        owner = np.concatenate([owner, few])
    key = K.mix(grams ^ K.mix(owner.astype(K.U64) + K.U64(1)))
    order = np.argsort(key, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    chosen = order[first]
    chosen = chosen[np.argsort(owner[chosen], kind="stable")]
    return grams[chosen], owner[chosen]


def registers(grams: np.ndarray, start: np.ndarray) -> np.ndarray:
    """HyperMinHash registers, one row for each run of grams that begins at start."""
    out = np.zeros((len(start), M), np.uint16)
    for i in range(M):
        least = np.minimum.reduceat((grams ^ _ADD[i]) * _ODD[i], start)
        zeros = 64 - np.frexp(np.maximum(least, K.U64(1)).astype(float))[1].astype(np.int64)
        zeros = np.clip(zeros, 0, 63).astype(K.U64)
        rest = (least << np.minimum(zeros + K.U64(1), K.U64(63))) >> K.U64(64 - R)
        out[:, i] = (zeros << K.U64(R) | rest).astype(np.uint16)
    return out


def _chance() -> np.ndarray:
    """Probability that registers of disjoint sets of 2**i and 2**j shingles agree."""
    step = np.arange(2**R + 1) / 2**R
    bounds = np.concatenate([(2.0 ** -(z + 1)) * (1 + step[:-1]) for z in range(40)][::-1] + [[1.0]])
    mass = []
    for i in range(24):
        survive = np.exp(2**i * np.log1p(-np.minimum(bounds, 1 - 1e-16)))
        mass.append(survive[:-1] - survive[1:])
    mass = np.array(mass)
    return mass @ mass.T


_chance_table: list[np.ndarray] = []


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    if not _chance_table:
        _chance_table.append(_chance())
    level = lambda x: np.clip(np.round(np.log2(np.maximum(x, 1))), 0, 23).astype(int)
    return _chance_table[0][level(n), level(m)]


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less those that agree by chance."""
    by_chance = chance(n, m)
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def _sets_schema(df: DataFrame, keep: list[str], add: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), add])


def signatures(df: DataFrame, keep: list[str], k: int = WORDS, text: str = "text") -> DataFrame:
    """keep, size of the shingle set, two checksums of the set, and the signature as 32 longs (null: no shingles)."""
    small_batches(df.sparkSession)

    def run(batches):
        K.own("neardup")
        for batch in batches:
            parts = []
            for b in K.blocks(batch.column(batch.num_columns - 1)):
                n = len(b.off) - 1
                grams, owner = shingle_sets(b, k)
                size = K.per_doc(owner, n)
                one, two, sig = np.zeros(n, K.U64), np.zeros(n, K.U64), np.zeros((n, BANDS), np.int64)
                full = np.flatnonzero(size)
                if len(full):
                    start = (np.cumsum(size) - size)[full]
                    one[full] = np.add.reduceat(K.mix(grams), start)
                    two[full] = np.add.reduceat(K.mix(grams ^ _ADD[0]), start)
                    sig[full] = registers(grams, start).view(np.int64)
                parts.append((size, one, two, sig))
            size, one, two, sig = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, K.U64), np.zeros(0, K.U64), np.zeros((0, BANDS), np.int64))
            off = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(off), pa.array(sig[size > 0].ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(size), pa.array(K.signed(one)), pa.array(K.signed(two)), made], names=[*keep, "n_shingles", "k1", "k2", "sig"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, _sets_schema(df, keep, "n_shingles bigint, k1 bigint, k2 bigint, sig array<bigint>"))


def full_sets(df: DataFrame, keep: list[str], k: int = WORDS, text: str = "text") -> DataFrame:
    """keep, the checksums and the sorted shingle set itself, as bytes."""

    def run(batches):
        K.own("neardup")
        for batch in batches:
            sets, one, two = [], [], []
            for b in K.blocks(batch.column(batch.num_columns - 1)):
                grams, owner = shingle_sets(b, k)
                for x in np.split(grams, np.searchsorted(owner, np.arange(1, len(b.off) - 1))):
                    sets.append(np.sort(x).tobytes())
                    one.append(int(K.signed(K.mix(x)).sum()) if len(x) else 0)
                    two.append(int(K.signed(K.mix(x ^ _ADD[0])).sum()) if len(x) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sets, pa.binary())], names=[*keep, "k1", "k2", "grams"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, _sets_schema(df, keep, "k1 bigint, k2 bigint, grams binary"))


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and whose registers estimate a similarity not far below it."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.filter(100 * F.least("na", "nb") >= SHARE * F.greatest("na", "nb"))

    def run(batches):
        K.own("neardup")
        for batch in batches:
            x = [np.frombuffer(np.ascontiguousarray(batch.column(i).flatten().to_numpy(zero_copy_only=False)), np.uint16).reshape(-1, M) for i in (4, 5)]
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            near = estimate((x[0] == x[1]).mean(1), n, m) >= NEAR if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near)), batch.column(1).filter(pa.array(near))], names=["a", "b"])

    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def sets_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(cid, grams): full sets of the wanted classes (cid), read anew from the texts of one document per class."""
    named = cut(wanted.join(classes.select("cid", F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("row").alias("id")), "cid"))
    chosen, ids = docs.select("doc_id", "text"), named.select("id").distinct()
    if named.count() <= IDS:
        ids = F.broadcast(ids)
    texts = chosen.join(ids, chosen["doc_id"].eqNullSafe(ids["id"]), "left_semi")
    sets = full_sets(texts, ["doc_id"], k).dropDuplicates(["doc_id", "k1", "k2"])
    on = sets["doc_id"].eqNullSafe(named["id"]) & (sets["k1"] == named["w1"]) & (sets["k2"] == named["w2"])
    out = cut(named.join(sets, on).select("cid", "grams"))
    drop(named)
    return out


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(x), len(y)) < SHARE * max(len(x), len(y)):
        return False
    z = np.concatenate([x, y])
    z.sort(kind="stable")
    common = int((z[1:] == z[:-1]).sum())
    return 100 * common >= SHARE * (len(x) + len(y) - common)


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int = WORDS) -> DataFrame:
    """The pairs (a, b) whose full sets agree enough."""
    both = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    sets = sets_of(both, classes, docs, k)
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("grams").alias(f"g{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ga", "gb")

    def run(batches):
        K.own("neardup")
        for batch in batches:
            good = [linked(np.frombuffer(x.as_py(), K.U64), np.frombuffer(y.as_py(), K.U64)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    out = cut(joined.mapInArrow(run, "a bigint, b bigint"))
    drop(sets)
    return out


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of a link, root the least node that it reaches.

    Alternating star contractions: a node's larger neighbours are hung on its least neighbour, then
    its smaller ones; rounds grow with the logarithm of the longest path.  Each round's links are
    written, so lineage stays short.
    """
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        small = cut(small.filter("u <> v").distinct())
        drop(edges, large)
        edges = small
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.groupBy("u").agg(F.min("v").alias("root"))
            return roots.select(F.col("u").alias("node"), "root").union(edges.select("v", "v").distinct())
        mark = now


def _deal(members: DataFrame) -> DataFrame:
    """Blocks of each bucket in which every two classes of different components meet under exactly one key.

    members has main, the component of the bucket's lead, and outside, how many classes belong to others.  Classes
    of the main component meet outsiders only, never each other: both are cut by hash into parts, of BLOCK classes
    and of BLOCK outsiders, and a key is a part of the first (own) and one of the second (other), or two of
    the second.  So a bucket costs its classes times the parts of its outsiders, not the square of its parts.
    side tells which of the two a class comes from.
    """
    out, parts = F.col("root") != F.col("main"), lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    place = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    rows = members.withColumns({"out": out, "po": parts(F.col("outside")), "pm": parts(F.col("members") - F.col("outside"))})
    rows = rows.withColumn("own", F.when(F.col("out"), place(F.col("po"))).otherwise(place(F.col("pm"))))
    key = lambda kind, a, b: F.xxhash64("band", "value", F.lit(kind), a, b)
    to = lambda n: F.sequence(F.lit(0), n - 1)
    own = F.col("own")
    across = lambda: F.transform(to(F.col("pm")), lambda i: F.struct(key(0, i, own).alias("key"), F.lit(1).alias("side")))
    among = F.transform(to(F.col("po")), lambda i: F.struct(key(1, F.least(i, own), F.greatest(i, own)).alias("key"), F.when(own > i, 1).otherwise(0).alias("side")))
    inside = F.transform(to(F.col("po")), lambda i: F.struct(key(0, own, i).alias("key"), F.lit(0).alias("side")))
    dealt = rows.withColumn("at", F.explode(F.when(F.col("out"), F.concat(across(), among)).otherwise(inside)))
    return dealt.select("at.key", "at.side", "band", "cid", "root", "n_shingles", "sig")


def _in_blocks(dealt: DataFrame, grams: bool) -> DataFrame:
    """What the blocks hold across components: without grams the classes (cid) of likely pairs, else the links (a, b).

    A pair is looked at in the first band that it shares only.  With grams, links join components
    within the block at once, so pairs that have become connected are passed over.
    """
    names = ["a", "b"] if grams else ["cid"]

    def likely_rows(i, cid, root, n, sig, band, others):
        a, b = n[i], n[others]
        others = others[(root[others] != root[i]) & (cid[others] != cid[i]) & (100 * np.minimum(a, b) >= SHARE * np.maximum(a, b))]
        if len(others):
            fewer = sig[others][:, :band] == sig[i, :band]
            others = others[~fewer.any(1)]
        if len(others):
            equal = (sig.view(np.uint16)[others] == sig.view(np.uint16)[i]).mean(1)
            others = others[estimate(equal, np.full(len(others), a), n[others]) >= NEAR]
        return others

    def group(side, band, cid, root, n, sig, sets):
        sig, band, root = np.ascontiguousarray(sig), int(band[0]), root.copy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = set()
        for x, i in enumerate(left):
            for j in likely_rows(i, cid, root, n, sig, band, right if len(right) else left[x + 1 :]):
                if sets is None:
                    out |= {(int(cid[i]),), (int(cid[j]),)}
                elif root[i] != root[j] and linked(sets[i], sets[j]):
                    out.add((min(int(cid[i]), int(cid[j])), max(int(cid[i]), int(cid[j]))))
                    root[root == root[j]] = root[i]
        return out

    def run(batches):
        K.own("neardup")
        key, held = None, []

        def flush():
            found = set()
            if held and sum(len(h[0]) for h in held) > 1:
                *cols, sets = zip(*held, strict=True)
                found = group(*(np.concatenate(c) for c in cols), [x for s in sets for x in s] if grams else None)
            pairs = np.array(sorted(found), np.int64).reshape(-1, len(names))
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, i]) for i in range(len(names))], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cols = [batch.column(c).to_numpy() for c in range(1, 6)]
            cols.append(batch.column(6).flatten().to_numpy().reshape(-1, BANDS))
            sets = [np.frombuffer(x.as_py(), K.U64) for x in batch.column(7)] if grams else [None] * len(keys)
            edge = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                if keys[s] != key:
                    if held and (out := flush()).num_rows:
                        yield out
                    key, held = keys[s], []
                held.append((*(c[s:e] for c in cols), sets[s:e]))
        if held and (out := flush()).num_rows:
            yield out

    shape = ", ".join(f"{c} bigint" for c in names)
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, shape).distinct()


def near_duplicates(docs: DataFrame, k: int = WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of keep, n_shingles, component_id and kept for each row of docs (doc_id, text)."""
    rows = cut(signatures(docs, ["doc_id", *keep], k))
    # min() prefers any id to null, so a class is named by a null id only if all its ids are null
    classes = rows.filter("n_shingles > 0").groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("row"))
    sigs = rows.filter("n_shingles > 0").select("n_shingles", "k1", "k2", "sig").dropDuplicates(["n_shingles", "k1", "k2"])
    classes = cut(classes.join(sigs, ["n_shingles", "k1", "k2"]).withColumn("cid", F.monotonically_increasing_id()))

    placed = classes.select("cid", F.posexplode("sig").alias("band", "value"))
    shared = placed.groupBy("band", "value").agg(F.min("cid").alias("lead"), F.max("cid").alias("last"), F.count("*").alias("members")).filter("lead <> last").drop("last")
    buckets = cut(placed.join(shared, ["band", "value"]))
    star = buckets.filter("cid <> lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")).distinct()
    near = cut(likely(star, classes))
    links = verify(near, classes, docs, k)
    roots = cut(components(links))

    placed = buckets.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    main = F.max(F.when(F.col("cid") == F.col("lead"), F.col("root")))  # the lead's component: the star has tied most classes to it
    mixed = placed.groupBy("band", "value").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), main.alias("main")).filter("r1 <> r2").select("band", "value", "main")
    outside = placed.join(mixed, ["band", "value"]).filter("root <> main").groupBy("band", "value").agg(F.count("*").alias("outside"))
    mixed = mixed.join(outside, ["band", "value"])
    dealt = cut(_deal(placed.join(mixed, ["band", "value"]).join(classes.select("cid", "n_shingles", "sig"), "cid")))
    wanted = cut(_in_blocks(dealt, False))
    if wanted.limit(1).count():
        sets = sets_of(wanted, classes, docs, k)
        more = cut(_in_blocks(dealt.join(sets, "cid").select(*dealt.columns, "grams"), True))
        if more.limit(1).count():
            roots = cut(components(links.union(more)))
        drop(sets)
    drop(near, buckets, dealt, wanted)

    named = classes.select("n_shingles", "k1", "k2", "cid", F.col("row")).join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    lowest = named.groupBy("root").agg(F.min("row").alias("component_id"))
    named = named.join(lowest, "root").select("n_shingles", "k1", "k2", "component_id")
    out = rows.select("doc_id", *keep, "n_shingles", "k1", "k2").join(named, ["n_shingles", "k1", "k2"], "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", *keep, "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the least doc_id.

    Rows go by doc_id and text: others of the same doc_id, or of none, stay.
    """
    keyed = docs.withColumn("_loom_gone", F.col("doc_id")).withColumn("_loom_text", F.xxhash64("text"))
    gone = near_duplicates(keyed, keep=("_loom_text",)).filter("not kept").select(F.col("doc_id").alias("_loom_gone"), "_loom_text")
    return join_small(keyed, cut(gone.distinct()), ["_loom_gone", "_loom_text"], "left_anti", IDS).drop("_loom_gone", "_loom_text")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION SELECT doc_id, len(w) || ': ' || array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT e.a, r.root FROM r JOIN e ON e.b = r.doc_id WHERE r.root < e.a
)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id, r.doc_id = min(root) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
