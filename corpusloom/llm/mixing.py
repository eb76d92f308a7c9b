"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are summed up by membership pattern, the set of sources that a document belongs to.  A
pattern can give its tokens once at no cost, a second time at a cost, a third at a higher one
(convex costs of repetition); a source takes its quota from the patterns that hold it.  Costs arise
only where a pattern's capacity begins, so the successive shortest paths of one cost are the
augmenting paths of one tier: tier after tier is augmented to its maximum, which gives a flow of
greatest value and least cost.  The flow says how many words each pattern gives; seeded order then
picks the documents that make up the last, partial pass over a pattern.

Scale.  One narrow pass counts words; the flow sees one node per pattern and per source (at most
``MAX_NODES``, checked).  The seeded choice needs no sort of all rows: sums over hash prefixes find
the bucket that holds the border, a second level of prefixes narrows it, and only the rows left
there are ordered.  What comes out is one border per pattern, so rows are decided without a shuffle.

Defined results: null text has size 0; a null source is a source of its own, the last.  Rows with
the same doc_id and size share a hash and are decided alike.  A border document is taken if that
brings the sum nearer to the flow.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import cut, drop, small_batches, table

WEIGHTS, SHARE, REPEATS, SEED = (5.0, 2.0, 1.0), 1.5, 2, "mix-1"
MAX_NODES = 200_000
PREFIX = 3


def sizes(df: DataFrame, keep: list[str], text: str = "text", size: str = "size") -> DataFrame:
    """keep and the number of words of each text."""
    small_batches(df.sparkSession)
    keep = [c for c in keep if c != size]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), f"`{size}` bigint"])

    def run(batches):
        K.own("mixing")
        for batch in batches:
            n = [K.per_doc(K.words(b)[2], len(b.off) - 1) for b in K.blocks(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], names=[*keep, size])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def targets(source_sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE, most: float = REPEATS) -> dict[str | None, float]:
    """Quota of each source: share of all sizes dealt by weight, at most ``most`` times its size, the excess dealt on.

    The level that all uncapped sources reach is found by going through the caps in the order in
    which a rising level meets them.
    """
    order = sorted(source_sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: most * float(source_sizes[s]) for s in order}
    rest, left = share * float(sum(source_sizes.values())), float(sum(weight.values()))
    level = 0.0
    for s in sorted(order, key=lambda s: (cap[s] / weight[s], s is None, s or "")):
        level = rest / left
        if cap[s] > level * weight[s]:
            break
        rest, left = rest - cap[s], left - weight[s]
    return {s: min(cap[s], level * weight[s]) for s in order}


def flow(capacity: list[int], member: list[list[int]], quota: list[int], repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words that each pattern sends to each of its sources: greatest value, then least repetition cost."""
    n, m = len(capacity), len(quota)
    sent = [dict.fromkeys(s, 0) for s in member]
    holders: list[list[int]] = [[] for _ in range(m)]
    for p, own in enumerate(member):
        for s in own:
            holders[s].append(p)
    room = list(quota)
    for _ in range(repeats):  # tiers in the order of their costs
        free = list(capacity)
        while True:
            # levels from all patterns with free capacity; 0..n-1 patterns, n.. sources
            level = {p: 0 for p in range(n) if free[p] > 0}
            todo, found = deque(level), False
            while todo:
                x = todo.popleft()
                if x < n:
                    following = [n + s for s in member[x]]
                else:
                    found = found or room[x - n] > 0
                    following = [p for p in holders[x - n] if sent[p][x - n] > 0]
                for y in following:
                    if y not in level:
                        level[y] = level[x] + 1
                        todo.append(y)
            if not found:
                break
            arc = dict.fromkeys(level, 0)  # arcs before this one lead nowhere on these levels
            for start in [p for p in level if p < n and free[p] > 0 and level[p] == 0]:
                while free[start] > 0:
                    path = [start]
                    while path:
                        x = path[-1]
                        if x >= n and room[x - n] > 0:
                            break
                        arcs = member[x] if x < n else holders[x - n]
                        while arc[x] < len(arcs):
                            y = arcs[arc[x]] + (n if x < n else 0)
                            if level.get(y) == level[x] + 1 and (x < n or sent[y][x - n] > 0):
                                path.append(y)
                                break
                            arc[x] += 1
                        else:
                            path.pop()
                            if path:
                                arc[path[-1]] += 1
                    if not path:
                        break
                    back = [sent[path[i + 1]][path[i] - n] for i in range(1, len(path) - 1, 2)]
                    amount = min([free[start], room[path[-1] - n], *back])
                    for i in range(0, len(path) - 1, 2):
                        sent[path[i]][path[i + 1] - n] += amount
                    for i in range(1, len(path) - 1, 2):
                        sent[path[i + 1]][path[i] - n] -= amount
                    free[start] -= amount
                    room[path[-1] - n] -= amount
    return sent


def seeded(doc_id, size, seed: str = SEED):
    """Hash that orders the documents of a pattern."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string")))


def borders(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pattern, whole, border): passes over the whole pattern, and the last hash of the partial one.

    keyed has pattern, size and hash; wanted has pattern, whole and part, the words of the partial pass.
    """
    state = wanted.select("pattern", "whole", F.col("part"), F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(False).alias("all"))
    for length in (PREFIX, 2 * PREFIX):
        inside = keyed.join(F.broadcast(state), "pattern").filter(~F.col("all") & F.col("hash").startswith(F.col("prefix")))
        sums = inside.groupBy("pattern", "part", "before", F.substring("hash", 1, length).alias("b")).agg(F.sum("size").alias("n"))
        through = F.col("before") + F.sum("n").over(Window.partitionBy("pattern").orderBy("b"))
        first = sums.withColumn("through", through).filter(F.col("through") > F.col("part")).groupBy("pattern").agg(F.min(F.struct("b", F.col("through") - F.col("n"))).alias("x"))
        state = cut(
            state.join(first, "pattern", "left").select(
                "pattern", "whole", "part",
                F.coalesce("x.b", "prefix").alias("prefix"), F.coalesce("x.col2", "before").alias("before"), F.col("x").isNull().alias("all"),
            )
        )
    inside = keyed.join(F.broadcast(state), "pattern").filter(~F.col("all") & F.col("hash").startswith(F.col("prefix")))
    ties = inside.groupBy("pattern", "part", "before", "hash").agg(F.sum("size").alias("n"))
    through = F.col("before") + F.sum("n").over(Window.partitionBy("pattern").orderBy("hash"))
    last = ties.withColumn("through", through).filter(2 * F.col("through") - F.col("n") <= 2 * F.col("part")).groupBy("pattern").agg(F.max("hash").alias("last"))
    return state.join(last, "pattern", "left").select("pattern", "whole", F.when(F.col("all"), F.lit("~")).otherwise(F.coalesce("last", "prefix")).alias("border"))


def pattern_of(sources):
    return F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("s")))


def plan(sized: DataFrame, sources: str, **options) -> tuple[DataFrame, DataFrame]:
    """What to take: (pattern, whole, border), and per source (source, source_size, target).

    sized has doc_id, size and an array of sources; options go to targets().
    """
    spark = sized.sparkSession
    keyed = cut(sized.select(pattern_of(F.col(sources)).alias("pattern"), F.array_sort(F.array_distinct(F.col(sources))).alias("_s"), F.col("size"), seeded(F.col("doc_id"), F.col("size")).alias("hash")))
    patterns = keyed.groupBy("pattern").agg(F.first("_s").alias("s"), F.sum("size").alias("size")).limit(MAX_NODES + 1).collect()
    if len(patterns) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} membership patterns; group the sources first")
    patterns.sort(key=lambda r: r["pattern"])
    total: dict[str | None, int] = {}
    for r in patterns:
        for s in set(r["s"]):
            total[s] = total.get(s, 0) + r["size"]
    target = targets(total, **options)
    number = {s: i for i, s in enumerate(target)}
    repeats = int(options.get("most", REPEATS))
    sent = flow([r["size"] for r in patterns], [[number[s] for s in dict.fromkeys(r["s"])] for r in patterns], [math.floor(t + 0.5) for t in target.values()], repeats)
    rows = []
    for r, own in zip(patterns, sent, strict=True):
        words = sum(own.values())
        whole = words // r["size"] if r["size"] else 0
        rows.append((r["pattern"], whole, words - whole * r["size"]))
    wanted = spark.createDataFrame(rows, "pattern string, whole long, part long")
    chosen = cut(borders(keyed.select("pattern", "size", "hash"), wanted))
    drop(keyed)
    return chosen, spark.createDataFrame([(s, n, target[s]) for s, n in total.items()], "source string, source_size long, target double")


def take(sized: DataFrame, chosen: DataFrame, sources: str) -> DataFrame:
    """sized with copies, the number of times that each document is taken."""
    own = chosen.withColumnsRenamed({c: f"_{c}" for c in chosen.columns})
    keyed = sized.withColumn("_key", pattern_of(F.col(sources)))
    joined = keyed.join(F.broadcast(own), F.col("_key") == F.col("_pattern"), "left")  # MAX_NODES rows at most
    extra = (seeded(F.col("doc_id"), F.col("size")) <= F.col("_border")).cast("long")
    return joined.withColumn("copies", F.coalesce(F.col("_whole") + F.when(F.col("size") > 0, extra).otherwise(0), F.lit(0))).drop("_key", *own.columns)


def op3_mix_min_cost_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = cut(sizes(docs.select("doc_id", F.col("source"), "text"), ["doc_id", "source"]).withColumn("s", F.array("source")))
    chosen, quotas = plan(sized, "s")
    quotas = F.broadcast(quotas.withColumnRenamed("source", "q"))
    out = take(sized, chosen, "s").join(quotas, F.col("source").eqNullSafe(F.col("q")), "left")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    inner = docs.toDF(*[f"d{i}" for i in range(len(docs.columns))])
    at = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    slim = inner.select(F.col(at["doc_id"]).alias("doc_id"), F.array(at["source"]).alias("s"), F.col(at["text"]).alias("text"))
    chosen, _ = plan(sizes(slim, ["doc_id", "s"]), "s")
    sized = sizes(inner.withColumn("_t", F.col(at["text"])), inner.columns, "_t").withColumn("doc_id", F.col(at["doc_id"])).withColumn("s", F.array(at["source"]))
    taken = take(sized, chosen, "s").filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS place
  FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (
  SELECT source, source_size, least(cap, w * (SELECT coalesce(arg_min(level, place) FILTER (cap > level * w), arg_max(level, place)) FROM c)) AS target FROM c
), f AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM q
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END AS part FROM f
), h AS (
  SELECT *, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)) AS hash FROM d
), r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS through,
         sum(size) OVER (PARTITION BY source, hash) AS tied FROM h
)
SELECT r.doc_id, r.size, p.source_size, p.target,
       CAST(r.size * (p.whole + CASE WHEN 2 * r.through - r.tied <= 2 * p.part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source
"""
