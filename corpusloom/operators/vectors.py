"""Vector search: centroids, nearest neighbours, nearest stories, clusters, retrieval quality."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mathfn as M
from .graph import cut
from .windows import ranked

#: Stories whose centroids one task may hold; beyond it they are split.
STORIES_PER_TASK = 4096


def centroids(members: DataFrame, key: str, vector: str, normal: bool = True) -> DataFrame:
    """Mean of the vectors per key, of unit length if normal; members without a vector are ignored.

    Values are summed per key and position with a partial aggregation, so a hot key costs its dimension
    per task and not its rows.
    """
    unit = M.normalise(F.col(vector)) if normal else F.transform(vector, lambda x: x.cast("double"))
    flat = members.filter(F.col(vector).isNotNull()).select(key, F.posexplode(unit).alias("i", "x"))
    means = flat.groupBy(key, "i").agg(F.avg("x").alias("x"))
    out = means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))
    return out.withColumn("centroid", M.normalise(F.col("centroid"))) if normal else out


def nearest(vectors: DataFrame, targets: DataFrame, vector_id: str, vector: str, target_id: str, centroid: str, k: int, least: float, target_limit: int = STORIES_PER_TASK) -> DataFrame:
    """The k most similar targets of each vector, at least so similar: (vector_id, target_id, sim).

    The targets (stories) are counted first; up to target_limit they go to every task as one matrix and
    each Arrow batch is one product.  More of them are dealt out in parts, each part is searched by all
    vectors, and the parts' best are ranked again.
    """
    rows = targets.select(target_id, centroid).limit(target_limit + 1).collect()
    parts = 1 if len(rows) <= target_limit else -(-targets.count() // target_limit)
    if parts > 1:
        dealt = targets.withColumn("_part", F.pmod(F.xxhash64(target_id), F.lit(parts)))
        found = None
        for p in range(parts):
            part = nearest(vectors, dealt.filter(F.col("_part") == p).drop("_part"), vector_id, vector, target_id, centroid, k, least, 4 * target_limit)  # parts are uneven
            found = part if found is None else found.unionByName(part)
        return ranked(found, vector_id, [F.desc("sim"), F.asc(target_id)], k)
    rows.sort(key=lambda r: r[0])
    kinds = [vectors.schema[vector_id].dataType.simpleString(), targets.schema[target_id].dataType.simpleString()]
    shape = f"{vector_id} {kinds[0]}, {target_id} {kinds[1]}, sim double"
    ids = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows], float)

    def run(batches):
        for pdf in batches:
            if not len(pdf) or not len(ids):
                continue
            x = np.stack(pdf[vector].to_numpy()).astype(float)
            sim = np.floor(x @ matrix.T * 1e4 + 0.5) / 1e4  # rounded before the order, so that ties go to the least id
            order = np.argsort(-sim, axis=1, kind="stable")[:, :k]
            best = np.take_along_axis(sim, order, 1)
            i, j = np.nonzero(best >= least)
            yield pd.DataFrame({vector_id: pdf[vector_id].to_numpy()[i], target_id: [ids[t] for t in order[i, j]], "sim": best[i, j]})

    unit = vectors.filter(F.col(vector).isNotNull()).select(vector_id, M.normalise(F.col(vector)).alias(vector))
    return ranked(unit.mapInPandas(run, shape), vector_id, [F.desc("sim"), F.asc(target_id)], k)


def neighbours(vectors: DataFrame, stories: DataFrame, members: DataFrame | None, k: int, least: float = 0.0, story_limit: int = STORIES_PER_TASK) -> DataFrame:
    """Per story the k nearest vectors that aren't its members: (story, vec_id, sim, rank); without members, of all.

    Stories are counted; up to story_limit they go to every task as one matrix, more are dealt out in parts.
    Each Arrow batch is one product and passes on its best k per story only, so pairs are never listed.
    """
    rows = stories.select("story", "centroid").limit(story_limit + 1).collect()
    parts = 1 if len(rows) <= story_limit else -(-stories.count() // story_limit)
    if parts > 1:
        dealt = stories.withColumn("_part", F.pmod(F.xxhash64("story"), F.lit(parts)))
        found = [neighbours(vectors, dealt.filter(F.col("_part") == p).drop("_part"), members, k, least, 4 * story_limit) for p in range(parts)]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out
    rows.sort(key=lambda r: r[0])
    ids, matrix = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    place = {s: i for i, s in enumerate(ids)}
    unit = vectors.filter(F.col("embedding").isNotNull()).select("vec_id", M.normalise(F.col("embedding")).alias("v"))
    if members is not None:
        own = members.groupBy("vec_id").agg(F.collect_set("story").alias("own"))  # a vector is in few stories
        unit = unit.join(own, "vec_id", "left")
    kinds = stories.schema["story"].dataType.simpleString(), vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            if not len(pdf) or not ids:
                continue
            sim = np.floor(np.stack(pdf["v"].to_numpy()) @ matrix.T * 1e4 + 0.5) / 1e4
            if "own" in pdf:
                for i, mine in enumerate(pdf["own"]):
                    for s in mine if mine is not None else ():
                        if s in place:
                            sim[i, place[s]] = -np.inf
            vec = pdf["vec_id"].to_numpy()
            out = []
            for j, s in enumerate(ids):
                best = np.lexsort((vec, -sim[:, j]))[:k]
                best = best[sim[best, j] >= least]
                out.append(pd.DataFrame({"story": [s] * len(best), "vec_id": vec[best], "sim": sim[best, j]}))
            yield pd.concat(out)

    return ranked(unit.mapInPandas(run, f"story {kinds[0]}, vec_id {kinds[1]}, sim double"), "story", [F.desc("sim"), F.asc("vec_id")], k)


def precision_at(ranked_rows: DataFrame, keys: list[str], relevant: Column, ks: tuple[int, ...] = (10, 20, 40)) -> DataFrame:
    """Share of relevant rows among the first k; rows have rank."""
    return ranked_rows.groupBy(*keys).agg(*[M.places(F.avg(F.when(F.col("rank") <= k, relevant.cast("int"))), 4).alias(f"p_at_{k}") for k in ks])


def similarity_scale(scores: DataFrame, key: str, ranks: tuple[int, ...] = (100,)) -> DataFrame:
    """Median similarity per story, and the similarity at given ranks."""
    w = Window.partitionBy(key).orderBy(F.desc("sim"), "vec_id")
    return scores.withColumn("_r", F.row_number().over(w)).groupBy(key).agg(M.places(F.median("sim"), 4).alias("median_sim"), *[F.max(F.when(F.col("_r") == r, F.col("sim"))).alias(f"sim_at_{r}") for r in ranks])


def merge_groups(vectors: np.ndarray, least: float = 0.82) -> list[list[int]]:
    """Agglomerative clusters by centroid linkage: the closest pair merges while its cosine is at least so much.

    Ties go to the lowest indices; centroids are plain means.  Groups are ordered by size, then first member.
    """
    groups = [[i] for i in range(len(vectors))]
    sums = [v.astype(float).copy() for v in vectors]

    def unit(x):
        return x / max(np.linalg.norm(x), 1e-300)

    if not groups:
        return []
    u = np.stack([unit(s) for s in sums])
    sim = u @ u.T
    np.fill_diagonal(sim, -np.inf)
    alive = np.ones(len(groups), bool)
    while alive.sum() > 1:
        flat = np.where(np.triu(np.ones_like(sim, bool), 1), sim, -np.inf)
        i, j = np.unravel_index(int(np.argmax(flat)), flat.shape)
        if flat[i, j] < least:
            break
        groups[i] += groups[j]
        sums[i] = sums[i] + sums[j]
        alive[j] = False
        u[i] = unit(sums[i])
        row = u @ u[i]
        row[~alive] = -np.inf
        row[i] = -np.inf
        sim[i], sim[:, i] = row, row
        sim[j], sim[:, j] = -np.inf, -np.inf
    found = [sorted(g) for g, a in zip(groups, alive, strict=True) if a]
    return sorted(found, key=lambda g: (-len(g), g[0]))


def cluster_pools(vectors: DataFrame, pool: str, least: float = 0.82, most: int = 2000) -> DataFrame:
    """G04 per pool: (pool, vec_id, cluster).  Pools are bounded samples by contract; a larger one is an error."""
    over = vectors.groupBy(pool).agg(F.count("*").alias("n")).filter(F.col("n") > most).limit(1).collect()
    if over:
        raise ValueError(f"pool {over[0][0]!r} has more than {most} vectors: take a sample first (hash_sample)")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id").reset_index(drop=True)
        at = {i: c for c, g in enumerate(merge_groups(np.stack(pdf["embedding"]), least)) for i in g}
        return pd.DataFrame({pool: pdf[pool], "vec_id": pdf["vec_id"], "cluster": [at[i] for i in range(len(pdf))]})

    kind = vectors.schema[pool].dataType.simpleString()
    return vectors.select(pool, "vec_id", "embedding").groupBy(pool).applyInPandas(run, f"{pool} {kind}, vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int")


def assign_clusters(vectors: DataFrame, clustered: DataFrame, pool: str) -> DataFrame:
    """(pool, vec_id, cluster) of all vectors: those of clustered keep their cluster, others get that of the nearest centroid in their pool.

    A pool has as many centroids as a bounded sample has clusters; they are joined as one array.
    """
    fitted = cut(clustered)
    members = vectors.join(fitted, [pool, "vec_id"]).select(F.struct(pool, "cluster").alias("k"), "embedding")
    means = centroids(members, "k", "embedding").groupBy(F.col(f"k.{pool}").alias(pool)).agg(F.array_sort(F.collect_list(F.struct("k.cluster", "centroid"))).alias("means"))
    near = lambda v: F.array_max(F.transform("means", lambda m: F.struct(M.dot(v, m["centroid"]).alias("s"), (-m["cluster"]).alias("c"))))
    rest = vectors.join(fitted, [pool, "vec_id"], "left_anti").join(means, pool).select(pool, "vec_id", M.let(M.normalise(F.col("embedding")), near).alias("n"))
    return fitted.select(pool, "vec_id", "cluster").unionByName(rest.select(pool, "vec_id", (-F.col("n.c")).cast("int").alias("cluster")))


def semantic_context(index: DataFrame, stories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors of the posts that stories hold, and the stories' centroids; stories: story, ids."""
    members = stories.select("story", F.explode("ids").alias("vec_id"))
    held = index.join(members, "vec_id")
    return members, centroids(held.select("story", "embedding"), "story", "embedding")
