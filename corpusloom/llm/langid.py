"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

Vectors.  A text's letters (a to z after lower-casing, and all bytes of other scripts; everything
else is one space) give n-grams of one to ``GRAM`` bytes, hashed into ``DIM`` columns and weighted
(1 + log tf) * idf, then normalised.  Document frequencies count all documents that may be learned
from, summed per task before the shuffle.

Centroids.  Each language has up to ``CLUSTERS`` centroids, from spherical k-means over a bounded
sample (``SAMPLE`` documents of least hash per language; the only bound, and only for this fit).  A
text gets the language of the centroid of greatest cosine.  It is ``rejected`` if its cosine distance
exceeds the radius of that centroid, ``SLACK`` times the farthest of the sample's own documents.

Defined results: null texts and texts without a letter are ``und`` with score 0, as are all texts if
there is nothing to learn from.  Rows are judged one by one, whatever their source or number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import bounded_sample, crc_mod, small_batches, table

DIM_BITS, GRAM, CLUSTERS, SAMPLE, SLACK = 12, 4, 4, 400, 1.15
DIM = 1 << DIM_BITS
MAX_LANGUAGES = 500
_ODD = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263)]
_KEPT = np.zeros(256, bool)
_KEPT[97:123] = True
_KEPT[128:] = True


def counts(b: K.Block) -> np.ndarray:
    """Occurrences of each hashed n-gram, one row per document."""
    n = len(b.off) - 1
    data = K.lowered(b.data)
    letter = _KEPT[data]
    data = np.where(letter, data, 32).astype(np.uint8)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other bytes the first stays, as a space
    doc = np.repeat(np.arange(n), np.diff(b.off))[keep]
    data = data[keep].astype(np.uint32)
    out = np.zeros(n * DIM, np.int64)
    value = np.zeros(len(data), np.uint32)
    for k in range(min(GRAM, len(data))):
        m = len(data) - k
        value = value[:m] | data[k:] << np.uint32(8 * k)
        column = (value * _ODD[k] + np.uint32(k)) >> np.uint32(32 - DIM_BITS)
        whole = doc[:m] == doc[k:]
        out += np.bincount((doc[:m] * DIM + column)[whole], minlength=n * DIM)
    return out.reshape(n, DIM)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * idf
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def document_frequency(df: DataFrame, text: str = "text") -> np.ndarray:
    """How many documents of df hold each n-gram; the last number counts the documents."""
    def run(batches):
        K.own("langid")
        total = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for b in K.blocks(batch.column(0)):
                count = counts(b)
                total[:DIM] += (count > 0).sum(0)
                total[DIM] += len(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1, dtype=np.int32)), pa.array(total)], names=["at", "n"])

    rows = df.select(text).mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()  # DIM + 1 rows
    out = np.zeros(DIM + 1, np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out


def cluster(x: np.ndarray, k: int = CLUSTERS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit length and the greatest cosine distance of their members."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centre = x[[0]]
    while len(centre) < k:  # the next start is far from those before
        far = np.clip(1 - (x @ centre.T).max(1), 0, None) ** 2 + 1e-12
        centre = np.concatenate([centre, x[[rng.choice(len(x), p=far / far.sum())]]])
    for _ in range(25):
        own = (x @ centre.T).argmax(1)
        fresh = np.stack([x[own == i].sum(0) if (own == i).any() else centre[i] for i in range(k)])
        fresh /= np.maximum(np.linalg.norm(fresh, axis=1, keepdims=True), 1e-12)
        if np.allclose(fresh, centre, atol=1e-6):
            break
        centre = fresh
    own, best = (x @ centre.T).argmax(1), (x @ centre.T).max(1)
    return centre, np.array([1 - best[own == i].min() if (own == i).any() else 0.0 for i in range(k)])


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict:
    """The model: languages, one per centroid, centroids, radii and idf."""
    small_batches(df.sparkSession)
    df = df.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    frequency = document_frequency(df)
    idf = np.log((1 + frequency[DIM]) / (1 + frequency[:DIM])) + 1
    chosen = bounded_sample(df.select("k", "lang"), "lang", "k", SAMPLE)
    chosen = chosen.select(F.col("k").alias("k_"), F.col("lang").alias("lang_"))
    few = chosen.limit(MAX_LANGUAGES * SAMPLE + 1).count() <= MAX_LANGUAGES * SAMPLE
    if not few:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # SAMPLE ids per language are broadcast, so that no other text is shuffled; of an id that repeats one row is taken
    rows = df.join(F.broadcast(chosen), df["k"].eqNullSafe(chosen["k_"]) & (df["lang"] == chosen["lang_"]), "left_semi")
    rows = rows.groupBy("k", "lang").agg(F.min("text").alias("text"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        x = np.concatenate([vectors(counts(b), idf) for b in K.blocks(pa.array(pdf["text"]))])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": [], "radius": []})
        centre, radius = cluster(x)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": list(centre.astype(float)), "radius": radius})

    found = rows.groupBy("lang").applyInPandas(fit, "lang string, centre array<double>, radius double").limit(MAX_LANGUAGES * CLUSTERS + 1).collect()
    if len(found) > MAX_LANGUAGES * CLUSTERS:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    return {"lang": [r["lang"] for r in found], "centre": np.array([r["centre"] for r in found], np.float32).reshape(-1, DIM), "radius": np.array([r["radius"] for r in found]), "idf": idf}


def predict(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """df without text, with lang_pred, score (cosine) and rejected."""
    small_batches(df.sparkSession)
    new = ["lang_pred", "score", "rejected"]
    keep = [c for c in df.columns if c not in {text, *new}]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), "lang_pred string, score double, rejected boolean"])
    names = np.array([*model["lang"], "und"], object)

    def run(batches):
        K.own("langid")
        for batch in batches:
            lettered = batch.column(batch.num_columns - 2).fill_null(False).to_numpy(zero_copy_only=False)
            best, cosine = [np.zeros(0, int)], [np.zeros(0)]
            if len(model["lang"]):
                for b in K.blocks(batch.column(batch.num_columns - 1)):
                    near = vectors(counts(b), model["idf"]) @ model["centre"].T
                    best.append(near.argmax(1))
                    cosine.append(near.max(1).astype(float))
            else:
                best.append(np.full(batch.num_rows, -1))
                cosine.append(np.zeros(batch.num_rows))
            best, cosine = np.concatenate(best), np.clip(np.concatenate(cosine), 0, 1)
            best[~lettered], cosine[~lettered] = -1, 0
            radius = np.append(model["radius"], 0)[best]
            made = [pa.array(names[best], pa.string()), pa.array(cosine), pa.array((best < 0) | (1 - cosine > SLACK * radius))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*keep, *new])

    return df.select(*keep, F.col(text).rlike(r"\p{L}").alias("_lettered"), F.col(text).alias("_text")).mapInArrow(run, schema)


def op2_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.filter(~held))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
