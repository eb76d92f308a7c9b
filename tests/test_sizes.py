"""What showed on larger tables only."""

import random
import time

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import state, stories, vectors


def test_equal_similarities_go_to_the_least_story(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "vec_id bigint, embedding array<double>")
    # rounded to four places all are 0.6; before rounding b is nearer than a
    t = spark.createDataFrame([("a", [0.6, 0.8, 0.0]), ("b", [0.60001, 0.79999, 0.0]), ("c", [0.60002, 0.79998, 0.0])], "story string, centroid array<double>")
    out = vectors.nearest(v, t, "vec_id", "embedding", "story", "centroid", 2, 0.2).orderBy("rank").collect()
    assert [(r.story, r.sim) for r in out] == [("a", 0.6), ("b", 0.6)]


def test_long_days_are_packed_in_linear_time(spark):
    d = spark.range(400_000).select(F.lit("d").alias("day"), F.col("id").alias("o"), (600 + F.col("id") * 7919 % 4000).alias("w"))
    began = time.time()
    out = state.pack(d, "day", "o", "w").orderBy("o").select("w", "chunk").toPandas()
    assert time.time() - began < 60
    chunk, n, total, want = 0, 0, 0, []
    for w in out["w"]:
        fresh = n >= 40 or (n > 0 and total + w > 120_000)
        chunk, n, total = (chunk + 1, 1, int(w)) if fresh else (chunk, n + 1, total + int(w))
        want.append(chunk)
    assert len(want) == 400_000 and list(out["chunk"]) == want


def pairs_by_all(spark, labels):
    d = labels.select(F.col("label").alias("a")).crossJoin(labels.select(F.col("label").alias("b"))).filter("a < b")
    return d.filter(X.similar_labels(F.col("a"), F.col("b")))


def test_pairs_of_rare_words_join_what_all_pairs_join(spark):
    rng = random.Random(5)
    words = [f"w{i}x" for i in range(30)]
    labels = sorted({" ".join(rng.choice(words[: rng.choice([3, 8, 30])]) for _ in range(rng.randrange(1, 11))) for _ in range(300)} | {"The of", "", "W1x w0x"})
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    from corpusloom.operators.graph import components

    got, want = components(stories.similar_pairs(df)), components(pairs_by_all(spark, df))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_common_word_makes_no_pairs(spark):
    df = spark.range(3000).select(F.concat(F.lit("de la "), *[F.concat(F.lit(f" u{j}q"), F.col("id").cast("string")) for j in range(6)]).alias("label"))
    pairs = stories.similar_pairs(df)
    assert pairs.count() == 0
    plan = pairs._jdf.queryExecution()
    assert "CartesianProduct" not in plan.toString() and "NestedLoop" not in plan.toString()


def test_titles_are_compared_whole(spark, tmp_path):
    from corpusloom.plans import texts

    # of the first 60 characters both made one label
    start = "harbour council budget vote delayed again after protest march"
    titles = [f"{start} {end}" for end in ("by alpha brewery strikers near riverside quarter yesterday morning", "while mountain glaciers retreat faster than forecast models")]
    rows = [(i, f"http://u/{i}", f"<html><head><title>{t}</title></head><body><p>x</p></body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = texts.label_cluster_merge(spark, str(tmp_path)).collect()
    assert sorted((r.label, r.n_labels, r.n_ids) for r in out) == [(t, 1, 1) for t in titles]
