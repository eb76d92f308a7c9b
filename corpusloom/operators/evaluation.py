"""Evaluation of labels, deterministic samples, strata and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import text as X
from .windows import ranked


def jaccard(a: Column, b: Column) -> Column:
    """Size of the intersection over that of the union; 1 for two empty sets."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def agreement(pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of identical sets, mean Jaccard, and both weighted; pairs: ours, theirs (arrays), weight."""
    same = (F.size(F.array_union("ours", "theirs")) == F.size(F.array_intersect("ours", "theirs"))).cast("int")
    j = jaccard(F.col("ours"), F.col("theirs"))
    agg = [F.count("*").alias("n"), M.places(F.avg(same), 4).alias("exact"), M.places(F.avg(j), 4).alias("jaccard"), M.places(F.sum(same * F.col("weight")) / F.sum("weight"), 4).alias("weighted_exact"), M.places(F.sum(j * F.col("weight")) / F.sum("weight"), 4).alias("weighted_jaccard")]
    return pairs.groupBy(*keys).agg(*agg) if keys else pairs.agg(*agg)


def confusion(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """Counts of a two-by-two table."""
    return pairs.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def consistency(verdicts: DataFrame, twins: DataFrame) -> DataFrame:
    """How often twin items got equal labels, by kind; twins: item_id, twin_of, kind."""
    a = verdicts.select(F.col("item_id"), F.sort_array("labels").alias("x"))
    b = verdicts.select(F.col("item_id").alias("twin_of"), F.sort_array("labels").alias("y"))
    return twins.join(a, "item_id").join(b, "twin_of").groupBy("kind").agg(F.count_if(F.col("x") == F.col("y")).alias("same"), F.count("*").alias("n"))


def strata(df: DataFrame, rules: list[tuple[str, Column]], rest: str = "rest") -> DataFrame:
    """The first stratum whose rule holds; null rules don't hold, so every row has one."""
    out = None
    for name, rule in rules:
        rule = F.coalesce(rule, F.lit(False))
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return df.withColumn("stratum", out.otherwise(rest))


def check_frame(strata_rows: DataFrame, expected: int) -> DataFrame:
    """Counts per stratum; fails if they don't sum to the frame."""
    n = strata_rows.groupBy("stratum").agg(F.count("*").alias("n"))
    ok = n.agg(F.assert_true(F.sum("n") == expected, F.lit("strata don't cover the frame")).alias("ok"))
    return n.join(F.broadcast(ok)).drop("ok")  # one row


def hash_sample(df: DataFrame, key: str, n: int, groups: list[str] | None = None) -> DataFrame:
    """The n rows of least FNV-1a hash of their key, per group."""
    hashed = df.withColumn("hash", X.fnv1a(F.col(key).cast("string")))
    return ranked(hashed, groups, ["hash", key], n) if groups else hashed.orderBy("hash", key).limit(n)


def sha_sample(df: DataFrame, key: str, salt: str, sizes: Column, groups: list[str]) -> DataFrame:
    """Per group as many rows as sizes says, in the order of a salted SHA-256."""
    hashed = df.withColumn("hash", F.sha2(F.concat(F.col(key).cast("string"), F.lit("|" + salt)), 256)).withColumn("_n", sizes)
    from pyspark.sql import Window

    w = Window.partitionBy(*groups).orderBy("hash", key)
    return hashed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.col("_n")).drop("_n")


def weights(sample: DataFrame, frame: DataFrame, stratum: str = "stratum") -> DataFrame:
    """Rows of a sample with the weight of their stratum, size of the frame over size of the sample."""
    big = frame.groupBy(stratum).agg(F.count("*").alias("_frame"))
    small = sample.groupBy(stratum).agg(F.count("*").alias("_sample"))
    return sample.join(big.join(small, stratum).select(stratum, (F.col("_frame") / F.col("_sample")).alias("weight")), stratum)


def verdict_errors(verdicts: DataFrame, expected: DataFrame) -> DataFrame:
    """Items without a verdict, verdicts without an item, and items with several."""
    n = verdicts.groupBy("item_id").agg(F.count("*").alias("n"))
    both = expected.select("item_id").distinct().withColumn("_e", F.lit(True)).join(n, "item_id", "full_outer")
    error = F.when(F.col("n").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.col("n") > 1, "repeated")
    return both.select("item_id", error.alias("error")).filter("error is not null")


def arm_effect(items: DataFrame) -> DataFrame:
    """Rate of empty labels inside and outside an arm, and the gap in percentage points; items: arm (boolean), empty (boolean)."""
    rate = lambda inside: F.avg(F.when(F.col("arm") == inside, F.col("empty").cast("int")))
    return items.agg(M.places(rate(True), 4).alias("inside"), M.places(rate(False), 4).alias("outside")).withColumn("gap_pp", M.places((F.col("inside") - F.col("outside")) * 100, 2))


def health(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """Ok, warn or fail per measure; limits: name, warn, fail; a measure at its limit is past it."""
    state = F.when(F.col("value").isNull() | (F.col("value") >= F.col("fail")), "fail").when(F.col("value") >= F.col("warn"), "warn").otherwise("ok")
    return limits.join(measures, "name", "left").select("name", "value", state.alias("state"))


def worst(states: DataFrame) -> DataFrame:
    level = F.max(F.when(F.col("state") == "fail", 2).when(F.col("state") == "warn", 1).otherwise(0))
    return states.agg(F.element_at(F.array(F.lit("ok"), F.lit("warn"), F.lit("fail")), level + 1).alias("state"))


def inference_health(receipts: DataFrame) -> DataFrame:
    """The latest receipt per stage, last success and failure, and a status; receipts: stage, attempt, observed, severity, ok."""
    last = F.max_by("ok", F.struct("attempt", "observed", "severity"))
    rows = receipts.groupBy("stage").agg(last.alias("ok"), F.max(F.when(F.col("ok"), F.col("observed"))).alias("last_success"), F.max(F.when(~F.col("ok"), F.col("observed"))).alias("last_failure"), F.count("*").alias("attempts"))
    return rows.withColumn("status", F.when(F.col("ok"), "healthy").when(F.col("last_success").isNull(), "failing").otherwise("degraded"))


def failure_code(message: Column, status: Column) -> Column:
    """Reason code of a failed call."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(status.isin(401, 403) | m.rlike("api key|unauthori|forbidden"), "auth").when(m.rlike("credit|budget|quota"), "budget")
        .when((status == 429) | m.rlike("rate limit"), "rate-limit").when((status >= 500) | m.rlike("timeout|timed out|network|econn"), "unavailable").otherwise("invalid-response")
    )


def news_coverage(sources: DataFrame, items: DataFrame) -> DataFrame:
    """Per source items, with excerpts, headlines only, unreadable, and the latest; sources without items count 0."""
    n = items.groupBy("source_id").agg(F.count("*").alias("eligible"), F.count_if(F.col("extract") == "body").alias("with_excerpts"), F.count_if(F.col("extract") == "headline-only").alias("headline_only"), F.count_if(F.col("extract") == "failed").alias("unreadable"), F.max("published").alias("latest"))
    out = sources.select("source_id").join(n, "source_id", "left")
    return out.fillna(0, ["eligible", "with_excerpts", "headline_only", "unreadable"])
