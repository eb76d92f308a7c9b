"""Enrichment: dimension lookups, late metrics, quoted originals, inheritance, corrections, precedence.

Joins are plain equi-joins; small dimensions are left to the optimizer's size-checked broadcast, and
skewed keys to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import ranked


def with_author(posts: DataFrame, authors: DataFrame) -> DataFrame:
    """Author columns; an unknown author is tolerated."""
    return posts.join(authors, "author_id", "left")


def house_only(posts: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Posts of roster accounts, and the others; an unknown status counts as house."""
    house = F.coalesce(F.col(status), F.lit("house")) == "house"
    return posts.filter(house), posts.filter(~house)


def with_metrics(posts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Engagement refreshed later if present and available, else as captured; a retweet has none.

    metrics: post_id, refreshed, unavailable.
    """
    joined = posts.join(metrics.select("post_id", "refreshed", "unavailable"), "post_id", "left")
    fresh = F.when(~F.coalesce(F.col("unavailable"), F.lit(False)), F.col("refreshed"))
    value = F.when(F.col("type") == "retweet", F.lit(0)).otherwise(F.coalesce(fresh, F.col("engagement"), F.lit(0)))
    return joined.withColumn("engagement", value.cast("bigint")).withColumn("metrics_source", F.when(F.col("type") == "retweet", "none").when(fresh.isNotNull(), "refreshed").otherwise("capture")).drop("refreshed", "unavailable")


def with_topics(posts: DataFrame, assignment: DataFrame) -> DataFrame:
    """One row per post and topic; posts without a topic keep one row."""
    return posts.join(assignment, "post_id", "left")


def unseen(batch: DataFrame, archive: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a batch whose key the archive lacks, each once."""
    return batch.dropDuplicates([key]).join(archive.select(key).distinct(), key, "left_anti")


def most_referenced(posts: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """Referenced ids that nothing holds yet, the most referenced first; a limit makes a top-k."""
    out = posts.filter("ref_id is not null").groupBy("ref_id").agg(F.count("*").alias("n")).join(known.select(F.col("post_id").alias("ref_id")).distinct(), "ref_id", "left_anti")
    return out.orderBy(F.desc("n"), F.asc("ref_id")).limit(limit) if limit else out


def inherit_topics(posts: DataFrame, assignment: DataFrame, days: int = 2) -> DataFrame:
    """A retweet takes the topics of its original from the same day or so many before; others keep theirs."""
    posts = posts.select("post_id", "type", "ref_id", "day")
    own = posts.filter("type <> 'retweet'").join(assignment, "post_id").select("post_id", "macro", "sub", F.lit(False).alias("inherited"))
    original = posts.select(F.col("post_id").alias("ref_id"), F.col("day").alias("ref_day"))
    gap = F.datediff(F.col("day"), F.col("ref_day"))
    reposts = posts.filter("type = 'retweet'").join(original, "ref_id").filter(gap.between(0, days))
    taken = reposts.join(assignment.withColumnRenamed("post_id", "ref_id"), "ref_id").select("post_id", "macro", "sub", F.lit(True).alias("inherited"))
    return own.union(taken)


def resolve_context(posts: DataFrame, store: DataFrame, archive: DataFrame) -> DataFrame:
    """Text of the referenced post: embedded, else from the side store, else from the archive."""
    a = store.select(F.col("post_id").alias("ref_id"), F.col("text").alias("_store"))
    b = archive.select(F.col("post_id").alias("ref_id"), F.col("text").alias("_archive"))
    joined = posts.join(a, "ref_id", "left").join(b, "ref_id", "left")
    by = F.when(F.col("embedded").isNotNull(), "embedded").when(F.col("_store").isNotNull(), "store").when(F.col("_archive").isNotNull(), "archive").otherwise("none")
    relevant = F.col("type").isin("quote", "reply")
    return joined.withColumn("context", F.when(relevant, F.coalesce("embedded", "_store", "_archive"))).withColumn("context_source", F.when(relevant, by).otherwise("none")).drop("_store", "_archive")


def by_id_or_reference(posts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Posts that are an anchor, or refer to one, as two equi-joins."""
    own = posts.join(anchors.withColumnRenamed("anchor", "post_id"), "post_id").select("post_id", "story")
    by_ref = posts.join(anchors.withColumnRenamed("anchor", "ref_id"), "ref_id").select("post_id", "story")
    return own.union(by_ref).distinct()


def only_match(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Value of the right side where exactly one row there matches."""
    unique = right.groupBy(*on).agg(F.count("*").alias("_n"), F.min(value).alias(value)).filter("_n = 1").drop("_n")
    return left.join(unique, on, "left")


def live_over_nightly(live: DataFrame, nightly: DataFrame) -> DataFrame:
    """One interpretation per post from two sources.

    Both: post_id, topics, completed, corrected, pending, context_version.  The nightly one is passed over
    if it is pending and not corrected; the live one wins against an uncorrected nightly one if it is
    corrected itself, or completed with a newer context.
    """
    value = ["topics", "completed", "corrected", "pending", "context_version"]
    x, y = live.alias("x"), nightly.alias("y")
    both = x.join(y, F.col("x.post_id") == F.col("y.post_id"), "full_outer")
    has_x, has_y = F.col("x.post_id").isNotNull(), F.col("y.post_id").isNotNull()
    passed = F.coalesce(F.col("y.pending") & ~F.col("y.corrected"), F.lit(False))
    newer = F.col("x.corrected") | (F.col("x.completed") & (F.col("x.context_version") > F.col("y.context_version")))
    take_live = has_x & (~has_y | passed | (~F.col("y.corrected") & newer))
    source = F.when(take_live, "live").when(has_y & ~passed, "nightly").when(has_y, "pending")
    cols = [F.when(source == "live", F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")).alias(c) for c in value]
    return both.select(F.coalesce("x.post_id", "y.post_id").alias("post_id"), source.alias("source"), *cols)


def apply_corrections(assignment: DataFrame, posts: DataFrame, corrections: DataFrame, days: int = 2) -> DataFrame:
    """Topics after human corrections, which also reach retweets of the same day and so many after.

    corrections: post_id, filed, correction_id, topics; the latest filing wins.  Result: post_id, topics, via.
    """
    latest = ranked(corrections, "post_id", [F.desc("filed"), F.desc("correction_id")], 1, "_r").select("post_id", F.col("topics").alias("fixed"))
    origin = latest.join(posts.select("post_id", "day"), "post_id")
    at = origin.select(F.col("post_id").alias("ref_id"), F.col("fixed").alias("fixed"), F.col("day").alias("ref_day"))
    spread = posts.filter("type = 'retweet'").join(at, "ref_id").filter(F.datediff("day", "ref_day").between(0, days)).select("post_id", "fixed", F.lit("repost").alias("via"))
    direct = latest.select("post_id", "fixed", F.lit("direct").alias("via"))
    every = direct.union(spread.join(direct.select("post_id"), "post_id", "left_anti"))
    joined = assignment.join(every, "post_id", "full_outer")
    return joined.select("post_id", F.coalesce("fixed", "topics").alias("topics"), F.coalesce("via", F.lit("model")).alias("via"))


def overlay_roster(listed: DataFrame, roster: DataFrame) -> DataFrame:
    """List members with the roster's tags by handle; roster accounts that left the list are stale."""
    a = listed.withColumn("_k", F.lower("handle")).alias("a")
    b = roster.withColumn("_k", F.lower("handle")).alias("b")
    on_list, known = F.col("a._k").isNotNull(), F.col("b._k").isNotNull()
    return a.join(b, F.col("a._k") == F.col("b._k"), "full_outer").select(
        F.coalesce("a._k", "b._k").alias("handle"), F.col("a.author_id"), F.coalesce("b.member", "a.name").alias("member"), F.col("b.status"),
        on_list.alias("on_list"), (~on_list).alias("stale"), (on_list & ~known).alias("untagged"),
    )


def amplifiers(posts: DataFrame) -> DataFrame:
    """Retweets per post, 0 where there are none."""
    n = posts.filter("type = 'retweet' and ref_id is not null").groupBy(F.col("ref_id").alias("post_id")).agg(F.count("*").alias("amplifiers"))
    return posts.join(n, "post_id", "left").withColumn("amplifiers", F.coalesce("amplifiers", F.lit(0)).cast("bigint"))


def overlap_pairs(sets: DataFrame, key: str, members: str, share: float = 0.5) -> DataFrame:
    """Pairs of sets that share at least half of the smaller, through their members and not all pairs."""
    flat = sets.select(F.col(key).alias("k"), F.size(members).alias("n"), F.explode(F.array_distinct(members)).alias("m"))
    a, b = flat.alias("a"), flat.alias("b")
    both = a.join(b, (F.col("a.m") == F.col("b.m")) & (F.col("a.k") < F.col("b.k"))).groupBy(F.col("a.k").alias("a"), F.col("b.k").alias("b")).agg(F.count("*").alias("shared"), F.least(F.first("a.n"), F.first("b.n")).alias("smaller"))
    return both.filter(F.col("shared") >= share * F.col("smaller"))


def topic_pairs(topics: Column, taxonomy: Column) -> Column:
    """Valid topics (array of macro/sub structs): unknown macros go, unknown subs become null, repeats go.

    taxonomy: map of macro to its subs.  A macro written "macro/sub" is taken apart.
    """
    split = F.transform(topics, lambda t: F.when(t["macro"].contains("/") & t["sub"].isNull(), F.struct(F.split(t["macro"], "/")[0].alias("macro"), F.split(t["macro"], "/")[1].alias("sub"))).otherwise(F.struct(t["macro"].alias("macro"), t["sub"].alias("sub"))))
    known = F.filter(split, lambda t: F.try_element_at(taxonomy, t["macro"]).isNotNull())
    fixed = F.transform(known, lambda t: F.struct(t["macro"].alias("macro"), F.when(F.array_contains(F.try_element_at(taxonomy, t["macro"]), t["sub"]), t["sub"]).alias("sub")))
    return F.array_distinct(fixed)


def union_topics(*lists: Column) -> Column:
    """Union of topic lists in their order, the first of equals wins."""
    return F.array_distinct(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]))


def versioned_append(news: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of a batch that are new or whose content hash changed, with the next version of the store.

    Both: id, hash, ...; news has version too.  Equal content adds nothing.
    """
    latest = ranked(news, "id", F.desc("version"), 1, "_r").select("id", F.col("hash").alias("_old"))
    version = news.agg(F.coalesce(F.max("version"), F.lit(0)).alias("_v"))
    fresh = batch.join(latest, "id", "left").filter(F.col("_old").isNull() | (F.col("_old") != F.col("hash")))
    return fresh.join(F.broadcast(version)).withColumn("version", F.col("_v") + 1).withColumn("change", F.when(F.col("_old").isNull(), "added").otherwise("changed")).drop("_old", "_v")  # one row


def upsert_metrics(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the first pass stay unless the second pass is due to replace them; tombstones count as rows."""
    both = old.alias("o").join(new.alias("n"), "post_id", "full_outer")
    second = F.coalesce(F.col("n.pass72"), F.lit(False)) & ~F.coalesce(F.col("o.pass72"), F.lit(False))
    use_new = F.col("o.refreshed").isNull() & F.col("o.unavailable").isNull() | second
    pick = lambda c: F.when(use_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    return both.select("post_id", pick("refreshed"), pick("unavailable"), pick("pass72"))


def merge_counters(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Three-way merge of counters: what either side added to the base is added."""
    b, x, y = (d.select(key, *[F.col(f).alias(f"{p}_{f}") for f in fields]) for p, d in (("b", base), ("x", ours), ("y", theirs)))
    every = b.join(x, key, "full_outer").join(y, key, "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return every.select(key, *[(zero(f"x_{f}") + zero(f"y_{f}") - zero(f"b_{f}")).alias(f) for f in fields])
