"""Stories and taxonomy upkeep: label clusters, merges, promotion, elevation, retirement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .graph import components, cut
from .windows import ranked


def similar_pairs(labels: DataFrame) -> DataFrame:
    """Edges (a, b) that join all similar labels: those of the same words to the least of them, and all similar pairs of these.

    Words are put in order of rarity.  Similar sets of x <= y words share (x + y) / 3 of them, or all x where y <= x + 2;
    so the first word in common is among the rarest x / 3 + 1 of one and y / 2 + 1 (or 3) of the other, and enough
    words are left from there on.  Only pairs that meet in such a word are compared, common words make none.
    """
    sets = labels.select("label", F.array_sort(X.label_tokens(F.col("label"))).alias("set")).filter(F.size("set") > 0)
    heads = cut(sets.groupBy("set").agg(F.min("label").alias("head")))
    same = sets.join(heads, "set").filter("label <> head").select(F.col("head").alias("a"), F.col("label").alias("b"))
    flat = heads.select("head", F.explode("set").alias("w"))
    rare = flat.join(flat.groupBy("w").agg(F.count("*").alias("n")), "w").groupBy("head").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("s"))
    rare = cut(rare.select("head", F.size("s").alias("k"), F.col("s.w").alias("s")))
    places = lambda s: rare.select(F.col("head").alias(f"{s}_head"), F.col("k").alias(f"{s}_k"), F.col("s").alias(f"{s}_s"), F.posexplode("s").alias(f"{s}_i", "w"))
    x = places("x").filter("x_i < x_k - ceil(2 * x_k / 3) + 1")
    y = places("y").filter("y_i < y_k - least(ceil(y_k / 2), greatest(1, y_k - 2)) + 1")
    left = F.least(F.col("x_k") - F.col("x_i"), F.col("y_k") - F.col("y_i"))
    near = F.col("y_k") - F.col("x_k") <= 2
    enough = (3 * left >= F.col("x_k") + F.col("y_k")) | ((left == F.col("x_k")) & near)
    once = (F.col("x_k") < F.col("y_k")) | ((F.col("x_k") == F.col("y_k")) & (F.col("x_head") < F.col("y_head")))
    met = x.join(y, "w").filter(once & enough).withColumn("both", F.size(F.array_intersect("x_s", "y_s")))
    alike = (3 * F.col("both") >= F.col("x_k") + F.col("y_k")) | ((F.col("both") == F.col("x_k")) & near)
    return met.filter(alike).select(F.col("x_head").alias("a"), F.col("y_head").alias("b")).union(same)


def label_clusters(labels: DataFrame) -> DataFrame:
    """Groups of labels that are similar, across days: (cluster, label, n, ids, days).

    labels: label, day, ids.  A group is named by its label with the most ids, of equals the least.
    """
    flat = labels.groupBy("label").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"), F.collect_set("day").alias("days"))
    roots = components(cut(similar_pairs(flat.select("label"))))
    own = flat.join(roots.withColumnRenamed("node", "label"), "label", "left").withColumn("root", F.coalesce("root", "label"))
    return own.groupBy("root").agg(
        F.min_by("label", F.struct(-F.size("ids"), "label")).alias("label"), F.sort_array(F.collect_set("label")).alias("labels"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("days")))).alias("days"),
    ).drop("root")


def apply_merges(groups: DataFrame, merges: DataFrame) -> DataFrame:
    """Groups folded along merge edges (a, b); the one with the most posts survives and lists the others.

    groups: key, posts, ids.
    """
    roots = components(merges)
    own = groups.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return own.groupBy("root").agg(
        F.min_by("key", F.struct(-F.col("posts"), "key")).alias("key"), F.sort_array(F.collect_list("key")).alias("_all"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).cast("bigint").alias("posts"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"),
    ).select("key", "posts", "ids", F.array_remove(F.col("_all"), F.col("key")).alias("merged_from"))


def candidates(posts: DataFrame) -> DataFrame:
    """Per story posts, people, days, first and last seen and ids in order of time; posts: story, post_id, created, day, member."""
    return posts.groupBy("story").agg(
        F.countDistinct("post_id").alias("posts"), F.countDistinct("member").alias("members"), F.countDistinct("day").alias("days"),
        F.min("created").alias("first_seen"), F.max("created").alias("last_seen"), F.transform(F.array_sort(F.collect_set(F.struct("created", "post_id"))), lambda x: x["post_id"]).alias("ids"),
    )


def promote(scored: DataFrame, taxonomy: DataFrame, posts: int = 5, members: int = 3, days: int = 2, cap: int = 8) -> DataFrame:
    """Stories that become subtopics, the largest first, with the reason for each that doesn't.

    scored: story, macro, posts, members, days; taxonomy: macro, sub.  Of several with one slug under one
    macro the largest counts.
    """
    known = taxonomy.select("macro").distinct().withColumn("_m", F.lit(True))
    there = taxonomy.select("macro", F.col("sub").alias("slug")).distinct().withColumn("_s", F.lit(True))
    own = scored.withColumn("slug", X.slug(F.col("story"))).join(known, "macro", "left").join(there, ["macro", "slug"], "left")
    twin = F.row_number().over(Window.partitionBy("macro", "slug").orderBy(F.desc("posts"), "story"))
    own = own.withColumn("_twin", twin)
    reason = (
        F.when(F.col("_m").isNull(), "unknown macro").when(F.col("_s").isNotNull(), "exists").when(F.col("posts") < posts, "few posts")
        .when(F.col("members") < members, "few members").when(F.col("days") < days, "few days").when(F.col("_twin") > 1, "twin")
    )
    own = own.withColumn("reason", reason)
    good = own.filter("reason is null").orderBy(F.desc("posts"), F.asc("story")).limit(cap).select("story").withColumn("promoted", F.lit(True))
    out = own.join(good, "story", "left")
    return out.select("story", "macro", "slug", "posts", "members", "days", F.coalesce("promoted", F.lit(False)).alias("promoted"), F.when(F.col("promoted").isNull(), F.coalesce("reason", F.lit("cap"))).alias("reason"))


def elevate(subs: DataFrame, share: float = 0.6, factor: float = 3.0, least_share: float = 0.25, least_posts: int = 8, siblings: int = 3) -> DataFrame:
    """Whether a sub outgrows its macro: most of its posts, or thrice the median of its live siblings.

    subs: macro, sub, posts, members.  A median that leaves one row out: siblings are joined and aggregated.
    """
    total = subs.groupBy("macro").agg(F.sum("posts").alias("total"))
    own = subs.join(total, "macro").withColumn("share", F.col("posts") / F.nullif(F.col("total"), F.lit(0)))
    other = subs.filter("posts > 0").select(F.col("macro").alias("_m"), F.col("sub").alias("_s"), F.col("posts").alias("_p"))
    around = subs.join(other, (F.col("macro") == F.col("_m")) & (F.col("sub") != F.col("_s"))).groupBy("macro", "sub").agg(F.median("_p").alias("sibling_median"), F.count("*").alias("siblings"))
    out = own.join(around, ["macro", "sub"], "left").withColumn("siblings", F.coalesce("siblings", F.lit(0)))
    grown = (F.col("siblings") >= siblings) & (F.col("posts") >= factor * F.col("sibling_median")) & (F.col("posts") >= least_posts) & (F.col("share") >= least_share)
    fit = (F.col("posts") >= least_posts) & (F.col("members") >= 3)
    return out.withColumn("elevate", fit & ((F.col("share") >= share) | F.coalesce(grown, F.lit(False))))


def retire(taxonomy: DataFrame, assignment: DataFrame, classified: DataFrame, as_of: Column, days: int = 21) -> DataFrame:
    """Subs without any post on the classified days, old enough, neither anchored nor dual nor retired.

    taxonomy: macro, sub, entered, retired, dual, anchored; assignment: macro, sub, day; classified: day.
    """
    recent = assignment.filter(F.col("day") > F.date_sub(as_of, days)).select("macro", "sub").distinct()
    n = classified.filter((F.col("day") > F.date_sub(as_of, days)) & (F.col("day") <= as_of)).agg(F.countDistinct("day").alias("n"))
    live = taxonomy.filter(~F.col("retired") & ~F.col("dual") & ~F.col("anchored") & (F.col("entered") <= F.date_sub(as_of, days)))
    return live.join(recent, ["macro", "sub"], "left_anti").join(F.broadcast(n), F.col("n") >= days).drop("n")  # one row


def assignment_counts(assignment: DataFrame) -> DataFrame:
    """Posts and last day per macro and sub."""
    return assignment.groupBy("macro", "sub").agg(F.countDistinct("post_id").alias("posts"), F.max("day").alias("last_seen"))


def merge_emerging(groups: DataFrame, allowed: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Emerging groups of one label whatever its case, ids united; ids outside allowed or in removed go."""
    flat = groups.select(F.lower("label").alias("k"), "label", F.explode("ids").alias("post_id"))
    flat = flat if allowed is None else flat.join(allowed.select("post_id").distinct(), "post_id", "left_semi")
    flat = flat if removed is None else flat.join(removed.select("post_id").distinct(), "post_id", "left_anti")
    return flat.groupBy("k").agg(F.min("label").alias("label"), F.sort_array(F.collect_set("post_id")).alias("ids")).drop("k")


def emerging_rows(groups: DataFrame, posts: DataFrame, as_of: Column, least: int = 3, shown: int = 12) -> DataFrame:
    """People, active people and last use per group; shown if active and large enough, or among the first."""
    from ..functions import timefn as T

    young = T.within_hours(F.col("created"), as_of, 24)
    flat = groups.select("label", F.explode("ids").alias("post_id")).join(posts, "post_id")
    rows = flat.groupBy("label").agg(F.countDistinct("member").alias("members"), F.countDistinct(F.when(young, F.col("member"))).alias("active_members"), F.max("created").alias("last_seen"), F.countDistinct("post_id").alias("posts"))
    rows = rows.withColumn("active", F.col("active_members") > 0).withColumn("threshold", F.col("members") >= least)
    order = [F.desc(F.col("active") & F.col("threshold")), F.desc(F.col("active_members") >= least), F.desc("last_seen"), F.desc("members"), F.asc("label")]
    top = rows.orderBy(*order).limit(shown).select("label", F.lit(True).alias("_top"))
    return rows.join(top, "label", "left").withColumn("visible", (F.col("active") & F.col("threshold")) | F.coalesce("_top", F.lit(False))).drop("_top")


def cap_proposals(proposals: DataFrame, adds: int, retires: int) -> DataFrame:
    """Of each kind of proposal the first so many by posts are applied."""
    w = Window.partitionBy("kind").orderBy(F.desc("posts"), "key")
    cap = F.when(F.col("kind") == "add", adds).when(F.col("kind") == "retire", retires).otherwise(2**31 - 1)
    return proposals.withColumn("place", F.row_number().over(w)).withColumn("applied", F.col("place") <= cap)


def share_rows(posts: DataFrame, as_of: Column, days: int = 7, window: int = 14) -> DataFrame:
    """Per macro and sub posts in the window and the last days, people, days, last seen and share of the macro."""
    age = F.datediff(as_of, F.col("day"))
    near = posts.filter((age >= 0) & (age < window))
    rows = near.groupBy("macro", "sub").agg(
        F.count("*").alias("posts"), F.count_if(age < days).alias("posts7"), F.countDistinct("member").alias("members"), F.countDistinct("day").alias("days"), F.max("day").alias("last_seen")
    )
    total = near.groupBy("macro").agg(F.count("*").alias("total"))
    return rows.join(total, "macro").withColumn("share", F.floor(F.col("posts") / F.col("total") * 1000 + 0.5) / 1000).drop("total")
