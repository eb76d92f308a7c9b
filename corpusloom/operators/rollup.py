"""Rollups: topic by day and group, rolling windows, coverage, volumes, spending.

Groups are multi-valued (an author has several tags), so scopes are exploded; counts of people are exact
distinct counts, which Spark computes with a partial aggregation per distinct key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import timefn as T


def scopes(groups: Column) -> Column:
    """"all" and each of an author's groups, once."""
    return F.array_distinct(F.concat(F.array(F.lit("all")), F.coalesce(groups, F.array().cast("array<string>"))))


def topic_day(posts: DataFrame) -> DataFrame:
    """Day, macro, sub, scope with posts, retweets, members and engagement.

    posts: post_id, day, type, member, groups, engagement, topics (array of macro/sub structs).  A post counts
    once per macro (rows with sub null) however many subs it has, and once per macro and sub.
    """
    macros = F.transform(F.array_distinct(F.transform("topics", lambda t: t["macro"])), lambda m: F.struct(m.alias("macro"), F.lit(None).cast("string").alias("sub")))
    subs = F.filter(F.array_distinct("topics"), lambda t: t["sub"].isNotNull())
    flat = posts.withColumn("t", F.explode(F.concat(macros, subs))).withColumn("scope", F.explode(scopes(F.col("groups"))))
    repost = F.col("type") == "retweet"
    return flat.groupBy("day", F.col("t.macro").alias("macro"), F.col("t.sub").alias("sub"), "scope").agg(
        F.count_if(~repost).alias("posts"), F.count_if(repost).alias("retweets"), F.countDistinct("member").alias("members"), F.sum("engagement").cast("bigint").alias("engagement")
    )


def topic_windows(posts: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Per macro the counts today, in the last 24 hours and in the week, people, and the daily trend.

    posts: post_id, created, day, member, engagement, macro (one row per post and macro).
    """
    today = T.et_date(as_of)
    back = F.datediff(today, F.col("day"))
    young = T.within_hours(F.col("created"), as_of, 24, future=True)
    week = back.between(0, days - 1)
    daily = [F.count_if(back == days - 1 - i).alias(f"d{i}") for i in range(days)]
    people = [F.countDistinct(F.when(back == days - 1 - i, F.col("member"))).alias(f"p{i}") for i in range(days)]
    out = posts.filter(week).groupBy("macro").agg(
        F.count_if(back == 0).alias("n_today"), F.count_if(young).alias("n24"), F.count("*").alias("n_week"),
        F.coalesce(F.sum(F.when(young, F.col("engagement"))), F.lit(0)).cast("bigint").alias("eng24"), F.sum("engagement").cast("bigint").alias("eng_week"),
        F.countDistinct(F.when(young, F.col("member"))).alias("m24"), F.countDistinct("member").alias("m_week"), *daily, *people,
    )
    return out.withColumn("trend", F.array(*[f"d{i}" for i in range(days)])).withColumn("people", F.array(*[f"p{i}" for i in range(days)])).drop(*[f"{x}{i}" for x in "dp" for i in range(days)])


def topic_rows(windows: DataFrame, groups24: DataFrame) -> DataFrame:
    """Change, means and momentum per macro; groups24: macro, groups (posts of 24 hours per group, in a fixed order)."""
    six = lambda c: F.aggregate(F.slice(c, 1, 6), F.lit(0.0), lambda a, x: a + x) / 6
    base = M.or_one(six("trend"))
    m_mean = M.or_one(six("people"))
    out = windows.join(groups24, "macro").withColumn("d", M.half_up(F.lit(100.0) * (F.col("n24") - base) / base)).withColumn("m_mean", m_mean)
    per_post = F.when(F.col("n_week") > 0, F.col("eng_week") / F.col("n_week")).otherwise(F.lit(1.0))
    score = M.momentum(F.col("groups"), F.col("trend"), F.col("d"), F.col("m24"), F.col("m_mean"), F.col("eng24"), per_post)
    return out.withColumn("momentum", score)


def scope_stats(posts: DataFrame, keys: list[str]) -> DataFrame:
    """Posts, mix of originals, replies and reposts in percent, accounts, people, engagement."""
    original = F.col("type").isin("tweet", "quote")
    n = F.count("*")
    a, r = M.percent(F.count_if(original), n), M.percent(F.count_if(F.col("type") == "reply"), n)
    return posts.groupBy(*keys).agg(
        n.alias("posts"), a.alias("original_pct"), r.alias("reply_pct"), F.greatest(F.lit(0), 100 - a - r).cast("bigint").alias("repost_pct"),
        F.countDistinct("author_id").alias("accounts"), F.countDistinct("member").alias("people"), F.sum("engagement").cast("bigint").alias("engagement"),
        F.count_if(F.col("member").isNull()).alias("unidentified"),
    )


def curve(posts: DataFrame, as_of: Column, buckets: int = 16, hours: int = 3) -> DataFrame:
    """Posts per bucket of the last 48 hours, the oldest first; empty buckets count 0."""
    age = T.age_seconds(F.col("created"), as_of)
    at = (buckets - 1 - F.floor(age / (hours * 3600))).cast("bigint")
    n = posts.filter((age >= 0) & (age < buckets * hours * 3600)).groupBy(at.alias("bucket")).agg(F.count("*").alias("n"))
    every = posts.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    return every.join(n, "bucket", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def coverage(posts: DataFrame, as_of: Column) -> DataFrame:
    """Captured, classified, tagged and pending posts of 24 hours, whether classification rests, last classified day.

    posts: created, day, complete, n_topics.
    """
    young = T.within_hours(F.col("created"), as_of, 24)
    out = posts.agg(
        F.count_if(young).alias("captured"), F.count_if(young & F.col("complete")).alias("classified"),
        F.count_if(young & (F.col("n_topics") > 0)).alias("tagged"), F.max(F.when(F.col("complete"), F.col("day"))).alias("through"),
    )
    return out.withColumn("pending", F.col("captured") - F.col("classified")).withColumn("paused", (F.col("captured") > 0) & (F.col("classified") == 0))


def week_summary(rollup: DataFrame, keys: list[str]) -> DataFrame:
    """Sums over the days, days with posts, the greatest daily number of members."""
    return rollup.groupBy(*keys).agg(F.sum("posts").cast("bigint").alias("posts"), F.sum("retweets").cast("bigint").alias("retweets"), F.countDistinct("day").alias("active_days"), F.max("members").alias("top_members"))


def volume(posts: DataFrame) -> DataFrame:
    """Per day posts, originals, reposts and reading cost in cents; whether a day lies inside the range."""
    daily = posts.groupBy("day").agg(F.count("*").alias("posts"), F.count_if(F.col("type") != "retweet").alias("originals"), F.count_if(F.col("type") == "retweet").alias("reposts"))
    daily = daily.withColumn("cost_cents", M.places(F.col("posts") * F.lit(0.5), 1))
    ends = daily.agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    return daily.join(F.broadcast(ends)).withColumn("interior", (F.col("day") > F.col("_lo")) & (F.col("day") < F.col("_hi"))).drop("_lo", "_hi")  # one row


def projection(daily: DataFrame) -> DataFrame:
    """Mean of the interior days, and what a month of them costs."""
    return daily.filter("interior").agg(F.count("*").alias("days"), M.places(F.avg("posts"), 2).alias("mean_posts"), M.places(F.avg("cost_cents") * 30 / 100, 2).alias("month_usd"))


def people_per_group(posts: DataFrame) -> DataFrame:
    """Distinct people per scope."""
    return posts.withColumn("scope", F.explode(scopes(F.col("groups")))).groupBy("scope").agg(F.countDistinct("member").alias("people"))


def spending(ledger: DataFrame) -> DataFrame:
    """Calls, tokens and dollars by stage; ledger: stage, batch, calls, input, output, cache_read, cache_write."""
    usd = M.token_cost(F.col("input"), F.col("output"), F.col("cache_read"), F.col("cache_write"), F.col("batch"))
    return ledger.groupBy("stage").agg(F.sum("calls").cast("bigint").alias("calls"), F.sum(F.col("input") + F.col("output") + F.col("cache_read") + F.col("cache_write")).cast("bigint").alias("tokens"), M.places(F.sum(usd), 4).alias("usd"))


def dense(daily: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Rows for days without any, with value 0, between each key's first and last overall day."""
    ends = daily.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    grid = daily.select(*keys).distinct().join(F.broadcast(ends)).select(*keys, F.explode(F.sequence("a", "b")).alias(day))  # one row
    return grid.join(daily, [*keys, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def baseline(daily: DataFrame, keys: list[str], day: str, value: str, n: int = 6) -> DataFrame:
    """Mean of the n days before each day, over a dense calendar."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-n, -1)
    return dense(daily, keys, day, value).withColumn("baseline", M.places(F.avg(value).over(w), 4))


def pools(posts: DataFrame) -> DataFrame:
    """Posts per macro; those without a topic are in "unassigned"."""
    own = F.array_distinct(F.transform("topics", lambda t: t["macro"]))
    return posts.withColumn("pool", F.explode_outer(own)).groupBy(F.coalesce("pool", F.lit("unassigned")).alias("pool")).agg(F.count("*").alias("posts"))
