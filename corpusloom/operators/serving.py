"""What a front end asks for: projections of posts, drill-downs, facets, briefs, status ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import text as X
from ..functions import timefn as T
from .windows import ranked


def engagement(m: Column) -> Column:
    """Likes, retweets, replies and quotes together; 0 where metrics are missing or unavailable."""
    total = F.coalesce(m["likes"], F.lit(0)) + F.coalesce(m["retweets"], F.lit(0)) + F.coalesce(m["replies"], F.lit(0)) + F.coalesce(m["quotes"], F.lit(0))
    return F.coalesce(total, F.lit(0)).cast("bigint")


def after_cursor(post_id: Column, cursor: Column) -> Column:
    """Ids beyond a cursor, compared as numbers; without a cursor all."""
    return cursor.isNull() | (post_id.cast("decimal(30,0)") > cursor.cast("decimal(30,0)"))


def originals(posts: DataFrame) -> DataFrame:
    """Posts that aren't reposts."""
    return posts.filter("type <> 'retweet'")


def refreshable(posts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Tweets, quotes and replies without metrics yet."""
    return posts.filter(F.col("type").isin("tweet", "quote", "reply")).join(metrics.select("post_id"), "post_id", "left_anti")


def person_key(person: Column, member_id: Column, member: Column) -> Column:
    """Id of a person, of a member, or the folded name."""
    name = F.trim(F.regexp_replace(X.fold(member), r"\s+", " "))
    return F.coalesce(person.cast("string"), member_id.cast("string"), F.when(member.isNotNull(), F.concat(F.lit("member:"), name)))


def site_posts(posts: DataFrame, assignment: DataFrame, metrics: DataFrame) -> DataFrame:
    """Posts with engagement, topics and status; posts without an interpretation are pending.

    assignment: post_id, topics; metrics: post_id, refreshed, unavailable.
    """
    from .enrich import with_metrics

    out = with_metrics(posts, metrics).join(assignment, "post_id", "left")
    return out.withColumn("status", F.when(F.col("topics").isNull(), "pending").otherwise("complete")).withColumn("source_gap", F.col("ref_id").isNotNull() & F.col("embedded").isNull())


def public_provenance(used: Column, supplied: Column) -> Column:
    """Evidence that was both supplied and used, with a public link, its text cut at 600 code points."""
    ids = F.transform(used, lambda u: u)
    own = F.filter(supplied, lambda e: F.array_contains(ids, e["id"]) & e["url"].rlike("^https?://"))
    return F.transform(own, lambda e: F.struct(e["id"].alias("id"), e["publisher"].alias("publisher"), e["url"].alias("url"), F.substring(e["text"], 1, 600).alias("text")))


def quote(text: Column) -> Column:
    """P20: at most 200 code points, cut between words."""
    return X.clip(text, 200)


def classifier_line(posts: DataFrame) -> DataFrame:
    """The JSON line of a post for a classifier; fields without a value are left out."""
    return posts.select("post_id", F.to_json(F.struct(F.col("post_id").cast("string").alias("id"), "type", "text", F.col("context").alias("quoting"))).alias("line"))


def drill_down(rows: DataFrame, posts: DataFrame, top: bool = False) -> DataFrame:
    """Posts behind row keys ("macro" or "macro/sub"), the newest or the strongest first; missing ids are skipped.

    rows: key; posts: post_id, macro, sub, created, engagement.
    """
    parts = F.split("key", "/")
    keys = rows.select("key", F.get(parts, F.lit(0)).alias("macro"), F.get(parts, F.lit(1)).alias("_sub"))
    out = keys.join(posts, "macro").filter(F.col("_sub").isNull() | F.col("sub").eqNullSafe(F.col("_sub"))).drop("_sub")
    order = [F.desc("engagement"), F.asc("post_id")] if top else [F.desc("created"), F.desc("post_id")]
    return out.dropDuplicates(["key", "post_id"]).withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(*order)))


def on_desk(list_: DataFrame) -> DataFrame:
    """Incidents that are active or monitored, or provisional and not resolved."""
    return list_.filter(F.col("lifecycle").isin("active", "monitoring") | ((F.col("status") == "provisional") & (F.col("lifecycle") != "resolved")))


def leader(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of highest momentum per window and scope, among those with posts."""
    return rows.filter("n > 0").groupBy(*keys).agg(F.max_by("macro", F.struct("score", "macro")).alias("leader"), F.max("score").alias("score"))


def unity(adopters: DataFrame, active: DataFrame, least: int = 3, share: float = 0.1) -> DataFrame:
    """Groups that took up a phrase: three people and a tenth of the active ones; their number per phrase.

    adopters: phrase, scope, people; active: scope, people.
    """
    both = adopters.join(active.select("scope", F.col("people").alias("_all")), "scope")
    filled = (F.col("people") >= least) & (F.col("people") >= share * F.col("_all"))
    return both.groupBy("phrase").agg(F.count_if(filled).alias("unity"), F.count("*").alias("groups"))


def adoption_gain(curve: DataFrame) -> DataFrame:
    """People on the last day of a cumulative curve less those on the first."""
    return curve.groupBy("phrase").agg((F.max_by("people", "bucket") - F.min_by("people", "bucket")).alias("gain"))


def badges(rows: DataFrame, group: str, value: str, key: str, n: int = 3) -> DataFrame:
    """The first three rows of each group column."""
    return ranked(rows.filter(F.col(value) > 0), group, [F.desc(value), F.asc(key)], n, "badge")


def facets(posts: DataFrame) -> DataFrame:
    """Posts per macro, for the choices of a filter."""
    return posts.groupBy("macro").agg(F.countDistinct("post_id").alias("n"))


def one_line_each(posts: DataFrame) -> DataFrame:
    """The latest text of each person on a subject, and how many posts there are."""
    return posts.groupBy("subject", "member").agg(F.max_by("text", F.struct("created", "post_id")).alias("text"), F.count("*").alias("n"))


def interpretation_state(counts: DataFrame, as_of: Column) -> DataFrame:
    """Off, stale (more than 45 minutes), behind or current; counts: classified, pending, last_run."""
    old = T.age_seconds(F.col("last_run"), as_of) > 45 * 60
    return counts.withColumn("state", F.when(F.col("last_run").isNull(), "off").when(old, "stale").when(F.col("pending") > 0, "behind").otherwise("current"))


def excluded(posts: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Accounts outside the roster, and their posts in the window and today."""
    out = posts.filter(F.coalesce(F.col("status"), F.lit("house")) != "house")
    return out.agg(F.countDistinct("author_id").alias("accounts"), F.count_if(T.in_window(F.col("created"), as_of, days)).alias("in_window"), F.count_if(T.in_window(F.col("created"), as_of, 1)).alias("today"))


def display_groups(tags: Column, names: Column) -> Column:
    """Display keys of an author's tags, each once; unknown tags go."""
    return F.array_distinct(F.filter(F.transform(tags, lambda t: F.try_element_at(names, t)), lambda t: t.isNotNull()))


def highlight(text: Column, start: Column, stop: Column, span: Column) -> Column:
    """Text with a marked span, if that is what stands there; else as it is."""
    there = F.substring(text, start + 1, stop - start) == span
    return F.when(there, F.concat(F.substring(text, F.lit(1), start), F.lit("<mark>"), span, F.lit("</mark>"), F.substring(text, stop + 1, F.length(text)))).otherwise(text)


def cluster_cards(posts: DataFrame, as_of: Column, hours: int = 24, buckets: int = 8) -> DataFrame:
    """A10: per cluster posts, people, accounts, engagement, a cumulative shape in eight buckets, the strongest post.

    posts: cluster, post_id, created, author_id, member, engagement.
    """
    age = T.age_seconds(F.col("created"), as_of)
    at = F.least(F.lit(buckets - 1), F.greatest(F.lit(0), buckets - 1 - F.floor(age / (hours * 3600 / buckets)))).cast("int")
    shape = F.array(*[F.count_if(F.col("_b") <= i) for i in range(buckets)])
    return posts.withColumn("_b", at).groupBy("cluster").agg(
        F.count("*").alias("posts"), F.countDistinct("member").alias("people"), F.countDistinct("author_id").alias("accounts"), F.sum("engagement").cast("bigint").alias("engagement"),
        shape.alias("shape"), F.max_by("post_id", F.struct("engagement", -F.col("post_id"))).alias("sample"),
    )


def read_ledger(usage: DataFrame, budget: Column) -> DataFrame:
    """Reads and dollars per day, and what is left of the budget."""
    out = usage.groupBy("day").agg(F.sum("posts").cast("bigint").alias("posts"), F.sum("users").cast("bigint").alias("users"))
    return out.withColumn("usd", M.places(M.read_cost(F.col("posts"), F.col("users")), 4)).withColumn("remaining", F.greatest(F.lit(0), budget - F.col("posts")).cast("bigint"))


def pending_days(posts: DataFrame, classified: DataFrame) -> DataFrame:
    """Pending posts per day, and whether the day is complete."""
    rest = posts.join(classified.select("post_id"), "post_id", "left_anti").groupBy("day").agg(F.count("*").alias("pending"))
    return posts.select("day").distinct().join(rest, "day", "left").withColumn("pending", F.coalesce("pending", F.lit(0))).withColumn("complete", F.col("pending") == 0)


def evidence_links(ids: DataFrame, archive: DataFrame, n: int = 3) -> DataFrame:
    """Of the ids of a group those that the archive holds, the newest three."""
    held = ids.join(archive.select("post_id", "created"), "post_id")
    return ranked(held, "group", [F.desc("created"), F.desc("post_id")], n)


def attach_evidence(posts: DataFrame, lines: DataFrame, agenda: DataFrame) -> DataFrame:
    """Posts with up to two lines of evidence and the agenda items that name their bills; bills: array."""
    top = ranked(lines, "post_id", [F.desc("score"), F.asc("news_id")], 2).groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("rank", "news_id"))).alias("evidence"))
    named = posts.select("post_id", F.explode("bills").alias("bill_id")).join(agenda, "bill_id").groupBy("post_id").agg(F.sort_array(F.collect_set("id")).alias("agenda"))
    return posts.join(top, "post_id", "left").join(named, "post_id", "left")


def floor_view(items: DataFrame, fetched: Column, as_of: Column, congress: Column, hash_: Column, known: Column) -> DataFrame:
    """Agenda items with freshness (a day), whether they are of the sitting congress, and whether the file is unchanged."""
    fresh = T.age_seconds(fetched, as_of) <= 24 * 3600
    current = fresh & (F.col("congress") == congress) & F.col("week").cast("date").between(F.date_sub(F.to_date(as_of), 7), F.date_add(F.to_date(as_of), 7))
    return items.withColumn("stale", ~fresh).withColumn("current", current).withColumn("revalidated", hash_ == known)


def applied_status(incidents: DataFrame) -> DataFrame:
    """Verification of incidents: never more than statements of their distinct sources."""
    return incidents.withColumn("verification", F.struct(F.lit("unverified").alias("status"), F.lit(0).alias("independent_sources"), F.array_distinct("source_ids").alias("source_ids")))


def compact_feed(posts: DataFrame) -> DataFrame:
    """Any of the rankings is ranked() with its order; this is the feed's: all rows, compact, the newest first."""
    return posts.select("post_id", F.to_json(F.struct("post_id", "author_id", "engagement")).alias("doc"), "created").orderBy(F.desc("created"), F.desc("post_id"))
