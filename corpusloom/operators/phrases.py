"""Phrases: mining by distinct authors, ledger, families and adoption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import text as X
from . import grams
from .graph import components, cut, drop


def phrase_uses(posts: DataFrame, low: int = 2, high: int = 4, stop: list[str] | None = None) -> DataFrame:
    """One row per post and distinct phrase; retweets have none.  posts: post_id, author_id, created, day, type, text."""
    grams = F.array_distinct(X.ngrams(F.col("tokens"), low, high, stop))
    own = posts.filter("type <> 'retweet'").withColumn("tokens", X.tokenize(F.col("text")))
    return own.select("post_id", "author_id", "created", "day", F.explode(grams).alias("phrase"))


def by_author(uses: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per phrase and author: posts, and their least key, of which created and post_id are read off again.

    uses has a row per post and phrase, so posts are rows.  Times and ids that are numbers make one decimal that
    orders like (created, post_id): a buffer of fixed size, so the rows are hashed and not sorted.
    """
    whole = {"tinyint", "smallint", "int", "bigint"}
    kinds = dict(uses.dtypes)
    place = {k: F.unix_micros("created") if k == "timestamp" else F.unix_date("created") if k == "date" else F.col("created") for k in [kinds["created"]]}[kinds["created"]]
    if kinds["created"] in whole | {"date", "timestamp"} and kinds["post_id"] in whole:
        key = place.cast("decimal(20,0)") * F.lit(str(2**63)).cast("decimal(19,0)") + F.col("post_id").cast("decimal(20,0)")
        key = key.cast("decimal(38,0)")
    else:
        key = F.struct("created", "post_id")
    return uses.groupBy(*keys, "phrase", "author_id").agg(F.count("*").alias("posts"), F.min(key).alias("key"), F.min("created").alias("created"))


def mine(uses: DataFrame, least: int = 3, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """Phrases that enough distinct authors use, with posts and the earliest use.

    Authors are counted from one row each; who was first is looked up for the phrases that are left only.
    """
    each = cut(by_author(uses, keys))
    out = each.groupBy(*keys, "phrase").agg(F.count("*").alias("members"), F.sum("posts").alias("posts"), F.min("key").alias("key"), F.min("created").alias("first_seen")).filter(F.col("members") >= least)
    return each.select(*keys, "phrase", "author_id", "key").join(out.hint("shuffle_hash"), [*keys, "phrase", "key"]).select(*keys, "phrase", "members", "posts", "first_seen", F.col("author_id").alias("first_author"))


def _by_phrase(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of grams.rows_of summed per phrase and author; all of a phrase in one task, a row per author and block at most."""
    at = F.min(F.when(F.col("created").isNotNull(), F.struct("created", "post_id"))).alias("at")
    return rows.repartition(*keys, "phrase").groupBy(*keys, "phrase", "author_id").agg(F.sum("posts").alias("posts"), at)


def mine_posts(posts: DataFrame, least: int = 3, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """mine() of phrase_uses(posts), slice by slice, with rows for possible phrases only."""

    def finish(rows):
        first = F.min(F.when(F.col("at").isNotNull(), F.struct("at", "author_id")))
        out = _by_phrase(rows, keys).groupBy(*keys, "phrase").agg(F.count("*").alias("members"), F.sum("posts").alias("posts"), F.min("at.created").alias("first_seen"), first.alias("f")).filter(F.col("members") >= least)
        return out.select(*keys, "phrase", "members", "posts", "first_seen", F.col("f.author_id").alias("first_author"))

    return grams.each_slice(posts, least, keys, finish)


def widespread_posts(posts: DataFrame, least: int = 3, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """widespread() of phrase_uses(posts), slice by slice, with rows for possible phrases only."""

    def finish(rows):
        return rows.repartition(*keys, "phrase").groupBy(*keys, "phrase", "author_id").agg(F.sum("posts").alias("posts")).groupBy(*keys, "phrase").agg(F.count("*").alias("members"), F.sum("posts").alias("posts")).filter(F.col("members") >= least)

    return grams.each_slice(posts, least, keys, finish)


def widespread(uses: DataFrame, least: int = 3, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """A06 without the earliest use: phrases that enough distinct authors use, with members and posts."""
    each = uses.groupBy(*keys, "phrase", "author_id").agg(F.count("*").alias("posts"))
    return each.groupBy(*keys, "phrase").agg(F.count("*").alias("members"), F.sum("posts").alias("posts")).filter(F.col("members") >= least)


def widespread_first(uses: DataFrame, least: int = 3) -> DataFrame:
    """A07 for phrases that enough distinct authors use: uses are read once, what counts the authors is kept."""
    first = cut(member_first(uses))
    top = first.groupBy("phrase").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("phrase")
    return first.join(top.hint("shuffle_hash"), "phrase")


def widespread_first_posts(posts: DataFrame, least: int = 3) -> DataFrame:
    """widespread_first() of phrase_uses(posts), slice by slice, with rows for possible phrases only."""

    def finish(rows):
        first = rows.repartition("phrase").groupBy("phrase", "author_id").agg(F.min("created").alias("day"))
        return first.withColumn("_n", F.count("*").over(Window.partitionBy("phrase"))).filter(F.col("_n") >= least).drop("_n")

    return grams.each_slice(posts.withColumn("created", F.col("day")), least, (), finish)


def uses_of(posts: DataFrame, few: DataFrame) -> DataFrame:
    """phrase_uses(posts) of a few phrases (the top of a ranking), written: post_id, author_id, phrase."""
    tokens, _ = grams.store(posts)
    out = cut(grams.uses_of(tokens, [r[0] for r in few.select("phrase").collect()]).select("post_id", "author_id", "phrase"))
    drop(tokens)
    return out


def prune_contained(phrases: DataFrame, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """Drop a phrase that a strictly longer one with as many members contains.

    Containment is of characters: the first token of what is contained is then the end of a token of what contains
    it, the last one the beginning of a later token, and those between are the same.  So each run of tokens is listed
    with such ends that some phrase begins or stops with, and meets the phrase by equality; of all that contain a
    phrase the one with the most members decides, and no pairs are listed.
    """
    t = F.split("phrase", " ")
    every = phrases.filter(F.size(t) >= 2)
    words = every.select(F.explode(t).alias("w")).distinct()

    def ends(of: Column, affix, word: str, name: str) -> DataFrame:
        """For each word the affixes that phrases have at that end."""
        each = words.select("w", F.explode(F.transform(F.sequence(F.lit(0), F.length("w")), lambda k: affix("w", k))).alias("_x"))
        return each.join(every.select(of.alias("_x")).distinct(), "_x").groupBy(F.col("w").alias(word)).agg(F.collect_set("_x").alias(name))

    begin = ends(F.get(t, F.lit(0)), F.right, "_i", "_begin")
    stop = ends(F.element_at(t, -1), F.left, "_j", "_stop")
    run = lambda i, j: F.struct(F.get(t, i).alias("_i"), F.slice(t, i + 2, j - i - 1).alias("_mid"), F.get(t, j).alias("_j"))
    runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size(t) - 2), lambda i: F.transform(F.sequence(i + 1, F.size(t) - 1), lambda j: run(i, j))))
    long = every.select(*keys, F.length("phrase").alias("_n"), F.col("members").alias("_m"), F.inline(runs)).join(begin, "_i").join(stop, "_j")
    part = long.withColumn("_x", F.explode("_begin")).withColumn("_y", F.explode("_stop")).select(*keys, "_n", "_m", F.array_join(F.concat(F.array("_x"), "_mid", F.array("_y")), " ").alias("phrase"))
    most = part.filter(F.length("phrase") < F.col("_n")).groupBy(*keys, "phrase").agg(F.max("_m").alias("_m"))
    held = phrases.join(most, [*keys, "phrase"]).filter(F.col("_m") >= F.col("members")).select(*keys, "phrase")
    return phrases.join(held, [*keys, "phrase"], "left_anti")


def member_first(uses: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """First day that each author used each phrase; a ledger of earlier days is merged in."""
    now = uses.groupBy("phrase", "author_id").agg(F.min("day").alias("day"))
    return now if ledger is None else now.unionByName(ledger).groupBy("phrase", "author_id").agg(F.min("day").alias("day"))


def adoption(first: DataFrame, as_of_day: Column, days: int = 7) -> DataFrame:
    """People who have used a phrase by each of the last days; earlier ones count from the first."""
    at = F.least(F.greatest(F.lit(0), days - 1 - F.datediff(as_of_day, F.col("day"))), F.lit(days - 1))
    n = first.groupBy("phrase", at.alias("bucket")).agg(F.countDistinct("author_id").alias("n"))
    grid = first.select("phrase").distinct().withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    w = Window.partitionBy("phrase").orderBy("bucket")
    return grid.join(n, ["phrase", "bucket"], "left").select("phrase", "bucket", F.sum(F.coalesce("n", F.lit(0))).over(w).cast("bigint").alias("people"))


def families(phrases: DataFrame) -> DataFrame:
    """(phrase, family) for phrases one token apart, or with the same last token where one holds the other.

    phrases has few rows (the top of a ranking), so pairs are made through shared tokens: two related
    phrases always share one, except pairs of single tokens, which are no phrases.
    """
    tokens = phrases.select("phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("t"))
    a, b = tokens.alias("a"), tokens.alias("b")
    pairs = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.phrase") < F.col("b.phrase"))).select(F.col("a.phrase").alias("a"), F.col("b.phrase").alias("b")).distinct()
    head = F.element_at(F.split("a", " "), -1) == F.element_at(F.split("b", " "), -1)
    held = F.col("a").contains(F.col("b")) | F.col("b").contains(F.col("a"))
    edges = pairs.filter(X.one_token_edit(F.col("a"), F.col("b")) | (head & held))
    roots = components(edges)
    return phrases.select("phrase").join(roots.withColumnRenamed("node", "phrase"), "phrase", "left").select("phrase", F.coalesce("root", "phrase").alias("family"))


def family_rows(uses: DataFrame, family: DataFrame, least: int = 3) -> DataFrame:
    """Per family the most used variant, posts, people, and the share of posts with that variant."""
    hits = uses.join(family, "phrase")
    by = hits.groupBy("family", "phrase").agg(F.count("*").alias("n"))
    top = by.groupBy("family").agg(F.max(F.struct("n", F.struct((-F.length("phrase")).alias("l"), "phrase"))).alias("x"), F.count("*").alias("variants"))
    posts = hits.select("family", "post_id").distinct().groupBy("family").agg(F.count("*").alias("posts"))
    people = hits.select("family", "author_id").distinct().groupBy("family").agg(F.count("*").alias("people"))
    every = posts.join(people, "family")
    out = every.join(top, "family").select("family", F.col("x.col2.phrase").alias("canonical"), "variants", "posts", "people", M.places(F.col("x.n") / F.col("posts"), 2).alias("exact"))
    return out.filter(F.col("people") >= least)


def with_phrases(posts: DataFrame, phrases: DataFrame, low: int = 2, high: int = 4) -> DataFrame:
    """Posts that hold a phrase as a run of tokens, by equality of n-grams."""
    every = F.array_distinct(X.ngrams(F.col("tokens"), low, high, []))
    return posts.withColumn("tokens", X.tokenize(F.col("text"))).withColumn("phrase", F.explode(every)).drop("tokens").join(phrases.select("phrase"), "phrase")
