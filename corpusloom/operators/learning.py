"""Taxonomy learning: pools, subjects, proposals, merge edges; and label evaluation by greedy samples."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import mathfn as M
from ..functions import text as X
from .graph import follow
from .windows import ranked


def learning_window(posts: DataFrame, assignment: DataFrame, classified: DataFrame) -> DataFrame:
    """P25: originals of the days that are classified, with their topics; classified posts without any are kept."""
    days = classified.select("day").distinct()
    return posts.filter("type <> 'retweet'").join(days, "day", "left_semi").join(classified.select("post_id"), "post_id", "left_semi").join(assignment, "post_id", "left")


def reconsideration(posts: DataFrame) -> DataFrame:
    """Posts to classify again, with the reason; corrected and pending ones stay as they are.

    posts: generic, news_version, seen_version, distinctive, fingerprint, seen_fingerprint, corrected, pending.
    """
    news = F.col("generic") & (F.col("news_version") > F.col("seen_version")) & F.col("distinctive")
    source = F.col("fingerprint") != F.col("seen_fingerprint")
    reason = F.when(F.col("corrected") | F.col("pending"), None).when(source, "source changed").when(news, "newer evidence")
    return posts.withColumn("reason", reason).filter("reason is not null")


def alias_screen(posts: DataFrame, taxonomy: DataFrame, assignment: DataFrame) -> DataFrame:
    """Posts whose text names a sub of a macro that they carry, which they weren't given.

    taxonomy: macro, sub, aliases.  Names meet texts by equality of n-grams of up to four tokens.
    """
    names = taxonomy.select("macro", "sub", F.explode("aliases").alias("alias")).withColumn("phrase", F.array_join(X.tokenize(F.col("alias")), " "))
    grams = posts.select("post_id", F.explode(F.array_distinct(X.ngrams(X.tokenize(F.col("text")), 1, 4, []))).alias("phrase"))
    hits = grams.join(names, "phrase").join(assignment.select("post_id", "macro").distinct(), ["post_id", "macro"]).select("post_id", "macro", "sub").distinct()
    return hits.join(assignment.select("post_id", "macro", "sub"), ["post_id", "macro", "sub"], "left_anti")


def recent_unseen(batch: DataFrame, archive: DataFrame, as_of_day: Column, days: int = 3) -> DataFrame:
    """Rows whose id the last three days don't hold."""
    near = archive.filter(F.col("day") > F.date_sub(as_of_day, days)).select("post_id")
    return batch.join(near, "post_id", "left_anti")


def by_derived_day(ids: DataFrame, archive: DataFrame) -> DataFrame:
    """Archive rows of snowflake ids; the id's own time gives the partitions to read, a day to either side."""
    day = F.to_date(X.snowflake_time(F.col("post_id")))
    near = ids.select("post_id", F.explode(F.sequence(F.date_sub(day, 1), F.date_add(day, 1))).alias("day"))
    return archive.join(near, ["post_id", "day"])


def repost_original(reposts: DataFrame, cache: DataFrame, archive: DataFrame) -> DataFrame:
    """The original of a repost: embedded if its id agrees, else cached, else archived."""
    a = cache.select(F.col("post_id").alias("ref_id"), F.col("text").alias("_c"))
    b = archive.select(F.col("post_id").alias("ref_id"), F.col("text").alias("_a"))
    own = F.when(F.col("embedded_id") == F.col("ref_id"), F.nullif(F.trim("embedded"), F.lit("")))
    return reposts.join(a, "ref_id", "left").join(b, "ref_id", "left").withColumn("original", F.coalesce(own, "_c", "_a")).drop("_c", "_a")


def repost_requests(posts: DataFrame, resolved: DataFrame, attempted: DataFrame, as_of: Column, n: int = 25) -> DataFrame:
    """J12, ST16: references of the last day's reposts that are neither resolved nor tried, the most frequent first."""
    from ..functions import timefn as T

    young = posts.filter((F.col("type") == "retweet") & F.col("ref_id").isNotNull() & T.within_hours(F.col("created"), as_of, 24))
    known = resolved.select(F.col("post_id").alias("ref_id")).union(attempted.select(F.col("post_id").alias("ref_id"))).distinct()
    return young.join(known, "ref_id", "left_anti").groupBy("ref_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc("ref_id")).limit(n)


def emerging_groups(placed: DataFrame, raw: DataFrame) -> DataFrame:
    """Emerging groups of one normalised label, or of one macro and key, as one; placed ones give the name.

    Both: label, macro, key, ids.
    """
    from .graph import components

    every = placed.withColumn("_o", F.lit(0)).unionByName(raw.withColumn("_o", F.lit(1))).withColumn("_id", F.xxhash64("_o", "label", "macro", "key"))
    links = [every.select("_id", F.concat(F.lit("l:"), X.label_key(F.col("label"))).alias("k")), every.filter("key is not null").select("_id", F.concat(F.lit("k:"), F.col("macro"), F.lit("/"), F.col("key")).alias("k"))]
    first = links[0].union(links[1]).withColumn("_min", F.min("_id").over(Window.partitionBy("k")))
    roots = components(first.select(F.col("_id").alias("a"), F.col("_min").alias("b")))
    own = every.join(roots, F.col("_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "_id"))
    return own.groupBy("root").agg(F.min_by("label", F.struct("_o", "label")).alias("label"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids")).drop("root")


def by_slug(candidates: DataFrame, stories: DataFrame) -> DataFrame:
    """Candidates and stories of one slug."""
    return candidates.withColumn("slug", X.slug(F.col("label"))).join(stories.withColumn("slug", X.slug(F.col("label"))).select("slug", "story"), "slug")


def locate_corrections(corrections: DataFrame, posts: DataFrame) -> DataFrame:
    """The post that a correction means: by id, or by handle, day and a part of its text; only if there is one."""
    by_id = corrections.filter("post_id is not null").join(posts.select("post_id"), "post_id", "left_semi").select("correction_id", "post_id")
    rest = corrections.filter("post_id is null").select("correction_id", F.lower("handle").alias("handle"), "day", X.norm_text(F.col("match")).alias("m"))
    near = rest.join(posts.select("post_id", F.lower("handle").alias("handle"), "day", X.norm_text(F.col("text")).alias("t")), ["handle", "day"]).filter(F.col("t").contains(F.col("m")))
    only = near.groupBy("correction_id").agg(F.count("*").alias("n"), F.min("post_id").alias("post_id")).filter("n = 1").drop("n")
    return by_id.unionByName(only)


def semantic_merges(clusters: DataFrame, subs: DataFrame, least: float) -> DataFrame:
    """The most similar sub of each cluster's macro, if similar enough; centroids of unit length."""
    pairs = clusters.join(subs.select("macro", "sub", F.col("centroid").alias("_c")), "macro").withColumn("sim", M.dot(F.col("centroid"), F.col("_c"))).filter(F.col("sim") >= least)
    return ranked(pairs.drop("_c"), ["macro", "cluster"], [F.desc("sim"), F.asc("sub")], 1).drop("rank")


def merge_edges(groups: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Pairs of groups of one kind to merge, with the reason: half of the smaller's ids shared, confirmed, or hinted with a shared word.

    groups: key, kind, label, ids, hint; confirmed: a, b.
    """
    flat = groups.select("key", "kind", F.size("ids").alias("n"), F.explode("ids").alias("i"))
    a, b = flat.alias("a"), flat.alias("b")
    shared = a.join(b, (F.col("a.i") == F.col("b.i")) & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.key") < F.col("b.key"))).groupBy(F.col("a.key").alias("a"), F.col("b.key").alias("b")).agg(F.count("*").alias("n"), F.least(F.first("a.n"), F.first("b.n")).alias("m"))
    overlap = shared.filter(2 * F.col("n") >= F.col("m")).select("a", "b", F.lit("overlap").alias("why"))
    side = lambda x: groups.select(F.col("key").alias(x), F.col("kind").alias(f"k{x}"), F.col("label").alias(f"l{x}"))
    checked = confirmed.join(side("a"), "a").join(side("b"), "b").filter("ka = kb").select("a", "b", F.lit("confirmed").alias("why"))
    hints = groups.filter("hint is not null").select(F.col("key").alias("a"), F.col("hint").alias("b")).join(side("a"), "a").join(side("b"), "b")
    hinted = hints.filter((F.col("ka") == F.col("kb")) & (F.size(F.array_intersect(X.label_tokens(F.col("la")), X.label_tokens(F.col("lb")))) > 0)).select("a", "b", F.lit("hint").alias("why"))
    return overlap.union(checked).union(hinted).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "why").distinct()


def existing_sub(labels: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The sub that a label names under its macro: by key, label or alias, whatever the case."""
    names = taxonomy.select("macro", "sub", F.explode(F.array_distinct(F.transform(F.concat(F.array("sub", "sub_label"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda x: F.lower(x)))).alias("_n"))
    return labels.withColumn("_n", F.lower("label")).join(names, ["macro", "_n"]).groupBy("macro", "label").agg(F.min("sub").alias("sub"))


def not_in_flight(posts: DataFrame, jobs: DataFrame) -> DataFrame:
    """Posts that no submitted batch holds."""
    return posts.join(jobs.select(F.explode("ids").alias("post_id")), "post_id", "left_anti")


def proposals(shares: DataFrame, merges: DataFrame, elevated: DataFrame, quiet: DataFrame) -> DataFrame:
    """One list of proposals: add (enough posts and people, no merge), merge, elevate, retire."""
    merged = merges.select("macro", F.col("cluster").alias("key"), F.lit("merge").alias("kind"), "posts")
    add = shares.filter((F.col("posts") >= 8) & (F.col("members") >= 3)).select("macro", F.col("cluster").alias("key"), F.lit("add").alias("kind"), "posts").join(merged.select("macro", "key"), ["macro", "key"], "left_anti")
    up = elevated.filter("elevate").select("macro", F.col("sub").alias("key"), F.lit("elevate").alias("kind"), "posts")
    out = quiet.select("macro", F.col("sub").alias("key"), F.lit("retire").alias("kind"), F.lit(0).cast("bigint").alias("posts"))
    return add.unionByName(merged).unionByName(up).unionByName(out)


def carried(new: DataFrame, old: DataFrame, processed: DataFrame) -> DataFrame:
    """New proposals, and the old ones of pools that weren't processed."""
    return new.unionByName(old.join(processed.select("macro").distinct(), "macro", "left_anti"))


def build_stories(taxonomy: DataFrame, candidates: DataFrame, assignment: DataFrame, merged: DataFrame) -> DataFrame:
    """Id sets of stories: posts of taxonomy stories and of candidates, under the story that merges end in.

    merged: story, into.
    """
    ends = follow(merged, "story", "into").withColumnRenamed("into", "_end")
    own = taxonomy.filter("story is not null").join(assignment, ["macro", "sub"]).select("story", "post_id").union(candidates.select("story", F.explode("ids").alias("post_id")))
    return own.join(ends, "story", "left").groupBy(F.coalesce("_end", "story").alias("story")).agg(F.sort_array(F.collect_set("post_id")).alias("ids"))


def chunk_modes(items: DataFrame) -> DataFrame:
    """Per chunk of 40 rows in order the commonest pair and its share; items: position, pair."""
    n = items.withColumn("chunk", F.floor((F.col("position") - 1) / 40).cast("bigint")).groupBy("chunk", "pair").agg(F.count("*").alias("n"))
    return n.groupBy("chunk").agg(F.max_by("pair", F.struct("n", "pair")).alias("mode"), M.places(F.max("n") / F.sum("n"), 4).alias("share"))


def corpus_counts(assignment: DataFrame) -> DataFrame:
    """Posts per sub and per macro."""
    sub = assignment.groupBy("macro", "sub").agg(F.countDistinct("post_id").alias("posts"))
    return sub.unionByName(assignment.groupBy("macro").agg(F.countDistinct("post_id").alias("posts")).withColumn("sub", F.lit("*")))


def rekey(taxonomy: DataFrame) -> DataFrame:
    """Opaque ids for macros and subs, by their order; the table itself maps back."""
    w = Window.orderBy("macro")
    m = taxonomy.select("macro").distinct().withColumn("macro_id", F.concat(F.lit("M"), F.row_number().over(w).cast("string")))  # a taxonomy is small
    s = F.row_number().over(Window.partitionBy("macro").orderBy("sub"))
    return taxonomy.select("macro", "sub").distinct().withColumn("_s", s).join(m, "macro").withColumn("sub_id", F.concat("macro_id", F.lit("S"), F.col("_s").cast("string"))).drop("_s")


def provisional_list(taxonomy: DataFrame) -> DataFrame:
    """Provisional subs, live and retired."""
    return taxonomy.filter("provisional").select("macro", "sub", F.when(F.col("retired"), "retired").otherwise("live").alias("state"))


def flags_by_precedence(live: DataFrame, nightly: DataFrame) -> DataFrame:
    """Flags of both, the nightly one where both have one."""
    return ranked(live.withColumn("_p", F.lit(0)).unionByName(nightly.withColumn("_p", F.lit(1))), "post_id", F.desc("_p"), 1, "_r").drop("_p", "_r")


def confirmed_groups(groups: Column) -> Column:
    """Groups of keys: sorted, singletons out, each once."""
    return F.array_distinct(F.filter(F.transform(groups, lambda g: F.sort_array(F.array_distinct(g))), lambda g: F.size(g) > 1))


def merge_aliases(old: Column, new: Column, most: int = 12) -> Column:
    """Aliases in order, each once whatever its case, so many at most."""
    every = F.concat(old, new)
    keep = F.filter(F.sequence(F.lit(1), F.size(every)), lambda i: F.array_position(F.transform(every, lambda x: F.lower(x)), F.lower(F.get(every, i - 1))) == i)
    return F.slice(F.transform(keep, lambda i: F.get(every, i - 1)), 1, most)


def name_candidates(posts: DataFrame, covered: DataFrame, least: int = 3) -> DataFrame:
    """Runs of two or three capitalised words that several posts use and no alias covers, the commonest first."""
    runs = F.regexp_extract_all("text", F.lit(r"(?<![.!?]\s)\b[A-Z][a-z]+(?:\s[A-Z][a-z]+){1,2}\b"), F.lit(0))
    n = posts.select("post_id", F.explode(F.array_distinct(runs)).alias("name")).groupBy("name").agg(F.countDistinct("post_id").alias("n")).filter(F.col("n") >= least)
    return n.join(covered.select(F.lower("alias").alias("_a")), F.lower("name") == F.col("_a"), "left_anti").orderBy(F.desc("n"), F.asc("name"))


def precedents(corrections: DataFrame, n: int = 10) -> DataFrame:
    """The latest corrections by filing day, then in order of id, texts cut at 600 code points."""
    return corrections.orderBy(F.desc("filed"), F.desc("correction_id")).limit(n).withColumn("text", F.substring("text", 1, 600)).orderBy("post_id")


def work_estimate(subjects: Column, per_call: int = 40) -> Column:
    """Calls for a pool: one to find subjects, one per so many posts, one to name."""
    return (F.lit(2) + F.ceil(subjects / F.lit(per_call))).cast("int")


def hint(candidates: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """What a candidate points to: a live story, nothing if it is retired, else an emerging label."""
    t = taxonomy.select("story", "retired", "sub").distinct()
    return candidates.join(t, "story", "left").withColumn("hint", F.when(F.col("sub").isNull(), F.concat(F.lit("emerging:"), F.col("story"))).when(~F.col("retired"), F.concat(F.lit("story:"), F.col("sub"))))


def verdict_pairs(verdicts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Labels under opaque ids as pairs; a sub must be of the macro that goes with it, else the pair is an error.

    verdicts: item_id, labels (array of arrays); mapping: macro, sub, macro_id, sub_id.
    """
    flat = verdicts.select("item_id", F.explode("labels").alias("l")).select("item_id", F.get("l", F.lit(0)).alias("macro_id"), F.get("l", F.lit(1)).alias("sub_id"))
    macros = mapping.select("macro", "macro_id").distinct()
    subs = mapping.select("sub", "sub_id", F.col("macro_id").alias("_parent"))
    out = flat.join(macros, "macro_id", "left").join(subs, "sub_id", "left")
    bad = F.col("macro").isNull() | (F.col("sub_id").isNotNull() & ~F.col("_parent").eqNullSafe(F.col("macro_id")))
    return out.select("item_id", "macro", "sub", bad.alias("error")).distinct()


def greedy_coverage(items: DataFrame, n: int) -> DataFrame:
    """Up to n items per macro, each time the one that adds most subs not covered yet; ties by hash.

    items: macro, item_id, subs (array); a macro's items are a bounded frame.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rest = sorted(zip(pdf["item_id"], pdf["subs"], strict=True), key=lambda x: str(x[0]))
        seen: set = set()
        taken = []
        while rest and len(taken) < n:
            i = max(range(len(rest)), key=lambda k: (len(set(rest[k][1]) - seen), -k))
            if not set(rest[i][1]) - seen:
                break
            item, subs = rest.pop(i)
            seen |= set(subs)
            taken.append(item)
        return pd.DataFrame({"macro": pdf["macro"].iloc[0], "item_id": taken, "place": range(1, len(taken) + 1)})

    kind = items.schema["item_id"].dataType.simpleString()
    return items.groupBy("macro").applyInPandas(run, f"macro string, item_id {kind}, place int")


def top_up(sample: DataFrame, frame: DataFrame, floor: int) -> DataFrame:
    """A sample with at least so many items per macro, filled in the order of a hash."""
    have = sample.groupBy("macro").agg(F.count("*").alias("_h"))
    rest = frame.join(sample.select("item_id"), "item_id", "left_anti").join(have, "macro", "left")
    w = Window.partitionBy("macro").orderBy(F.sha2(F.col("item_id").cast("string"), 256))
    fill = rest.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= floor - F.coalesce("_h", F.lit(0))).drop("_r", "_h")
    return sample.unionByName(fill.select(*sample.columns))


def separate(order: list, twin: dict, least: int) -> list:
    """An order in which twins stand at least so far apart; an error if there is no room.

    A twin that stands too near changes places with an item that has none: the first far enough behind its
    partner, or else the last far enough before it.  Nothing else moves.
    """
    out, paired = list(order), set(twin) | set(twin.values())
    place = {item: i for i, item in enumerate(out)}
    for item, other in twin.items():
        if item not in place or other not in place or abs(place[item] - place[other]) >= least:
            continue
        i, j = place[item], place[other]
        room = [k for k, x in enumerate(out) if x not in paired and abs(k - j) >= least]
        if not room:
            raise ValueError(f"{item!r} and {other!r} can't be {least} places apart")
        k = min((k for k in room if k > j), default=None)
        k = max(room) if k is None else k
        out[i], out[k] = out[k], out[i]
        place[out[i]], place[out[k]] = i, k
    return out


def swap_places(texts: Column, places: list[str], seed: str) -> Column:
    """A text in which the first known place is another one, chosen by a hash; as it is without any."""
    found = F.regexp_extract(texts, r"\b(" + "|".join(map(re.escape, places)) + r")\b", 1)
    others = F.filter(F.array(*map(F.lit, places)), lambda p: p != found)
    pick = F.get(others, F.pmod(F.xxhash64(texts, F.lit(seed)), F.size(others)).cast("int"))
    return F.when(found != "", F.replace(texts, found, pick)).otherwise(texts)


# -- hooks for models: each is a function that may be replaced, with a rule as its default -----------


def rule_classifier(posts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Topics by the aliases that a text names; what a model would return, checked by reply_errors() alike."""
    names = taxonomy.select("macro", "sub", F.explode("aliases").alias("alias")).withColumn("phrase", F.array_join(X.tokenize(F.col("alias")), " "))
    grams = posts.select("post_id", F.explode(F.array_distinct(X.ngrams(X.tokenize(F.col("text")), 1, 4, []))).alias("phrase"))
    hits = grams.join(names, "phrase").groupBy("post_id").agg(F.sort_array(F.collect_set(F.struct("macro", "sub"))).alias("topics"))
    return posts.select("post_id").join(hits, "post_id", "left").withColumn("topics", F.coalesce("topics", F.array().cast("array<struct<macro:string,sub:string>>")))


def rule_names(clusters: DataFrame) -> DataFrame:
    """A cluster's name by its commonest phrase; posts of one cached subject are one cluster, none is lost."""
    n = clusters.select("cluster", F.explode(F.array_distinct(X.ngrams(X.tokenize(F.col("text")), 2, 3))).alias("phrase")).groupBy("cluster", "phrase").agg(F.count("*").alias("n"))
    best = n.groupBy("cluster").agg(F.max_by("phrase", F.struct("n", "phrase")).alias("name"))
    return clusters.groupBy("cluster").agg(F.count("*").alias("posts")).join(best, "cluster", "left").withColumn("name", F.coalesce(X.title_label(F.col("name")), F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))))


def clean_names(named: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Names that a model gave: keys as slugs, kinds known, no target twice, labels cut at 60; with the reason for those out."""
    known = taxonomy.select("macro").distinct().withColumn("_m", F.lit(True))
    out = named.join(known, "macro", "left").withColumn("key", X.slug(F.col("key"))).withColumn("label", F.substring("label", 1, 60))
    twice = F.row_number().over(Window.partitionBy("macro", "key").orderBy("cluster"))
    out = out.withColumn("_n", twice)
    reason = F.when(F.col("_m").isNull(), "macro").when(F.coalesce("key", F.lit("")) == "", "key").when(~F.col("kind").isin("story", "gap", "noise"), "kind").when(F.col("_n") > 1, "repeated")
    return out.withColumn("reason", reason).drop("_m", "_n")


def checked_passages(passages: DataFrame, posts: DataFrame) -> DataFrame:
    """Of what a model quotes or groups only what the input holds: known ids, literal quotes."""
    return passages.join(posts.select("post_id", "text"), "post_id").filter(F.col("text").contains(F.col("quote"))).drop("text")


def hashed_embedding(dim: int = 64):
    """A pandas UDF from text to a unit vector of hashed words; a model takes its place where there is one."""
    import numpy as np
    from pyspark.sql import types as T

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        import zlib

        out = []
        for t in texts:
            v = np.zeros(dim)
            for w in re.findall(r"\w+", (t or "").lower()):
                h = zlib.crc32(w.encode())
                v[h % dim] += 1 if h >> 16 & 1 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype("float32").tolist())
        return pd.Series(out)

    return embed


STOP = frozenset(fixed.PHRASE_STOP)
