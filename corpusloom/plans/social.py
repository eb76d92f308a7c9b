"""Queries on posts: rollups, enrichment, windows, state; each with its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import timefn as T
from ..operators import enrich, evaluation, incidents, rollup, state, stories, windows
from ..operators import graph
from ..sources.readers import table
from . import staging as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AT = f"TIMESTAMP '{S.AS_OF}'"


def query(sql: str | None = None, staged: bool = True):
    """Register a query under its function's name; sql is what follows the staging tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = f"WITH {S.SQL}{',' if not sql.lstrip().upper().startswith('SELECT') else ''} {sql}" if staged else sql
        return f

    return add


def _with_roster(spark, d):
    return enrich.with_author(S.posts(spark, d), S.roster(spark, d))


@query("""t AS (
  SELECT DISTINCT post_id, macro, CAST(NULL AS VARCHAR) AS sub FROM topics UNION ALL SELECT DISTINCT post_id, macro, sub FROM topics WHERE sub IS NOT NULL
), f AS (
  SELECT p.*, unnest(list_distinct(['all'] || coalesce(groups, []))) AS scope FROM posts p LEFT JOIN roster USING (author_id)
) SELECT day, t.macro, t.sub, scope, count(*) FILTER (type <> 'retweet') AS posts, count(*) FILTER (type = 'retweet') AS retweets,
         count(DISTINCT member) AS members, CAST(sum(engagement) AS BIGINT) AS engagement
FROM f JOIN t ON f.post_id = t.post_id GROUP BY 1, 2, 3, 4""")
def topic_day_rollup(spark, d):
    """Posts, retweets, members and engagement by day, macro, sub and scope."""
    return rollup.topic_day(S.with_topic_arrays(_with_roster(spark, d)))


_WINDOWS = f"""r AS (
  SELECT DISTINCT p.post_id, t.macro, p.created, p.member, p.engagement, date_diff('day', CAST(created - INTERVAL 5 HOUR AS DATE), CAST({AT} - INTERVAL 5 HOUR AS DATE)) AS back,
         epoch(created) > epoch({AT}) - 86400 AS young FROM posts p JOIN topics t ON p.post_id = t.post_id
), w AS (
  SELECT macro, count(*) FILTER (back = 0) AS n_today, count(*) FILTER (young) AS n24, count(*) AS n_week, CAST(coalesce(sum(engagement) FILTER (young), 0) AS BIGINT) AS eng24,
         CAST(sum(engagement) AS BIGINT) AS eng_week, count(DISTINCT member) FILTER (young) AS m24, count(DISTINCT member) AS m_week,
         [count(*) FILTER (back = 6), count(*) FILTER (back = 5), count(*) FILTER (back = 4), count(*) FILTER (back = 3), count(*) FILTER (back = 2), count(*) FILTER (back = 1), count(*) FILTER (back = 0)] AS trend,
         [count(DISTINCT member) FILTER (back = 6), count(DISTINCT member) FILTER (back = 5), count(DISTINCT member) FILTER (back = 4), count(DISTINCT member) FILTER (back = 3),
          count(DISTINCT member) FILTER (back = 2), count(DISTINCT member) FILTER (back = 1), count(DISTINCT member) FILTER (back = 0)] AS people
  FROM r WHERE back BETWEEN 0 AND 6 GROUP BY macro
)"""


def _windows(spark, d):
    p = S.posts(spark, d)
    rows = p.drop("macro", "sub").join(S.topics(p).select("post_id", "macro").distinct(), "post_id").withColumn("day", T.et_date(F.col("created")))
    return rows, rollup.topic_windows(rows, S.as_of())


@query(_WINDOWS + " SELECT macro, n_today, n24, n_week, eng24, eng_week, m24, m_week, CAST(trend AS VARCHAR) AS trend, CAST(people AS VARCHAR) AS people FROM w")
def topic_windows(spark, d):
    """Counts today, in 24 hours and in the week, people, and the trend of each macro."""
    as_text = lambda c: F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]")).alias(c)
    return _windows(spark, d)[1].select("macro", "n_today", "n24", "n_week", "eng24", "eng_week", "m24", "m_week", as_text("trend"), as_text("people"))


@query(_WINDOWS + f""", g AS (
  SELECT r.macro, list(n ORDER BY region) AS c FROM (
    SELECT m.macro, x.r_name AS region, count(z.post_id) AS n FROM (SELECT DISTINCT macro FROM r WHERE back BETWEEN 0 AND 6) m CROSS JOIN region x
    LEFT JOIN (SELECT r.post_id, r.macro, ro.groups[1] AS g FROM r JOIN posts p ON p.post_id = r.post_id JOIN roster ro ON ro.author_id = p.author_id WHERE young AND back BETWEEN 0 AND 6) z ON z.macro = m.macro AND z.g = x.r_name
    GROUP BY 1, 2) r GROUP BY 1
), v AS (
  SELECT w.*, g.c, coalesce(nullif(list_sum(trend[1:6]) / 6.0, 0), 1) AS base, coalesce(nullif(list_sum(people[1:6]) / 6.0, 0), 1) AS m_mean, list_sum(trend) / 7.0 AS mean, list_sum(g.c) AS tot FROM w JOIN g USING (macro)
), u AS (
  SELECT *, floor(100.0 * (n24 - base) / base + 0.5) AS d FROM v
), s AS (
  SELECT macro, CAST(d AS BIGINT) AS d,
    0.5 + 0.5 * greatest(-1, least(1, d / 50.0)) AS volume,
    0.5 + 0.5 * greatest(-1, least(1, ((trend[7] - trend[5]) / 2.0 - (trend[5] - trend[1]) / 4.0) / (coalesce(nullif(mean, 0), 1) * 0.1))) AS acceleration,
    0.5 + 0.5 * greatest(-1, least(1, ((m24 - m_mean) / m_mean) / 0.5)) AS adoption,
    (CASE WHEN tot = 0 THEN 1.0 ELSE 1.0 / list_sum(list_transform(c, lambda x: (x / tot) * (x / tot))) END - 1) / greatest(1, len(c) - 1) AS spread,
    0.5 + 0.5 * greatest(-1, least(1, (CASE WHEN tot > 0 THEN eng24 / tot ELSE 0.0 END / coalesce(nullif(CASE WHEN n_week > 0 THEN eng_week / n_week ELSE 1.0 END, 0), 1) - 1) / 0.5)) AS engagement
  FROM u
) SELECT macro, d, CAST(floor(100.0 * (0.4 * volume + 0.2 * acceleration + 0.2 * adoption + 0.1 * spread + 0.1 * engagement) + 0.5) AS BIGINT) AS score,
         floor(volume * 1000 + 0.5) / 1000 AS volume, floor(spread * 1000 + 0.5) / 1000 AS spread FROM s""")
def topic_momentum(spark, d):
    """Change against the baseline and momentum per macro, over groups by region."""
    rows, windows_ = _windows(spark, d)
    regions = table(spark, d, "region").agg(F.collect_set("r_name")).scalar()  # a dimension's names
    young = rows.filter(T.within_hours(F.col("created"), S.as_of(), 24, future=True)).join(S.roster(spark, d).select("author_id", F.col("groups")[0].alias("region")), "author_id")
    n = young.groupBy("macro", "region").agg(F.count("*").alias("n"))
    grid = windows_.select("macro", F.explode(regions).alias("region"))
    groups = grid.join(n, ["macro", "region"], "left").groupBy("macro").agg(F.transform(F.array_sort(F.collect_list(F.struct("region", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("groups"))
    out = rollup.topic_rows(windows_, groups)
    return out.select("macro", "d", "momentum.score", M.places(F.col("momentum.volume"), 3).alias("volume"), M.places(F.col("momentum.spread"), 3).alias("spread"))


@query("""f AS (SELECT p.*, unnest(list_distinct(['all'] || coalesce(groups, []))) AS scope FROM posts p LEFT JOIN roster USING (author_id)),
g AS (SELECT scope, count(*) AS posts, CAST(floor(100.0 * count(*) FILTER (type IN ('tweet', 'quote')) / count(*) + 0.5) AS BIGINT) AS original_pct,
  CAST(floor(100.0 * count(*) FILTER (type = 'reply') / count(*) + 0.5) AS BIGINT) AS reply_pct, count(DISTINCT author_id) AS accounts, count(DISTINCT member) AS people,
  CAST(sum(engagement) AS BIGINT) AS engagement, count(*) FILTER (member IS NULL) AS unidentified FROM f GROUP BY 1)
SELECT *, CAST(greatest(0, 100 - original_pct - reply_pct) AS BIGINT) AS repost_pct FROM g""")
def scope_stats(spark, d):
    """Posts, mix, accounts, people and engagement per scope."""
    flat = _with_roster(spark, d).withColumn("scope", F.explode(rollup.scopes(F.col("groups"))))
    return rollup.scope_stats(flat, ["scope"])


@query(f"""c AS (SELECT CAST(15 - floor((epoch({AT}) - epoch(created)) / 10800) AS BIGINT) AS bucket FROM posts WHERE epoch(created) <= epoch({AT}) AND epoch({AT}) - epoch(created) < 172800)
SELECT CAST(b.range AS BIGINT) AS bucket, count(c.bucket) AS n FROM range(16) b LEFT JOIN c ON c.bucket = b.range GROUP BY 1""")
def capture_curve_48h(spark, d):
    """Posts in each three hours of the last two days."""
    return rollup.curve(S.posts(spark, d), S.as_of())


@query(f"""c AS (SELECT *, k % 7 <> 0 AS complete, epoch({AT}) - epoch(created) >= 0 AND epoch({AT}) - epoch(created) < 86400 AS young, k % 7 <> 0 AND k % 5 <> 0 AS tagged FROM posts)
SELECT count(*) FILTER (young) AS captured, count(*) FILTER (young AND complete) AS classified, count(*) FILTER (young AND tagged) AS tagged, max(day) FILTER (complete) AS through,
  count(*) FILTER (young) - count(*) FILTER (young AND complete) AS pending, count(*) FILTER (young) > 0 AND count(*) FILTER (young AND complete) = 0 AS paused FROM c""")
def coverage_24h(spark, d):
    """How far classification has come in the last day."""
    p = S.posts(spark, d).withColumn("complete", F.col("k") % 7 != 0).withColumn("n_topics", F.when((F.col("k") % 7 != 0) & (F.col("k") % 5 != 0), 1).otherwise(0))
    return rollup.coverage(p, S.as_of())


@query("SELECT conv_id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id", staged=False)
def latest_version_dedupe(spark, d):
    """The latest version of each record."""
    return windows.latest_version(table(spark, d, "conversations"), "conv_id", "turn", "turn")


@query("SELECT author_id, arg_min(post_id, (created, post_id)) AS post_id FROM posts GROUP BY author_id")
def earliest_use(spark, d):
    """The first post of each author."""
    return windows.argmin(S.posts(spark, d), "author_id", "post_id", "created", "post_id")


@query("SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", staged=False)
def anti_join_unseen(spark, d):
    """Records of a batch that the archive lacks."""
    return enrich.unseen(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")))


@query("""x AS (SELECT post_id, macro AS topics, k % 4 <> 0 AS completed, k % 23 = 0 AS corrected, k % 4 = 0 AS pending, k % 10 AS context_version FROM posts WHERE post_id % 3 <> 0),
y AS (SELECT post_id, 'n' || macro AS topics, TRUE AS completed, k % 29 = 0 AS corrected, k % 11 = 0 AS pending, k % 7 AS context_version FROM posts WHERE post_id % 5 <> 0),
z AS (SELECT coalesce(x.post_id, y.post_id) AS post_id, x, y, coalesce(y.pending AND NOT y.corrected, FALSE) AS passed,
  x.post_id IS NOT NULL AND (y.post_id IS NULL OR coalesce(y.pending AND NOT y.corrected, FALSE) OR (NOT y.corrected AND (x.corrected OR (x.completed AND x.context_version > y.context_version)))) AS live FROM x FULL JOIN y ON x.post_id = y.post_id)
SELECT post_id, CASE WHEN live THEN 'live' WHEN NOT passed THEN 'nightly' ELSE 'pending' END AS source, CASE WHEN live THEN x.topics ELSE y.topics END AS topics, CASE WHEN live THEN x.completed ELSE y.completed END AS completed,
  CASE WHEN live THEN x.corrected ELSE y.corrected END AS corrected, CASE WHEN live THEN x.pending ELSE y.pending END AS pending, CASE WHEN live THEN x.context_version ELSE y.context_version END AS context_version FROM z""")
def live_nightly_merge(spark, d):
    """One interpretation per post from the live and the nightly one."""
    p = S.posts(spark, d)
    k = F.col("k")
    live = p.filter("post_id % 3 <> 0").select("post_id", F.col("macro").alias("topics"), (k % 4 != 0).alias("completed"), (k % 23 == 0).alias("corrected"), (k % 4 == 0).alias("pending"), (k % 10).alias("context_version"))
    nightly = p.filter("post_id % 5 <> 0").select("post_id", F.concat(F.lit("n"), F.col("macro")).alias("topics"), F.lit(True).alias("completed"), (k % 29 == 0).alias("corrected"), (k % 11 == 0).alias("pending"), (k % 7).alias("context_version"))
    return enrich.live_over_nightly(live, nightly)


@query("""SELECT p.post_id, t.macro, t.sub, FALSE AS inherited FROM posts p JOIN topics t ON p.post_id = t.post_id WHERE type <> 'retweet'
UNION ALL SELECT p.post_id, t.macro, t.sub, TRUE FROM posts p JOIN posts o ON p.ref_id = o.post_id JOIN topics t ON t.post_id = o.post_id WHERE p.type = 'retweet' AND date_diff('day', o.day, p.day) BETWEEN 0 AND 2""")
def repost_inheritance(spark, d):
    """Reposts take the topics of an original of the same day or two before."""
    p = S.posts(spark, d)
    return enrich.inherit_topics(p, S.topics(p))


@query("""b AS (SELECT p.post_id, p.type, p.ref_id, CASE WHEN k % 3 = 0 THEN 'e' || ref_id END AS embedded FROM posts p WHERE ref_id IS NOT NULL),
j AS (SELECT b.*, s.post_id AS sid, a.post_id AS aid, b.type IN ('quote', 'reply') AS fit FROM b LEFT JOIN posts s ON s.post_id = b.ref_id AND s.post_id % 2 = 0 LEFT JOIN posts a ON a.post_id = b.ref_id AND a.type <> 'retweet')
SELECT post_id, CASE WHEN fit THEN coalesce(embedded, 's' || sid, 'a' || aid) END AS context,
  CASE WHEN NOT fit THEN 'none' WHEN embedded IS NOT NULL THEN 'embedded' WHEN sid IS NOT NULL THEN 'store' WHEN aid IS NOT NULL THEN 'archive' ELSE 'none' END AS context_source FROM j""")
def context_coalesce(spark, d):
    """The referenced post from the first of three places that has it."""
    p = S.posts(spark, d)
    text = lambda c: F.concat(F.lit(c), F.col("post_id").cast("string")).alias("text")
    own = p.filter("ref_id is not null").select("post_id", "type", "ref_id", F.when(F.col("k") % 3 == 0, F.concat(F.lit("e"), F.col("ref_id").cast("string"))).alias("embedded"))
    out = enrich.resolve_context(own, p.filter("post_id % 2 = 0").select("post_id", text("s")), p.filter("type <> 'retweet'").select("post_id", text("a")))
    return out.select("post_id", "context", "context_source")


@query("""SELECT p.post_id, p.type, CASE WHEN type = 'retweet' THEN 0 WHEN m.post_id IS NOT NULL AND NOT unavailable THEN refreshed ELSE engagement END AS engagement,
CASE WHEN type = 'retweet' THEN 'none' WHEN m.post_id IS NOT NULL AND NOT unavailable THEN 'refreshed' ELSE 'capture' END AS metrics_source FROM posts p LEFT JOIN metrics m ON p.post_id = m.post_id""")
def metrics_fallback_join(spark, d):
    """Later metrics where there are any, else those of the capture."""
    return enrich.with_metrics(S.posts(spark, d).select("post_id", "type", "engagement"), S.metrics(spark, d))


@query("SELECT ref_id, count(*) AS n FROM posts WHERE ref_id IS NOT NULL AND ref_id NOT IN (SELECT post_id FROM posts WHERE type = 'tweet') GROUP BY 1 ORDER BY n DESC, ref_id LIMIT 25")
def most_referenced(spark, d):
    """The 25 most referenced posts that aren't held."""
    p = S.posts(spark, d)
    return enrich.most_referenced(p, p.filter("type = 'tweet'"), 25)


@query("SELECT CAST((created AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS et_day, count(*) AS posts, min(created) AS first, max(created) AS last FROM posts GROUP BY 1")
def et_day_buckets(spark, d):
    """posts per calendar day of the zone that days are cut by."""
    return S.posts(spark, d).groupBy(T.et_date(F.col("created")).alias("et_day")).agg(F.count("*").alias("posts"), F.min("created").alias("first"), F.max("created").alias("last"))


@query("""v AS (SELECT day, count(*) AS posts, count(*) FILTER (type <> 'retweet') AS originals, count(*) FILTER (type = 'retweet') AS reposts FROM posts GROUP BY day)
SELECT *, floor(posts * 0.5 * 10 + 0.5) / 10 AS cost_cents, day > (SELECT min(day) FROM v) AND day < (SELECT max(day) FROM v) AS interior FROM v""")
def volume_interior_days(spark, d):
    """Volume and reading cost per day; the first and last day are marked as cut off."""
    return rollup.volume(S.posts(spark, d))


@query("""n AS (SELECT macro, day, count(*) AS n FROM posts GROUP BY 1, 2),
g AS (SELECT m.macro, CAST(unnest(generate_series((SELECT min(day) FROM n), (SELECT max(day) FROM n), INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT macro FROM n) m),
f AS (SELECT g.macro, g.day, coalesce(n.n, 0) AS n FROM g LEFT JOIN n ON n.macro = g.macro AND n.day = g.day)
SELECT *, floor(avg(n) OVER (PARTITION BY macro ORDER BY day ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) * 10000 + 0.5) / 10000 AS baseline FROM f""")
def trailing_baseline(spark, d):
    """Mean of the six days before, over days without gaps."""
    n = S.posts(spark, d).groupBy("macro", "day").agg(F.count("*").alias("n"))
    return rollup.baseline(n, ["macro"], "day", "n")


@query("""n AS (SELECT macro, day, count(*) AS n FROM posts GROUP BY 1, 2)
SELECT macro, day, n, CAST(sum(n) OVER (PARTITION BY macro ORDER BY day) AS BIGINT) AS total, (n - lag(n, 2) OVER w) / 2.0 - (lag(n, 2) OVER w - lag(n, 6) OVER w) / 4.0 AS acceleration FROM n WINDOW w AS (PARTITION BY macro ORDER BY day)""")
def running_and_acceleration(spark, d):
    """Running totals and acceleration per macro."""
    n = S.posts(spark, d).groupBy("macro", "day").agg(F.count("*").alias("n"))
    return n.withColumn("total", windows.running_total(F.col("n"), "macro", "day")).withColumn("acceleration", windows.acceleration(F.col("n"), "macro", "day"))


@query("""f AS (SELECT author_id || '-' || macro AS key, post_id, created, author_id, member FROM posts),
a AS (SELECT *, CASE WHEN created - lag(created) OVER w <= INTERVAL 48 HOUR THEN 0 ELSE 1 END AS fresh FROM f WINDOW w AS (PARTITION BY key ORDER BY created, post_id)),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY created, post_id) AS island FROM a)
SELECT key, CAST(island AS BIGINT) AS island, min(created) AS since, max(created) AS last, count(*) AS posts FROM b GROUP BY 1, 2""")
def session_48h(spark, d):
    """Runs of one author and macro whose posts are at most 48 hours apart."""
    p = S.posts(spark, d).withColumn("key", F.concat_ws("-", F.col("author_id").cast("string"), "macro"))
    return windows.islands(p, "key", "created", 48 * 3600, "post_id").groupBy("key", "island").agg(F.min("created").alias("since"), F.max("created").alias("last"), F.count("*").alias("posts"))


@query(f"""f AS (SELECT author_id || '-' || macro AS key, post_id, created, author_id, member FROM posts WHERE type <> 'retweet'),
a AS (SELECT *, CASE WHEN created - lag(created) OVER w <= INTERVAL 48 HOUR THEN 0 ELSE 1 END AS fresh FROM f WINDOW w AS (PARTITION BY key ORDER BY created, post_id)),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY created, post_id) AS island FROM a),
c AS (SELECT key, island, min(created) AS since, max(created) AS last, count(*) AS posts, count(DISTINCT author_id) AS accounts, count(DISTINCT member) AS people, arg_min(post_id, (created, post_id)) AS lead, arg_max(post_id, (created, post_id)) AS latest,
  list(post_id ORDER BY created, post_id) AS ids, epoch({AT}) - epoch(max(created)) AS quiet FROM b GROUP BY 1, 2)
SELECT key || '--' || strftime(since, '%Y-%m-%d') AS id, key, since, last, posts, accounts, people, lead, latest, array_to_string(ids, ',') AS timeline, CASE WHEN quiet <= 43200 THEN 'active' WHEN quiet <= 129600 THEN 'monitoring' ELSE 'resolved' END AS lifecycle
FROM c WHERE quiet <= 604800""")
def incident_lifecycle(spark, d):
    """Incidents with timeline and phase; resolved ones older than a week are gone."""
    p = S.posts(spark, d).filter("type <> 'retweet'").withColumn("key", F.concat_ws("-", F.col("author_id").cast("string"), "macro"))
    out = incidents.group_incidents(p, S.as_of())
    return out.select("id", "key", "since", "last", "posts", "accounts", "people", "lead", "latest", F.array_join(F.transform("timeline", lambda x: x["post_id"]).cast("array<string>"), ",").alias("timeline"), "lifecycle")


@query("""SELECT macro, CAST(sum(engagement) FILTER (r <= 10) AS DOUBLE) / sum(engagement) AS top_share FROM (
  SELECT macro, engagement, row_number() OVER (PARTITION BY macro ORDER BY engagement DESC, author_id) AS r FROM (SELECT macro, author_id, sum(engagement) AS engagement FROM posts GROUP BY 1, 2)) GROUP BY 1""")
def top10_share(spark, d):
    """Share of engagement that the ten strongest accounts of a macro have."""
    n = S.posts(spark, d).groupBy("macro", "author_id").agg(F.sum("engagement").alias("engagement"))
    return windows.top_share(n, "macro", "engagement", 10, "author_id")


@query("""SELECT sub, arg_max(author_id, (n, -author_id)) AS lead_author, max(n) AS posts FROM (SELECT sub, author_id, count(*) AS n FROM posts WHERE sub IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def lead_author(spark, d):
    """The author with the most posts per sub, of equals the least."""
    n = S.posts(spark, d).filter("sub is not null").groupBy("sub", "author_id").agg(F.count("*").alias("n"))
    return n.groupBy("sub").agg(F.max_by("author_id", F.struct("n", -F.col("author_id"))).alias("lead_author"), F.max("n").alias("posts"))


@query("""l AS (SELECT l_shipdate, l_returnflag AS stage, l_linestatus = 'F' AS batch, 1 AS calls, CAST(l_quantity * 100 AS BIGINT) AS i, CAST(l_extendedprice AS BIGINT) AS o, CAST(l_quantity AS BIGINT) AS cr, CAST(l_linenumber AS BIGINT) AS cw FROM lineitem)
SELECT stage, count(*) AS calls, CAST(sum(i + o + cr + cw) AS BIGINT) AS tokens, floor(sum((i * 5.0 + cr * 0.5 + cw * 6.25 + o * 25.0) / 1e6 * CASE WHEN batch THEN 0.5 ELSE 1.0 END) * 10000 + 0.5) / 10000 AS usd FROM l GROUP BY 1""")
def spend_by_stage(spark, d):
    """Calls, tokens and dollars per stage."""
    whole = lambda c: F.round(c, 0).cast("bigint")
    ledger = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("stage"), (F.col("l_linestatus") == "F").alias("batch"), F.lit(1).alias("calls"), whole(F.col("l_quantity") * 100).alias("input"), F.rint("l_extendedprice").cast("bigint").alias("output"), whole(F.col("l_quantity")).alias("cache_read"), F.col("l_linenumber").cast("bigint").alias("cache_write"))
    return rollup.spending(ledger)


@query("SELECT scope, count(DISTINCT member) AS people FROM (SELECT member, unnest(list_distinct(['all'] || coalesce(groups, []))) AS scope FROM posts LEFT JOIN roster USING (author_id)) GROUP BY 1")
def active_denominators(spark, d):
    """People who have posted, per scope."""
    return rollup.people_per_group(_with_roster(spark, d))


@query("""g AS (SELECT post_id, macro FROM topics UNION SELECT post_id, 'unassigned' FROM posts WHERE post_id NOT IN (SELECT post_id FROM topics))
SELECT macro AS pool, count(DISTINCT post_id) AS posts FROM g GROUP BY 1""")
def pools(spark, d):
    """Posts per macro, and those without one."""
    return rollup.pools(S.with_topic_arrays(S.posts(spark, d)))


@query("SELECT macro, sub, count(DISTINCT post_id) AS posts, max(day) AS last_seen FROM posts GROUP BY 1, 2")
def assignment_counts(spark, d):
    """Posts and last day per macro and sub."""
    return stories.assignment_counts(S.posts(spark, d))


@query("""s AS (SELECT macro, sub, count(*) AS posts, count(DISTINCT member) AS members FROM posts WHERE sub IS NOT NULL GROUP BY 1, 2),
t AS (SELECT s.*, posts / sum(posts) OVER (PARTITION BY macro) AS share, sum(posts) OVER (PARTITION BY macro) AS total FROM s),
u AS (SELECT t.macro, t.sub, median(o.posts) AS sibling_median, count(*) AS siblings FROM t JOIN s o ON o.macro = t.macro AND o.sub <> t.sub GROUP BY 1, 2)
SELECT t.macro, t.sub, t.posts, t.members, floor(share * 1000 + 0.5) / 1000 AS share, coalesce(siblings, 0) AS siblings, sibling_median,
  t.posts >= 8 AND members >= 3 AND (share >= 0.6 OR (coalesce(siblings, 0) >= 3 AND t.posts >= 3 * sibling_median AND t.posts >= 8 AND share >= 0.25)) AS elevate
FROM t LEFT JOIN u ON u.macro = t.macro AND u.sub = t.sub""")
def elevate_median(spark, d):
    """Subs that outgrow their macro."""
    p = S.posts(spark, d).filter("sub is not null")
    out = stories.elevate(p.groupBy("macro", "sub").agg(F.count("*").alias("posts"), F.countDistinct("member").alias("members")))
    return out.select("macro", "sub", "posts", "members", M.places(F.col("share"), 3).alias("share"), "siblings", "sibling_median", F.coalesce("elevate", F.lit(False)).alias("elevate"))


@query("""x AS (SELECT DISTINCT macro, sub, k FROM posts WHERE sub IS NOT NULL), t AS (SELECT macro, sub, DATE '2024-01-01' + CAST(k % 20 AS INT) AS entered, k % 17 = 0 AS retired, k % 19 = 0 AS dual, k % 23 = 0 AS anchored FROM x)
SELECT t.macro, t.sub, t.entered FROM t WHERE NOT retired AND NOT dual AND NOT anchored AND entered <= DATE '2024-01-31' - 21
AND NOT EXISTS (SELECT 1 FROM posts p WHERE p.macro = t.macro AND p.sub = t.sub AND p.day > DATE '2024-01-31' - 21 AND p.k % 4 <> 1)
AND (SELECT count(DISTINCT day) FROM posts WHERE day > DATE '2024-01-31' - 21 AND day <= DATE '2024-01-31') >= 20""")
def retire_quiet(spark, d):
    """Subs without a post on the classified days that may be retired."""
    p = S.posts(spark, d)
    k = F.col("k")
    tax = p.filter("sub is not null").select("macro", "sub", "k").distinct().select("macro", "sub", F.date_add(F.lit("2024-01-01").cast("date"), k % 20).alias("entered"), (k % 17 == 0).alias("retired"), (k % 19 == 0).alias("dual"), (k % 23 == 0).alias("anchored"))
    as_of = F.lit("2024-01-31").cast("date")
    # a day is classified here if it has posts at all: 20 of the 21 days up to as_of
    days = p.select("day").union(p.sparkSession.createDataFrame([("2024-01-31",)], "d string").select(F.col("d").cast("date"))).distinct()
    return stories.retire(tax, p.filter("k % 4 <> 1"), days, as_of).select("macro", "sub", "entered")


@query("""s AS (SELECT 'Story ' || (k % 37) AS story, 'm' || (k % 12) AS macro, count(*) AS posts, count(DISTINCT member) AS members, count(DISTINCT day) AS days FROM posts GROUP BY 1, 2),
n AS (SELECT story || ' ' || macro AS story, macro, posts, members, days FROM s),
u AS (SELECT *, rtrim(regexp_replace(substring(regexp_replace(regexp_replace(lower(story), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 32), '-+$', ''), '-') AS slug FROM n),
t AS (SELECT DISTINCT macro, 'story-' || (k % 5) || '-' || macro AS sub FROM posts),
v AS (SELECT u.*, row_number() OVER (PARTITION BY u.macro, slug ORDER BY posts DESC, story) AS twin, EXISTS (SELECT 1 FROM t WHERE t.macro = u.macro) AS known, EXISTS (SELECT 1 FROM t WHERE t.macro = u.macro AND t.sub = u.slug) AS there FROM u),
r AS (SELECT *, CASE WHEN NOT known THEN 'unknown macro' WHEN there THEN 'exists' WHEN posts < 5 THEN 'few posts' WHEN members < 3 THEN 'few members' WHEN days < 2 THEN 'few days' WHEN twin > 1 THEN 'twin' END AS reason FROM v),
o AS (SELECT story FROM r WHERE reason IS NULL ORDER BY posts DESC, story LIMIT 8)
SELECT story, macro, slug, posts, members, days, story IN (SELECT story FROM o) AS promoted, CASE WHEN story NOT IN (SELECT story FROM o) THEN coalesce(reason, 'cap') END AS reason FROM r""")
def auto_promote(spark, d):
    """Stories that become subtopics, the eight largest, and why others don't."""
    p = S.posts(spark, d)
    own = p.withColumn("macro", F.concat(F.lit("m"), (F.col("k") % 12).cast("string"))).withColumn("story", F.concat(F.lit("Story "), (F.col("k") % 37).cast("string"), F.lit(" "), F.col("macro")))
    scored = own.groupBy("story", "macro").agg(F.count("*").alias("posts"), F.countDistinct("member").alias("members"), F.countDistinct("day").alias("days"))
    tax = p.select("macro", F.concat(F.lit("story-"), (F.col("k") % 5).cast("string"), F.lit("-"), F.col("macro")).alias("sub")).distinct()
    return stories.promote(scored, tax)


@query("""SELECT post_id, array_to_string(list_distinct([macro] || CASE WHEN k % 3 = 0 THEN ['m' || ((k * 7) % 10)] ELSE [] END || CASE WHEN k % 2 = 0 THEN [macro, 'x'] ELSE [] END).list_sort(), ',') AS topics FROM posts""")
def union_distinct_topics(spark, d):
    """Union of topic lists, repeats out."""
    k, none = F.col("k"), F.array().cast("array<string>")
    more = F.when(k % 3 == 0, F.array(F.concat(F.lit("m"), ((k * 7) % 10).cast("string")))).otherwise(none)
    last = F.when(k % 2 == 0, F.array(F.col("macro"), F.lit("x"))).otherwise(none)
    return S.posts(spark, d).select("post_id", F.array_join(F.sort_array(enrich.union_topics(F.array("macro"), more, last)), ",").alias("topics"))


@query("""s AS (SELECT sub AS key, list(DISTINCT author_id) AS members FROM posts WHERE sub IS NOT NULL AND k % 2 = 1 GROUP BY 1), f AS (SELECT key, len(members) AS n, unnest(members) AS m FROM s)
SELECT a.key AS a, b.key AS b, count(*) AS shared, least(any_value(a.n), any_value(b.n)) AS smaller FROM f a JOIN f b ON a.m = b.m AND a.key < b.key GROUP BY 1, 2 HAVING count(*) >= 0.5 * least(any_value(a.n), any_value(b.n))""")
def array_overlap_join(spark, d):
    """Subs whose authors overlap by half of the smaller set."""
    sets = S.posts(spark, d).filter("sub is not null and k % 2 = 1").groupBy(F.col("sub").alias("key")).agg(F.collect_set("author_id").alias("members"))
    return enrich.overlap_pairs(sets, "key", "members").withColumn("smaller", F.col("smaller").cast("bigint"))


@query("""v AS (SELECT p.post_id, list_sort(list_distinct(list(t.macro))) AS ours, CASE WHEN any_value(p.k) % 4 = 0 THEN [any_value(p.macro)] ELSE list_sort(list_distinct(list(t.macro))) END AS theirs, 1.0 + any_value(p.k) % 3 AS weight
  FROM posts p JOIN topics t ON t.post_id = p.post_id GROUP BY 1),
j AS (SELECT *, len(list_intersect(ours, theirs)) / len(list_distinct(ours || theirs)) AS jac, CASE WHEN ours = theirs THEN 1 ELSE 0 END AS same FROM v)
SELECT count(*) AS n, floor(avg(same) * 10000 + 0.5) / 10000 AS exact, floor(avg(jac) * 10000 + 0.5) / 10000 AS jaccard, floor(sum(same * weight) / sum(weight) * 10000 + 0.5) / 10000 AS weighted_exact, floor(sum(jac * weight) / sum(weight) * 10000 + 0.5) / 10000 AS weighted_jaccard FROM j""")
def weighted_agreement(spark, d):
    """Agreement of two labellings, plain and weighted."""
    p = S.posts(spark, d)
    own = S.topics(p).groupBy("post_id").agg(F.sort_array(F.collect_set("macro")).alias("ours")).join(p.select("post_id", "k", "macro"), "post_id")
    pairs = own.select("ours", F.when(F.col("k") % 4 == 0, F.array("macro")).otherwise(F.col("ours")).alias("theirs"), (F.lit(1.0) + F.col("k") % 3).alias("weight"))
    return evaluation.agreement(pairs)


@query("SELECT quality AS truth, toxic AS guess, count(*) AS n FROM labels GROUP BY 1, 2", staged=False)
def confusion_counts(spark, d):
    """A two-by-two table of labels."""
    return evaluation.confusion(table(spark, d, "labels"), "quality", "toxic")


@query("""SELECT stratum, count(*) AS n FROM (SELECT CASE WHEN type = 'retweet' THEN 'retweet' WHEN engagement >= 10000 THEN 'strong' WHEN type = 'reply' AND sub IS NULL THEN 'bare reply' WHEN member % 10 = 0 THEN 'tenth' WHEN ref_id IS NULL AND type <> 'tweet' THEN 'lost' ELSE 'rest' END AS stratum FROM posts) GROUP BY 1""")
def stratum_partition(spark, d):
    """Strata by the first rule that holds; they cover the frame."""
    p = S.posts(spark, d)
    c = F.col
    rows = evaluation.strata(p, [("retweet", c("type") == "retweet"), ("strong", c("engagement") >= 10000), ("bare reply", (c("type") == "reply") & c("sub").isNull()), ("tenth", c("member") % 10 == 0), ("lost", c("ref_id").isNull() & (c("type") != "tweet"))])
    return evaluation.check_frame(rows, p.count())


@query("""SELECT post_id, created, n FROM (SELECT post_id, created, n, sum(n) OVER (ORDER BY created DESC, post_id DESC) AS s FROM (SELECT post_id, created, length('{"id":' || post_id || ',"e":' || engagement || '}') + 1 AS n FROM posts)) WHERE s <= 100000""")
def size_guard_prefix(spark, d):
    """The newest rows whose JSON fits 100,000 bytes."""
    rows = S.posts(spark, d).select("post_id", "created", F.to_json(F.struct(F.col("post_id").alias("id"), F.col("engagement").alias("e"))).alias("doc")).withColumn("n", (F.octet_length("doc") + 1).cast("bigint"))
    return windows.fitting_prefix(rows, F.col("n"), 100_000, F.desc("created"), F.desc("post_id"), bucket=-F.unix_date(F.to_date("created"))).select("post_id", "created", "n")


@query("""l AS (SELECT DISTINCT author_id, 'H' || author_id AS handle, 'Name ' || author_id AS name FROM posts WHERE author_id % 3 <> 0), r AS (SELECT 'h' || author_id AS handle, name AS member, status FROM roster WHERE author_id % 4 <> 0)
SELECT coalesce(lower(l.handle), r.handle) AS handle, l.author_id, coalesce(r.member, l.name) AS member, r.status, l.handle IS NOT NULL AS on_list, l.handle IS NULL AS stale, l.handle IS NOT NULL AND r.handle IS NULL AS untagged FROM l FULL JOIN r ON lower(l.handle) = r.handle""")
def roster_overlay(spark, d):
    """The list and the roster laid over each other."""
    c = F.col("author_id")
    listed = S.posts(spark, d).select("author_id").distinct().filter(c % 3 != 0).select("author_id", F.concat(F.lit("H"), c.cast("string")).alias("handle"), F.concat(F.lit("Name "), c.cast("string")).alias("name"))
    tags = S.roster(spark, d).filter(c % 4 != 0).select(F.concat(F.lit("h"), c.cast("string")).alias("handle"), F.col("name").alias("member"), "status")
    return enrich.overlay_roster(listed, tags)


@query("SELECT p.post_id, CAST(count(r.post_id) AS BIGINT) AS amplifiers FROM posts p LEFT JOIN posts r ON r.ref_id = p.post_id AND r.type = 'retweet' GROUP BY 1")
def amplifier_counts(spark, d):
    """Reposts of each post."""
    return enrich.amplifiers(S.posts(spark, d)).select("post_id", "amplifiers")


@query("SELECT DISTINCT post_id, story FROM (SELECT p.post_id, a.macro AS story FROM posts p JOIN posts a ON a.post_id = p.post_id WHERE a.post_id % 50 = 0 UNION ALL SELECT p.post_id, a.macro FROM posts p JOIN posts a ON a.post_id = p.ref_id WHERE a.post_id % 50 = 0)")
def anchored_posts(spark, d):
    """Posts that are an anchor or refer to one."""
    p = S.posts(spark, d)
    return enrich.by_id_or_reference(p.select("post_id", "ref_id"), p.filter("post_id % 50 = 0").select(F.col("post_id").alias("anchor"), F.col("macro").alias("story")))


@query("""c AS (SELECT post_id, CAST(created AS DATE) AS filed, post_id * 2 AS correction_id, 'c1' AS topics FROM posts WHERE post_id % 40 = 0 UNION ALL SELECT post_id, CAST(created AS DATE) + 1, post_id * 2 + 1, 'c2' FROM posts WHERE post_id % 80 = 0),
l AS (SELECT post_id, arg_max(topics, (filed, correction_id)) AS fixed FROM c GROUP BY 1), o AS (SELECT l.*, p.day FROM l JOIN posts p ON p.post_id = l.post_id),
s AS (SELECT p.post_id, o.fixed FROM posts p JOIN o ON o.post_id = p.ref_id WHERE p.type = 'retweet' AND date_diff('day', o.day, p.day) BETWEEN 0 AND 2 AND p.post_id NOT IN (SELECT post_id FROM l)),
e AS (SELECT post_id, fixed, 'direct' AS via FROM l UNION ALL SELECT post_id, fixed, 'repost' FROM s)
SELECT p.post_id, coalesce(fixed, macro) AS topics, coalesce(via, 'model') AS via FROM posts p LEFT JOIN e ON e.post_id = p.post_id""")
def corrections_applied(spark, d):
    """Human corrections, and the reposts that they reach."""
    p = S.posts(spark, d)
    one = p.filter("post_id % 40 = 0").select("post_id", F.to_date("created").alias("filed"), (F.col("post_id") * 2).alias("correction_id"), F.lit("c1").alias("topics"))
    two = p.filter("post_id % 80 = 0").select("post_id", F.date_add(F.to_date("created"), 1).alias("filed"), (F.col("post_id") * 2 + 1).alias("correction_id"), F.lit("c2").alias("topics"))
    return enrich.apply_corrections(p.select("post_id", F.col("macro").alias("topics")), p, one.union(two))


@query("""n AS (SELECT l_orderkey AS id, sha1(CAST(sum(l_linenumber) AS VARCHAR)) AS hash FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1), b AS (SELECT o_orderkey AS id, sha1(CAST(CASE WHEN o_orderkey % 2 = 0 THEN coalesce(x.s, 0) ELSE 0 END AS VARCHAR)) AS hash
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_linenumber) AS s FROM lineitem GROUP BY 1) x ON x.l_orderkey = o_orderkey WHERE o_orderkey % 5 < 3)
SELECT b.id, b.hash, CAST(8 AS INT) AS version, CASE WHEN n.id IS NULL THEN 'added' ELSE 'changed' END AS change FROM b LEFT JOIN n ON n.id = b.id WHERE n.id IS NULL OR n.hash <> b.hash""")
def versioned_append(spark, d):
    """What a batch adds to or changes in the store, with the next version."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_linenumber").alias("s"))
    store = s.filter("id % 3 <> 0").select("id", F.sha1(F.col("s").cast("string")).alias("hash"), F.lit(7).alias("version"))
    own = F.when(F.col("id") % 2 == 0, F.coalesce("s", F.lit(0))).otherwise(F.lit(0))
    batch = table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).filter("id % 5 < 3").join(s, "id", "left").select("id", F.sha1(own.cast("string")).alias("hash"))
    return enrich.versioned_append(store, batch).select("id", "hash", "version", "change")


@query("""s AS (SELECT day, post_id, 600 + engagement % 4000 AS w FROM posts), r AS (
  SELECT day, list({'o': post_id, 'w': w} ORDER BY post_id) AS x FROM s GROUP BY 1
) SELECT day, len(x) AS rows, CAST(list_sum(list_transform(x, lambda z: z.w)) AS BIGINT) AS weight FROM r""")
def chunk_totals(spark, d):
    """Rows and weight per day after packing into chunks; each chunk keeps its bounds, which is asserted."""
    packed = state.pack(S.posts(spark, d).withColumn("w", 600 + F.col("engagement") % 4000), "day", "post_id", "w")
    chunks = packed.groupBy("day", "chunk").agg(F.count("*").alias("rows"), F.sum("w").alias("weight"))
    ok = F.when((F.col("rows") <= 40) & (F.col("weight") <= 120_000), F.col("rows")).otherwise(F.raise_error(F.lit("chunk over its bounds")).cast("bigint"))
    return chunks.withColumn("rows", ok).groupBy("day").agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("weight").cast("bigint").alias("weight"))


@query("""SELECT *, b <= 500000 AS accepted FROM (SELECT request_id, day, bound, before AS reserved_before, before + bound AS b FROM (
  SELECT post_id AS request_id, day, CAST(engagement AS DOUBLE) AS bound, coalesce(sum(CAST(engagement AS DOUBLE)) OVER (PARTITION BY day ORDER BY created, post_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM posts))""")
def budget_reservation(spark, d):
    """Requests that the day's budget still allows."""
    r = S.posts(spark, d).select(F.col("post_id").alias("request_id"), "day", F.col("created").alias("requested"), F.col("engagement").cast("double").alias("bound"))
    out = state.reserve(r, F.lit(500_000))
    return out.select("request_id", "day", "bound", "reserved_before", (F.col("reserved_before") + F.col("bound")).alias("b"), "accepted")


@query("""b AS (SELECT author_id AS key, count(*) AS n, sum(engagement) AS e FROM posts WHERE day < DATE '2024-01-10' GROUP BY 1), x AS (SELECT author_id AS key, count(*) AS n, sum(engagement) AS e FROM posts WHERE day < DATE '2024-01-20' GROUP BY 1),
y AS (SELECT author_id AS key, count(*) AS n, sum(engagement) AS e FROM posts WHERE day < DATE '2024-01-10' OR day > DATE '2024-01-25' GROUP BY 1)
SELECT coalesce(b.key, x.key, y.key) AS key, CAST(coalesce(x.n, 0) + coalesce(y.n, 0) - coalesce(b.n, 0) AS BIGINT) AS n, CAST(coalesce(x.e, 0) + coalesce(y.e, 0) - coalesce(b.e, 0) AS BIGINT) AS e
FROM b FULL JOIN x ON b.key = x.key FULL JOIN y ON coalesce(b.key, x.key) = y.key""")
def three_way_counters(spark, d):
    """Counters that two sides have added to."""
    p = S.posts(spark, d)
    count = lambda f: p.filter(f).groupBy(F.col("author_id").alias("key")).agg(F.count("*").alias("n"), F.sum("engagement").cast("bigint").alias("e"))
    return enrich.merge_counters(count("day < '2024-01-10'"), count("day < '2024-01-20'"), count("day < '2024-01-10' or day > '2024-01-25'"), "key", ["n", "e"])


@query()
def repost_components(spark, d):
    """Groups of posts that refer to one another, by their least post."""
    p = S.posts(spark, d).filter("ref_id is not null")
    return graph.components(p.select(F.col("post_id").alias("a"), F.col("ref_id").alias("b"))).groupBy("root").agg(F.count("*").alias("posts"), F.max("node").alias("last"))


# every post refers to an earlier one at most, so a component's root is where the chain of references ends
ORACLE["repost_components"] = f"""WITH RECURSIVE {S.SQL.strip()}, n AS (SELECT post_id AS node FROM posts WHERE ref_id IS NOT NULL UNION SELECT ref_id FROM posts WHERE ref_id IS NOT NULL),
c AS (SELECT node, node AS root FROM n UNION SELECT c.node, p.ref_id FROM c JOIN posts p ON p.post_id = c.root WHERE p.ref_id IS NOT NULL)
SELECT root, count(*) AS posts, max(node) AS last FROM (SELECT node, min(root) AS root FROM c GROUP BY 1) GROUP BY 1"""


@query("""w AS (SELECT day, macro, count(*) FILTER (type <> 'retweet') AS posts, count(*) FILTER (type = 'retweet') AS retweets, count(DISTINCT member) AS members FROM posts GROUP BY 1, 2)
SELECT macro, CAST(sum(posts) AS BIGINT) AS posts, CAST(sum(retweets) AS BIGINT) AS retweets, count(DISTINCT day) AS active_days, max(members) AS top_members FROM w GROUP BY 1""")
def week_of(spark, d):
    """Sums, active days and the greatest daily number of members."""
    daily = S.posts(spark, d).groupBy("day", "macro").agg(F.count_if(F.col("type") != "retweet").alias("posts"), F.count_if(F.col("type") == "retweet").alias("retweets"), F.countDistinct("member").alias("members"))
    return rollup.week_summary(daily, ["macro"])


@query("""SELECT macro, sub, posts, CAST(row_number() OVER (PARTITION BY macro ORDER BY posts DESC, sub) AS INT) AS rank FROM (SELECT macro, sub, count(*) AS posts FROM posts WHERE sub IS NOT NULL GROUP BY 1, 2) QUALIFY rank <= 3""")
def top_subs(spark, d):
    """The three largest subs of each macro."""
    n = S.posts(spark, d).filter("sub is not null").groupBy("macro", "sub").agg(F.count("*").alias("posts"))
    return windows.ranked(n, "macro", [F.desc("posts"), F.asc("sub")], 3)


@query("SELECT post_id, author_id, created, type FROM posts ORDER BY created DESC, post_id DESC LIMIT 200")
def feed_200(spark, d):
    """The 200 newest posts."""
    return S.posts(spark, d).select("post_id", "author_id", "created", "type").orderBy(F.desc("created"), F.desc("post_id")).limit(200)


@query("SELECT macro, p.author_id, post_id, engagement, CAST(row_number() OVER (PARTITION BY macro ORDER BY engagement DESC, post_id) AS INT) AS rank FROM posts p QUALIFY rank <= 5")
def cluster_samples(spark, d):
    """The five strongest posts of each macro."""
    return windows.ranked(S.posts(spark, d).select("macro", "author_id", "post_id", "engagement"), "macro", [F.desc("engagement"), F.asc("post_id")], 5)


@query("""SELECT day, posts, CAST(least(greatest(ceil(avg(posts) OVER (ORDER BY day ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) * 1.5), 5), 100) AS INT) AS page FROM (SELECT day, count(*) AS posts FROM posts WHERE author_id < 20 GROUP BY 1)""")
def adaptive_pages(spark, d):
    """Page size from the last six counts."""
    n = S.posts(spark, d).filter("author_id < 20").groupBy("day").agg(F.count("*").alias("posts"))
    return n.withColumn("all", F.lit(0)).withColumn("page", windows.adaptive_size(F.col("posts"), "all", "day")).drop("all")


@query(f"""g AS (SELECT 'g' || (k % 30) AS label, post_id, member, created FROM posts WHERE k % 6 = 0 AND epoch({AT}) - epoch(created) < 14 * 86400),
r AS (SELECT label, count(DISTINCT member) AS members, count(DISTINCT member) FILTER (epoch({AT}) - epoch(created) < 86400 AND epoch({AT}) >= epoch(created)) AS active_members, max(created) AS last_seen, count(DISTINCT post_id) AS posts FROM g GROUP BY 1),
o AS (SELECT *, active_members > 0 AS active, members >= 3 AS threshold FROM r), t AS (SELECT label FROM o ORDER BY (active AND threshold) DESC, (active_members >= 3) DESC, last_seen DESC, members DESC, label LIMIT 12)
SELECT *, (active AND threshold) OR label IN (SELECT label FROM t) AS visible FROM o""")
def emerging_visibility(spark, d):
    """Emerging groups and whether they are shown."""
    p = S.posts(spark, d).filter((F.col("k") % 6 == 0) & (T.age_seconds(F.col("created"), S.as_of()) < 14 * 86400))
    groups = p.groupBy(F.concat(F.lit("g"), (F.col("k") % 30).cast("string")).alias("label")).agg(F.collect_set("post_id").alias("ids"))
    return stories.emerging_rows(groups, p.select("post_id", "member", "created"), S.as_of())


@query(f"""SELECT macro, sub, n AS posts, n7 AS posts7, members, days, last_seen, floor(n / sum(n) OVER (PARTITION BY macro) * 1000 + 0.5) / 1000 AS share FROM (
SELECT macro, sub, count(*) AS n, count(*) FILTER (a < 7) AS n7, count(DISTINCT member) AS members, count(DISTINCT day) AS days, max(day) AS last_seen FROM (SELECT *, date_diff('day', day, DATE '2024-01-30') AS a FROM posts) WHERE a BETWEEN 0 AND 13 GROUP BY 1, 2)""")
def sub_shares(spark, d):
    """Posts, people, days and share of each sub in two weeks."""
    return stories.share_rows(S.posts(spark, d), F.lit("2024-01-30").cast("date"))
