"""Queries on serving, upkeep and job state over the posts; each with its DuckDB form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..functions import text as X
from ..functions import timefn as T
from ..operators import evaluation, incidents, learning, serving, state
from ..sources import acquire
from ..sources.readers import table
from . import staging as S
from .social import AT

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = f"WITH {S.SQL}{'' if sql.lstrip().upper().startswith('SELECT') else ','} {sql}"
        return f

    return add


@query("SELECT post_id, type FROM posts WHERE post_id > 1234 AND type IN ('tweet', 'quote', 'reply') AND post_id NOT IN (SELECT post_id FROM metrics)")
def refreshable_after_cursor(spark, d):
    """Posts beyond a cursor that metrics should be read for."""
    p = S.posts(spark, d).filter(serving.after_cursor(F.col("post_id"), F.lit("1234")))
    return serving.refreshable(p, S.metrics(spark, d)).select("post_id", "type")


@query("""d AS (SELECT k.key, p.post_id, p.engagement FROM (SELECT DISTINCT macro AS key FROM posts UNION SELECT DISTINCT macro || '/' || sub FROM posts WHERE sub IS NOT NULL) k
JOIN posts p ON p.macro = split_part(k.key, '/', 1) AND (split_part(k.key, '/', 2) = '' OR p.sub = split_part(k.key, '/', 2)))
SELECT key, post_id, CAST(row_number() OVER (PARTITION BY key ORDER BY engagement DESC, post_id) AS INT) AS place FROM d QUALIFY place <= 10""")
def drill_down_top(spark, d):
    """The ten strongest posts behind each row key."""
    p = S.posts(spark, d)
    keys = p.select(F.col("macro").alias("key")).union(p.filter("sub is not null").select(F.concat("macro", F.lit("/"), "sub"))).distinct()
    return serving.drill_down(keys, p.select("macro", "sub", "post_id", "created", "engagement"), True).filter("place <= 10").select("key", "post_id", "place")


@query(f"""b AS (SELECT *, CAST(least(7, greatest(0, 7 - floor((epoch({AT}) - epoch(created)) / 10800))) AS INT) AS b FROM posts WHERE created >= {AT} - INTERVAL 2 DAY)
SELECT macro AS cluster, count(*) AS posts, count(DISTINCT member) AS people, count(DISTINCT author_id) AS accounts, CAST(sum(engagement) AS BIGINT) AS engagement, arg_max(post_id, (engagement, -post_id)) AS sample,
  count(*) FILTER (b <= 0) || ',' || count(*) FILTER (b <= 3) || ',' || count(*) FILTER (b <= 7) AS shape FROM b GROUP BY 1""")
def cluster_cards(spark, d):
    """A10: cards of clusters in the last two days."""
    p = S.posts(spark, d).filter(F.col("created") >= S.as_of() - F.expr("INTERVAL 2 DAYS")).withColumnRenamed("macro", "cluster")
    pick = F.concat_ws(",", *[F.get("shape", F.lit(i)).cast("string") for i in (0, 3, 7)])
    return serving.cluster_cards(p, S.as_of()).withColumn("shape", pick)


@query("""u AS (SELECT sub AS phrase, unnest(list_distinct(['all'] || coalesce(groups, []))) AS scope, member FROM posts LEFT JOIN roster USING (author_id) WHERE sub IS NOT NULL),
a AS (SELECT scope, count(DISTINCT member) AS people FROM (SELECT member, unnest(list_distinct(['all'] || coalesce(groups, []))) AS scope FROM posts LEFT JOIN roster USING (author_id)) GROUP BY 1),
n AS (SELECT phrase, scope, count(DISTINCT member) AS people FROM u GROUP BY 1, 2)
SELECT phrase, count(*) FILTER (n.people >= 3 AND n.people >= 0.5 * a.people) AS unity, count(*) AS groups FROM n JOIN a USING (scope) GROUP BY 1""")
def unity_dots(spark, d):
    """Scopes that took up a sub: three people and half of the active ones."""
    from ..operators import rollup

    p = S.posts(spark, d).join(S.roster(spark, d), "author_id", "left").withColumn("scope", F.explode(rollup.scopes(F.col("groups"))))
    used = p.filter("sub is not null").groupBy(F.col("sub").alias("phrase"), "scope").agg(F.countDistinct("member").alias("people"))
    return serving.unity(used, p.groupBy("scope").agg(F.countDistinct("member").alias("people")), 3, 0.5)


@query("SELECT day, CAST(count(*) AS BIGINT) AS posts, CAST(count(DISTINCT author_id) AS BIGINT) AS users, floor((count(*) * 0.005 + count(DISTINCT author_id) * 0.01) * 10000 + 0.5) / 10000 AS usd, CAST(greatest(0, 340 - count(*)) AS BIGINT) AS remaining FROM posts GROUP BY 1")
def read_ledger(spark, d):
    """Reads, dollars and what is left of a daily budget."""
    usage = S.posts(spark, d).groupBy("day").agg(F.count("*").alias("posts"), F.countDistinct("author_id").alias("users"))
    return serving.read_ledger(usage, F.lit(340))


@query("SELECT day, count(*) FILTER (k % 6 = 0) AS pending, count(*) FILTER (k % 6 = 0) = 0 AS complete FROM posts GROUP BY 1")
def pending_days(spark, d):
    """Pending posts per day."""
    p = S.posts(spark, d)
    return serving.pending_days(p.select("post_id", "day"), p.filter("k % 6 <> 0").select("post_id"))


@query("""SELECT macro AS "group", post_id, created, CAST(row_number() OVER (PARTITION BY macro ORDER BY created DESC, post_id DESC) AS INT) AS rank FROM posts WHERE post_id % 10 = 0 AND type <> 'retweet' QUALIFY rank <= 3""")
def evidence_links(spark, d):
    """The three newest ids of each group that the archive holds."""
    p = S.posts(spark, d)
    return serving.evidence_links(p.filter("post_id % 10 = 0").select(F.col("macro").alias("group"), "post_id"), p.filter("type <> 'retweet'"))


@query("SELECT post_id, author_id FROM posts WHERE post_id % 3 = 0 AND post_id NOT IN (SELECT post_id FROM posts WHERE day > DATE '2024-01-30' - 3 AND post_id % 2 = 0)")
def recent_unseen(spark, d):
    """Rows that the last three days don't hold."""
    p = S.posts(spark, d)
    return learning.recent_unseen(p.filter("post_id % 3 = 0").select("post_id", "author_id"), p.filter("post_id % 2 = 0"), F.lit("2024-01-30").cast("date"))


@query(f"""SELECT ref_id, count(*) AS n FROM posts WHERE type = 'retweet' AND ref_id IS NOT NULL AND epoch({AT}) - epoch(created) < 86400 AND ref_id NOT IN (SELECT post_id FROM posts WHERE k % 2 = 0) AND ref_id NOT IN (SELECT post_id FROM posts WHERE k % 5 = 0) GROUP BY 1 ORDER BY n DESC, ref_id LIMIT 25""")
def repost_requests(spark, d):
    """J12, ST16: originals to ask for."""
    p = S.posts(spark, d)
    return learning.repost_requests(p, p.filter("k % 2 = 0"), p.filter("k % 5 = 0"), S.as_of())


@query("""SELECT post_id, CASE WHEN k % 9 = 0 THEN 'source changed' ELSE 'newer evidence' END AS reason FROM posts WHERE k % 13 <> 0 AND k % 17 <> 0 AND (k % 9 = 0 OR (sub IS NULL AND k % 4 > k % 3 AND k % 2 = 0))""")
def reconsideration_queue(spark, d):
    """Posts to classify again."""
    k = F.col("k")
    p = S.posts(spark, d).select("post_id", F.col("sub").isNull().alias("generic"), (k % 4).alias("news_version"), (k % 3).alias("seen_version"), (k % 2 == 0).alias("distinctive"), F.when(k % 9 == 0, "a").otherwise("b").alias("fingerprint"), F.lit("b").alias("seen_fingerprint"), (k % 13 == 0).alias("corrected"), (k % 17 == 0).alias("pending"))
    return learning.reconsideration(p).select("post_id", "reason")


@query("SELECT post_id, CASE WHEN post_id % 3 = 0 THEN 'nightly' ELSE 'live' END AS kind FROM posts WHERE post_id % 2 = 0 OR post_id % 3 = 0")
def flags_by_precedence(spark, d):
    """Flags of two sources, the nightly one first."""
    p = S.posts(spark, d)
    return learning.flags_by_precedence(p.filter("post_id % 2 = 0").select("post_id", F.lit("live").alias("kind")), p.filter("post_id % 3 = 0").select("post_id", F.lit("nightly").alias("kind")))


@query("""n AS (SELECT post_id // 40 AS chunk, macro AS pair, count(*) AS n FROM posts GROUP BY 1, 2)
SELECT chunk, arg_max(pair, (n, pair)) AS mode, floor(CAST(max(n) AS DOUBLE) / sum(n) * 10000 + 0.5) / 10000 AS share FROM n GROUP BY 1""")
def chunk_modes(spark, d):
    """The commonest macro of each chunk of 40 posts."""
    return learning.chunk_modes(S.posts(spark, d).select((F.col("post_id") + 1).alias("position"), F.col("macro").alias("pair")))


@query("SELECT macro, sub, count(DISTINCT post_id) AS posts FROM topics GROUP BY 1, 2 UNION ALL SELECT macro, '*', count(DISTINCT post_id) FROM topics GROUP BY 1")
def corpus_counts(spark, d):
    """Posts per sub and per macro."""
    return learning.corpus_counts(S.topics(S.posts(spark, d)))


@query("""t AS (SELECT DISTINCT macro, sub FROM posts), m AS (SELECT macro, 'M' || row_number() OVER (ORDER BY macro) AS macro_id FROM (SELECT DISTINCT macro FROM t))
SELECT t.macro, t.sub, macro_id, macro_id || 'S' || row_number() OVER (PARTITION BY t.macro ORDER BY sub NULLS FIRST) AS sub_id FROM t JOIN m USING (macro)""")
def taxonomy_rekey(spark, d):
    """Opaque ids for the taxonomy."""
    return learning.rekey(S.posts(spark, d).select("macro", "sub")).select("macro", "sub", "macro_id", "sub_id")


@query("SELECT post_id, filed, correction_id FROM (SELECT post_id, day AS filed, post_id * 2 AS correction_id FROM posts WHERE post_id % 40 = 0 ORDER BY filed DESC, correction_id DESC LIMIT 10)")
def correction_precedents(spark, d):
    """The latest ten corrections."""
    c = S.posts(spark, d).filter("post_id % 40 = 0").select("post_id", F.col("day").alias("filed"), (F.col("post_id") * 2).alias("correction_id"), F.lit("t").alias("text"))
    return learning.precedents(c).select("post_id", "filed", "correction_id")


@query("""j AS (SELECT post_id AS job_id, unnest(range(1, 2 + CAST(k % 4 AS INT))) AS position FROM posts)
SELECT job_id, CASE max(position) WHEN 1 THEN 'prepared' WHEN 2 THEN 'submitted' WHEN 3 THEN 'unknown' ELSE 'finished' END AS state, max(position) = 1 AS may_submit FROM j GROUP BY 1""")
def job_states(spark, d):
    """ST14, V13: where each job stands."""
    steps = F.array(F.lit("prepared"), F.lit("submitted"), F.lit("unknown"), F.lit("finished"))
    j = S.posts(spark, d).select(F.col("post_id").alias("job_id"), F.posexplode(F.slice(steps, F.lit(1), F.col("k") % 4 + 1)).alias("position", "state"))
    return acquire.job_states(j)


@query("""b AS (SELECT post_id AS request_id, 'submitted' AS state FROM posts WHERE k % 2 = 0), o AS (SELECT post_id, CASE WHEN k % 3 = 0 THEN 'finished' ELSE 'unknown' END FROM posts WHERE k % 5 <> 0), u AS (SELECT post_id, 'failed' FROM posts WHERE k % 7 = 0),
e AS (FROM b UNION ALL FROM o UNION ALL FROM u), r AS (SELECT request_id, max(CASE state WHEN 'submitted' THEN 1 WHEN 'unknown' THEN 2 WHEN 'failed' THEN 3 ELSE 4 END) AS r FROM e GROUP BY 1)
SELECT request_id, CASE r WHEN 1 THEN 'submitted' WHEN 2 THEN 'unknown' WHEN 3 THEN 'failed' ELSE 'finished' END AS state FROM r""")
def journals_merged(spark, d):
    """Three journals as one."""
    p = S.posts(spark, d).withColumnRenamed("post_id", "request_id")
    one = lambda f, s: p.filter(f).select("request_id", s.alias("state"), F.lit(None).cast("string").alias("value"))
    return acquire.merge_journals(one("k % 2 = 0", F.lit("submitted")), one("k % 5 <> 0", F.when(F.col("k") % 3 == 0, "finished").otherwise("unknown")), one("k % 7 = 0", F.lit("failed"))).select("request_id", "state")


@query("""f AS (SELECT ref_id AS post_id, 't' || (k % 2) AS text FROM posts WHERE ref_id IS NOT NULL AND k % 3 <> 0), n AS (SELECT post_id, count(DISTINCT text) AS b, min(text) AS text FROM f GROUP BY 1),
e AS (SELECT ref_id AS post_id, bool_and(k % 4 <> 1) AS terminal FROM posts WHERE ref_id IS NOT NULL AND k % 3 = 0 GROUP BY 1), w AS (SELECT DISTINCT ref_id AS post_id FROM posts WHERE ref_id IS NOT NULL)
SELECT w.post_id, CASE WHEN b = 1 THEN 'resolved' WHEN b > 1 THEN 'conflicting' WHEN coalesce(terminal, FALSE) THEN 'unavailable' ELSE 'unresolved' END AS state, CASE WHEN b = 1 THEN text END AS text FROM w LEFT JOIN n ON n.post_id = w.post_id LEFT JOIN e ON e.post_id = w.post_id""")
def lookup_responses(spark, d):
    """State of each id that was asked for."""
    p = S.posts(spark, d).filter("ref_id is not null")
    ref = F.col("ref_id").alias("post_id")
    return state.lookup_response(p.select(ref).distinct(), p.filter("k % 3 <> 0").select(ref, F.concat(F.lit("t"), (F.col("k") % 2).cast("string")).alias("text")), p.filter("k % 3 = 0").select(ref, (F.col("k") % 4 != 1).alias("terminal")))


@query("""r AS (SELECT p.post_id, p.ref_id, o.post_id AS oid, o.k AS ok FROM posts p LEFT JOIN posts o ON o.post_id = p.ref_id AND o.k % 2 = 0 WHERE p.type = 'retweet')
SELECT post_id, CASE WHEN ref_id IS NULL THEN 'repost-reference-invalid' WHEN oid IS NULL THEN 'repost-original-unavailable' WHEN ok % 3 = 0 THEN 'repost-original-mismatch' WHEN ok % 5 = 0 THEN 'repost-original-empty' ELSE 'complete' END AS state FROM r""")
def source_completeness(spark, d):
    """What is wrong with the sources of reposts."""
    p = S.posts(spark, d)
    o = p.filter("k % 2 = 0").select("post_id", F.when(F.col("k") % 5 == 0, " ").otherwise("t").alias("text"), F.when(F.col("k") % 3 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("post_id")).alias("claimed_id"))
    return state.source_status(p, o).select("post_id", "state")


@query("""c AS (SELECT post_id AS custom_id FROM posts), r AS (SELECT post_id AS custom_id FROM posts WHERE k % 4 <> 0 UNION ALL SELECT post_id FROM posts WHERE k % 7 = 0 UNION ALL SELECT -1)
SELECT c.custom_id, CASE count(r.custom_id) WHEN 0 THEN 'missing' WHEN 1 THEN 'done' ELSE 'duplicate' END AS state FROM c LEFT JOIN r ON r.custom_id = c.custom_id GROUP BY 1""")
def collected_results(spark, d):
    """Chunks by their replies; a reply to no chunk is passed over."""
    p = S.posts(spark, d).withColumnRenamed("post_id", "custom_id")
    body = F.lit("b").alias("body")
    r = p.filter("k % 4 <> 0").select("custom_id", body).union(p.filter("k % 7 = 0").select("custom_id", body)).union(spark.createDataFrame([(-1, "b")], "custom_id bigint, body string"))
    return state.collect_results(r, p.select("custom_id")).select("custom_id", "state")


@query("""SELECT floor(avg(CASE WHEN author_id < 50 THEN CAST(sub IS NULL AS INT) END) * 10000 + 0.5) / 10000 AS inside, floor(avg(CASE WHEN author_id >= 50 THEN CAST(sub IS NULL AS INT) END) * 10000 + 0.5) / 10000 AS outside FROM posts""")
def arm_effect(spark, d):
    """How often posts have no sub inside and outside an arm."""
    return evaluation.arm_effect(S.posts(spark, d).select((F.col("author_id") < 50).alias("arm"), F.col("sub").isNull().alias("empty"))).select("inside", "outside")


@query("""s AS (SELECT k AS source, post_id, author_id, member, ref_id FROM posts), c AS (SELECT source, ref_id FROM s WHERE ref_id IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT post_id) > 1)
SELECT source AS incident, count(*) AS statements, count(DISTINCT CASE WHEN member % 4 <> 0 THEN member END) AS people, count(DISTINCT author_id) AS accounts, count(DISTINCT CASE WHEN member % 4 = 0 THEN author_id END) AS unresolved,
  (SELECT count(*) FROM c WHERE c.source = s.source) AS repeated_references FROM s GROUP BY 1""")
def corroboration_counts(spark, d):
    """Statements, people and repeated references per incident."""
    p = S.posts(spark, d).select(F.col("k").alias("incident"), "author_id", F.when(F.col("member") % 4 != 0, F.col("member")).alias("person_id"), F.col("post_id").alias("source_id"), F.when(F.col("ref_id").isNotNull(), F.array("ref_id")).otherwise(F.array().cast("array<bigint>")).alias("reference_ids"))
    return incidents.corroboration(p).select("incident", "statements", "people", "accounts", "unresolved", "repeated_references")


@query(f"""SELECT macro AS event, count(DISTINCT post_id) AS posts, count(DISTINCT author_id) AS accounts, count(DISTINCT member) AS people, count(DISTINCT CASE WHEN y THEN post_id END) AS posts24, count(DISTINCT CASE WHEN y THEN member END) AS people24
FROM (SELECT *, epoch({AT}) - epoch(created) < 86400 AS y FROM posts) GROUP BY 1""")
def event_counts(spark, d):
    """Posts, accounts and people of events, in all and in a day."""
    return state.event_counts(S.posts(spark, d).withColumnRenamed("macro", "event"), S.as_of()).select("event", "posts", "accounts", "people", "posts24", "people24")


@query("""r AS (SELECT k AS stage, post_id AS attempt, created AS observed, k % 3 AS severity, engagement % 5 <> 0 AS ok FROM posts)
SELECT stage, arg_max(ok, (attempt, observed, severity)) AS ok, max(observed) FILTER (ok) AS last_success, max(observed) FILTER (NOT ok) AS last_failure, count(*) AS attempts,
  CASE WHEN arg_max(ok, (attempt, observed, severity)) THEN 'healthy' WHEN max(observed) FILTER (ok) IS NULL THEN 'failing' ELSE 'degraded' END AS status FROM r GROUP BY 1""")
def inference_health(spark, d):
    """The latest receipt and the state of each stage."""
    k = F.col("k")
    return evaluation.inference_health(S.posts(spark, d).select(k.alias("stage"), F.col("post_id").alias("attempt"), F.col("created").alias("observed"), (k % 3).alias("severity"), (F.col("engagement") % 5 != 0).alias("ok")))


@query("""x AS (SELECT list_extract(['invalid api key', 'rate limit', 'connection timed out', 'credit is low', 'odd'], 1 + CAST(k % 5 AS INT)) AS m, CASE WHEN k % 11 = 0 THEN 429 WHEN k % 13 = 0 THEN 503 ELSE 400 END AS s FROM posts)
SELECT CASE WHEN m = 'invalid api key' THEN 'auth' WHEN m = 'credit is low' THEN 'budget' WHEN s = 429 OR m = 'rate limit' THEN 'rate-limit' WHEN s >= 500 OR m = 'connection timed out' THEN 'unavailable' ELSE 'invalid-response' END AS code, count(*) AS n FROM x GROUP BY 1""")
def failure_codes(spark, d):
    """Failures by reason."""
    k = F.col("k")
    m = F.element_at(F.array(*map(F.lit, ["invalid api key", "rate limit", "connection timed out", "credit is low", "odd"])), k % 5 + 1)
    s = F.when(k % 11 == 0, 429).when(k % 13 == 0, 503).otherwise(400)
    return S.posts(spark, d).select(evaluation.failure_code(m, s).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query("SELECT substring(sha1('http://x/' || post_id), 1, 16) AS item_id, post_id FROM posts WHERE type = 'quote'")
def item_ids(spark, d):
    """ids of items from their links."""
    return S.posts(spark, d).filter("type = 'quote'").select(X.item_id(F.concat(F.lit("http://x/"), F.col("post_id").cast("string"))).alias("item_id"), "post_id")


@query("""SELECT post_id, CAST(make_timestamp_ms((post_id * 4194304000000 >> 22) + 1288834974657) AS TIMESTAMP) AS made FROM posts WHERE post_id < 2000""")
def snowflake_times(spark, d):
    """times that ids were made at."""
    return S.posts(spark, d).filter("post_id < 2000").select("post_id", X.snowflake_time(F.col("post_id") * 4194304000000).cast("timestamp_ntz").alias("made"))


@query("""SELECT CASE WHEN v >= 1000000 THEN regexp_replace(printf('%.2f', floor(v / 1e6 * 100 + 0.5) / 100), '\\.?0+$', '') || 'M' WHEN v >= 10000 THEN regexp_replace(printf('%.1f', floor(v / 1e3 * 10 + 0.5) / 10), '\\.?0+$', '') || 'K' ELSE CAST(v AS VARCHAR) END AS shown, count(*) AS n FROM (SELECT engagement * (1 + k) AS v FROM posts) GROUP BY 1""")
def short_numbers(spark, d):
    """F32: numbers as they are shown."""
    return S.posts(spark, d).select(X.short_number(F.col("engagement") * (1 + F.col("k"))).alias("shown")).groupBy("shown").agg(F.count("*").alias("n"))


@query("""SELECT turn, floor(avg(length(c)) * 100 + 0.5) / 100 AS mean, max(length(c)) AS longest FROM (SELECT turn, CASE WHEN length(f) <= 200 THEN f ELSE regexp_replace(substring(f, 1, 199), '\\s+\\S*$', '') || '…' END AS c FROM (SELECT turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS f FROM conversations)) GROUP BY 1""")
def compact_quotes(spark, d):
    """Turns cut between words at 200 code points."""
    c = table(spark, d, "conversations").select("turn", F.length(serving.quote(F.col("text"))).cast("bigint").alias("n"))
    return c.groupBy("turn").agg(M.places(F.avg("n"), 2).alias("mean"), F.max("n").alias("longest"))


@query(f"SELECT in7, in7x, count(*) AS n FROM (SELECT d BETWEEN 0 AND 6 AS in7, d BETWEEN 1 AND 7 AS in7x FROM (SELECT date_diff('day', CAST(created - INTERVAL 5 HOUR AS DATE), CAST({AT} - INTERVAL 5 HOUR AS DATE)) AS d FROM posts)) GROUP BY 1, 2")
def trailing_windows(spark, d):
    """P10: posts of the last seven days, with and without today."""
    c = F.col("created")
    return S.posts(spark, d).select(T.in_window(c, S.as_of(), 7).alias("in7"), T.in_window(c, S.as_of(), 7, today=False).alias("in7x")).groupBy("in7", "in7x").agg(F.count("*").alias("n"))
