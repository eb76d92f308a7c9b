"""Queries on texts, pages, vectors and conversations; each with its DuckDB form where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import mathfn as M
from ..functions import text as X
from ..functions import timefn as T
from ..operators import evaluation, evidence, incidents, phrases, stories, vectors
from ..sources import readers
from ..operators.graph import cut
from ..sources.readers import spread, table
from ..streaming import stream
from . import staging as S
from .social import AT

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
_STOP = "[" + ", ".join(f"'{w}'" for w in fixed.PHRASE_STOP) + "]"

TOKENS = r"""tok AS (
  SELECT doc_id, source, lang, list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    lower(text), 'https?://\S+', ' ', 'g'), '@[a-z0-9_]+', ' ', 'g'), '#', '', 'g'), '[‘’`]', '''', 'g'),
    '(^|[^a-z0-9_])(wo|ca|sha)n''t($|[^a-z0-9_])', '\1\2n NOT\3', 'g'), 'n''t($|[^a-z0-9_])', ' not\1', 'g'), '''(s|ll|re|ve|d|m)($|[^a-z0-9_])', '\2', 'g'), '''', '', 'g'),
    '(^|[^a-z0-9_])([a-z])\.([a-z])\.?', '\1\2\3', 'g'), 'x{0}[^a-zA-Z0-9\s-]', ' ', 'g'), 'NOT', 'not', 'g'), '\s+', ' ', 'g')), ' '), lambda w: w <> '') AS tokens
  FROM documents
)"""

GRAMS = f"""gram AS (
  SELECT DISTINCT doc_id, source, lang, array_to_string(list_slice(tokens, i, i + n - 1), ' ') AS phrase
  FROM (SELECT doc_id, source, lang, tokens, n, unnest(range(1, len(tokens) - n + 2)) AS i FROM tok, (SELECT unnest([2, 3, 4]) AS n) WHERE len(tokens) >= n)
  WHERE NOT list_contains({_STOP}, tokens[i]) AND NOT list_contains({_STOP}, tokens[i + n - 1])
    AND len(list_filter(list_slice(tokens, i, i + n - 1), lambda w: NOT list_contains({_STOP}, w) AND NOT regexp_full_match(w, '[0-9]+'))) > 0
)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(f"WITH {TOKENS} SELECT doc_id, CAST(len(tokens) AS INT) AS n, md5(array_to_string(tokens, ' ')) AS digest FROM tok")
def tokenize_docs(spark, d):
    """tokens of every document."""
    t = spread(table(spark, d, "documents")).select("doc_id", X.tokenize(F.col("text")).alias("tokens"))
    return t.select("doc_id", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


def _posts(spark, d):
    docs = spread(table(spark, d, "documents"))
    return docs.select(F.col("doc_id").alias("post_id"), F.col("source").alias("author_id"), F.col("doc_id").alias("created"), F.col("lang").alias("day"), F.lit("tweet").alias("type"), "text")


_MINED = f"{TOKENS}, {GRAMS}, mined AS (SELECT lang AS day, phrase, count(DISTINCT source) AS members, count(DISTINCT doc_id) AS posts, min(doc_id) AS first_seen, arg_min(source, doc_id) AS first_author FROM gram GROUP BY 1, 2 HAVING count(DISTINCT source) >= 3)"


@query(f"WITH {_MINED} SELECT * FROM mined")
def phrase_mining(spark, d):
    """Phrases of three or more sources per language."""
    return phrases.mine_posts(_posts(spark, d))


@query(f"""WITH {_MINED}, top AS (SELECT * FROM mined WHERE members >= 12) SELECT a.day, a.phrase, a.members, a.posts FROM top a
WHERE NOT EXISTS (SELECT 1 FROM top b WHERE b.day = a.day AND length(b.phrase) > length(a.phrase) AND contains(b.phrase, a.phrase) AND b.members >= a.members)""")
def containment_prune(spark, d):
    """Phrases that no longer one with as many sources contains."""
    return phrases.prune_contained(phrases.widespread_posts(_posts(spark, d), 12)).select("day", "phrase", "members", "posts")


@query(f"WITH {TOKENS}, {GRAMS}, top AS (SELECT phrase FROM gram GROUP BY 1 HAVING count(DISTINCT source) >= 10) SELECT phrase, source AS author_id, min(doc_id) AS day FROM gram WHERE phrase IN (SELECT phrase FROM top) GROUP BY 1, 2")
def phrase_first_use(spark, d):
    """The first document of each source for each widespread phrase."""
    return phrases.widespread_first_posts(_posts(spark, d).withColumn("day", F.col("created")), 10)


@query(f"""WITH {TOKENS}, {GRAMS}, top AS (SELECT phrase FROM gram GROUP BY 1 HAVING count(DISTINCT source) >= 10), f AS (SELECT phrase, source, min(doc_id) AS first FROM gram WHERE phrase IN (SELECT phrase FROM top) GROUP BY 1, 2),
b AS (SELECT phrase, source, CAST(least(greatest(0, 6 - date_diff('day', DATE '2024-01-01' + CAST(first % 10 AS INT), DATE '2024-01-08')), 6) AS INT) AS bucket FROM f),
g AS (SELECT phrase, bucket FROM (SELECT DISTINCT phrase FROM b), (SELECT CAST(unnest(range(7)) AS INT) AS bucket))
SELECT g.phrase, g.bucket, CAST(sum(n) OVER (PARTITION BY g.phrase ORDER BY g.bucket) AS BIGINT) AS people FROM (SELECT g.phrase, g.bucket, count(b.source) AS n FROM g LEFT JOIN b ON b.phrase = g.phrase AND b.bucket = g.bucket GROUP BY 1, 2) g""")
def adoption_curve(spark, d):
    """Sources that have used a phrase by each of seven days."""
    posts = _posts(spark, d).withColumn("day", F.col("created"))
    first = phrases.widespread_first_posts(posts, 10).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("day") % 10).cast("int")))
    return phrases.adoption(first, F.lit("2024-01-08").cast("date"))


@query()
def phrase_families(spark, d):
    """The 30 most widespread phrases in families, with the main variant of each."""
    posts = _posts(spark, d)
    top = phrases.widespread_posts(posts, 3, ()).orderBy(F.desc("members"), F.desc("posts"), "phrase").limit(30).select("phrase")
    return phrases.family_rows(phrases.uses_of(posts, top), phrases.families(top))


@query("""WITH v AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i, vec_id FROM embeddings), n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM v GROUP BY 1),
m AS (SELECT label, i, avg(x / n.n) AS x FROM v JOIN n USING (vec_id) GROUP BY 1, 2), l AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1)
SELECT m.label, CAST(i AS INT) AS i, floor(x / l.n * 1e6 + 0.5) / 1e6 AS x FROM m JOIN l ON l.label = m.label""")
def centroids(spark, d):
    """The centroid of each label, of unit length."""
    c = vectors.centroids(spread(table(spark, d, "embeddings")), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("i", "x")).withColumn("x", M.places(F.col("x"), 6))


def _stories(spark, d):
    e = spread(table(spark, d, "embeddings"))
    return e, vectors.centroids(e, "label", "embedding").withColumnRenamed("label", "story")


_CENTROID = """v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM v GROUP BY 1), u AS (SELECT vec_id, label, i, x / n.n AS x FROM v JOIN n USING (vec_id)),
m AS (SELECT label AS story, i, avg(x) AS x FROM u GROUP BY 1, 2), l AS (SELECT story, sqrt(sum(x * x)) AS n FROM m GROUP BY 1), c AS (SELECT m.story, i, x / l.n AS x FROM m JOIN l USING (story)),
s AS (SELECT u.vec_id, any_value(u.label) AS label, c.story, floor(sum(u.x * c.x) * 10000 + 0.5) / 10000 AS sim FROM u JOIN c USING (i) GROUP BY 1, 3)"""


@query(f"WITH {_CENTROID} SELECT vec_id, story AS label, sim FROM s WHERE sim >= 0.2 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, story) <= 3")
def nearest_story(spark, d):
    """Up to three stories of each vector, at least 0.2 alike."""
    e, c = _stories(spark, d)
    return vectors.nearest(e, c.withColumnRenamed("story", "label"), "vec_id", "embedding", "label", "centroid", 3, 0.2).select("vec_id", "label", "sim")


@query(f"WITH {_CENTROID} SELECT story, vec_id, sim, CAST(row_number() OVER (PARTITION BY story ORDER BY sim DESC, vec_id) AS INT) AS rank FROM s WHERE label <> story AND sim >= 0.0 QUALIFY rank <= 20")
def knn_excluding_story(spark, d):
    """The 20 nearest vectors of each story that aren't its own."""
    e, c = _stories(spark, d)
    return vectors.neighbours(e, c, e.select(F.col("label").alias("story"), "vec_id"), 20)


@query(f"""WITH {_CENTROID}, r AS (SELECT story, label, row_number() OVER (PARTITION BY story ORDER BY sim DESC, vec_id) AS rank FROM s WHERE sim >= -1)
SELECT story, floor(avg(CASE WHEN rank <= 10 THEN CAST(label = story AS INT) END) * 10000 + 0.5) / 10000 AS p_at_10, floor(avg(CASE WHEN rank <= 20 THEN CAST(label = story AS INT) END) * 10000 + 0.5) / 10000 AS p_at_20,
  floor(avg(CASE WHEN rank <= 40 THEN CAST(label = story AS INT) END) * 10000 + 0.5) / 10000 AS p_at_40 FROM r GROUP BY 1""")
def precision_at_k(spark, d):
    """How many of the vectors nearest to a story are its own."""
    e, c = _stories(spark, d)
    top = vectors.neighbours(e, c, None, 40, -1.0).join(e.select("vec_id", "label"), "vec_id")
    return vectors.precision_at(top, ["story"], F.col("label") == F.col("story"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), s AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) / 127 AS scale FROM e),
q AS (SELECT vec_id, v, scale, list_transform(v, lambda x: greatest(-127, least(127, floor(x / scale + 0.5)))) AS q FROM s)
SELECT vec_id, CAST(list_sum(list_transform(q, lambda x: abs(x))) AS BIGINT) AS weight, floor(list_cosine_similarity(v, q) * 10000 + 0.5) / 10000 AS similarity FROM q""")
def quantize_roundtrip(spark, d):
    """vectors in eight bits, and how much of them that keeps."""
    q = spread(table(spark, d, "embeddings")).select("vec_id", "embedding", M.quantise(F.col("embedding")).alias("q"))
    back = M.cosine(F.col("embedding"), M.dequantise(F.col("q")))
    return q.select("vec_id", F.aggregate("q.q", F.lit(0).cast("bigint"), lambda a, x: a + F.abs(x.cast("bigint"))).alias("weight"), M.places(back, 4).alias("similarity"))


@query()
def vector_clusters(spark, d):
    """The cluster of every vector; clusters are fitted on a sample of 200 per label, by hash."""
    every = spread(table(spark, d, "embeddings"))
    sample = evaluation.hash_sample(every, "vec_id", 200, ["label"])
    return vectors.assign_clusters(every, vectors.cluster_pools(sample, "label", 0.6), "label")


@query()
def html_text(spark, d):
    """text of every page."""
    return spread(table(spark, d, "pages")).select("page_id", F.md5(X.strip_html(F.col("html"))).alias("digest"))


@query()
def page_passages(spark, d):
    """Title, language, link and passages of every page."""
    a = readers.extract_articles(spread(table(spark, d, "pages")))
    return a.select("page_id", "canonical", "lang", "title", "extract", F.size("passages").alias("n_passages"), F.array_join("passages", "\n").alias("passages"))


@query(r"""SELECT page_id, regexp_extract(html, '(?i)<html\b[^>]*\blang=["'']([a-zA-Z-]+)["'']', 1) AS lang, split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1) AS host, url LIKE 'https://%' AS secure FROM pages""")
def page_hosts(spark, d):
    """Host, language and scheme of pages."""
    p = table(spark, d, "pages")
    return p.select("page_id", F.regexp_extract("html", r"(?i)<html\b[^>]*\blang=[\"']([a-zA-Z-]+)[\"']", 1).alias("lang"), F.try_parse_url("url", F.lit("HOST")).alias("host"), F.col("url").startswith("https://").alias("secure"))


_KIND_CASE = "CASE " + " ".join(f"WHEN regexp_matches(kind, '{p}') THEN '{k}'" for p, k in fixed.KINDS) + " ELSE kind END"
_KINDS_IN = ["brush fire", "gas leak", "boil water notice", "Severe Weather", "train derailment", "House fire", "shots fired", "quake", "power outage", "dam failure", "gunman", "heat wave", "parade"]


@query(f"WITH k AS (SELECT event_id, trim(lower(list_extract({_KINDS_IN!r}, 1 + CAST(event_id % {len(_KINDS_IN)} AS INT)))) AS kind FROM events) SELECT {_KIND_CASE} AS canonical, count(*) AS n FROM k GROUP BY 1")
def kind_canonical(spark, d):
    """incident kinds in one vocabulary."""
    kind = F.element_at(F.array(*map(F.lit, _KINDS_IN)), (F.col("event_id") % len(_KINDS_IN)).cast("int") + 1)
    return table(spark, d, "events").select(incidents.canonical_kind(kind).alias("canonical")).groupBy("canonical").agg(F.count("*").alias("n"))


_CUES_IN = ["Today we remember the victims", "Evacuate now, call (555) 010-2000", "Apply by Friday", "Hurricane season starts", "Praying for all", "Fire at Main Street", "What if a storm hits", "Roads closed near the bridge", "The storm is gone"]


@query(f"SELECT list_extract(['commemoration', NULL, 'dated past', 'seasonal or preparedness', 'reaction only', NULL, 'hypothetical', NULL, 'aftermath'], 1 + CAST(event_id % {len(_CUES_IN)} AS INT)) AS reason, count(*) AS n FROM events GROUP BY 1")
def cue_filter(spark, d):
    """Why a text opens no incident."""
    text = F.element_at(F.array(*map(F.lit, _CUES_IN)), (F.col("event_id") % len(_CUES_IN)).cast("int") + 1)
    return table(spark, d, "events").select(incidents.cue_reason(text)["reason"].alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(r"""WITH t AS (SELECT event_id, 'See H.R. ' || (event_id % 40) || ' and S. ' || (event_id % 7) || ', not HRX 5; H. J. Res. 12' AS text FROM events), b AS (SELECT event_id, unnest(['hr-' || (event_id % 40), 's-' || (event_id % 7), 'hjres-12']) AS bill FROM t)
SELECT bill, count(DISTINCT event_id) AS posts FROM b GROUP BY 1""")
def bill_refs(spark, d):
    """Posts per bill that they name."""
    text = F.concat(F.lit("See H.R. "), (F.col("event_id") % 40).cast("string"), F.lit(" and S. "), (F.col("event_id") % 7).cast("string"), F.lit(", not HRX 5; H. J. Res. 12"))
    return table(spark, d, "events").select("event_id", F.explode(readers.bill_refs(text)).alias("bill")).groupBy("bill").agg(F.countDistinct("event_id").alias("posts"))


@query("""WITH RECURSIVE b AS (SELECT event_id, CAST(event_id AS VARCHAR) AS s FROM events), h(event_id, i, h) AS (SELECT event_id, 0, 2166136261::UBIGINT FROM b UNION ALL
SELECT h.event_id, i + 1, ((xor(h.h, ascii(s[i + 1])::UBIGINT)) * 16777619::UBIGINT) % 4294967296::UBIGINT FROM h JOIN b USING (event_id) WHERE i < length(s))
SELECT event_id, CAST(h.h AS BIGINT) AS hash FROM h JOIN b USING (event_id) WHERE i = length(s) ORDER BY hash, event_id LIMIT 50""")
def fnv_order_sample(spark, d):
    """The 50 events of least FNV-1a hash."""
    return evaluation.hash_sample(table(spark, d, "events").select("event_id"), "event_id", 50).select("event_id", "hash")


@query("""WITH s AS (SELECT event_id, event_type, sha256(event_id || '|s1') AS hash FROM events) SELECT event_id, event_type, hash, CAST(row_number() OVER (PARTITION BY event_type ORDER BY hash, event_id) AS INT) AS rank FROM s QUALIFY rank <= length(event_type) * 3""")
def sha_sample(spark, d):
    """A salted sample, its size by group."""
    return evaluation.sha_sample(table(spark, d, "events").select("event_id", "event_type"), "event_id", "s1", F.length("event_type") * 3, ["event_type"])


@query("""WITH x AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM conversations), y AS (SELECT conv_id, turn, list_distinct(w) AS w FROM x)
SELECT a.conv_id, a.turn, floor(CASE WHEN len(list_distinct(a.w || b.w)) = 0 THEN 1.0 ELSE len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)) END * 10000 + 0.5) / 10000 AS jaccard FROM y a JOIN y b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1""")
def jaccard_agreement(spark, d):
    """How many words each turn shares with the one before."""
    x = table(spark, d, "conversations").select("conv_id", "turn", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("w"))
    b = x.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("w").alias("v"))
    return x.join(b, ["conv_id", "turn"]).select("conv_id", "turn", M.places(evaluation.jaccard(F.col("w"), F.col("v")), 4).alias("jaccard"))


@query("""WITH i AS (SELECT page_id % 12 AS source_id, CASE WHEN length(html) > 3000 THEN 'body' WHEN page_id % 5 = 0 THEN 'failed' ELSE 'headline-only' END AS extract, page_id AS published FROM pages WHERE page_id % 12 <> 7)
SELECT s.range AS source_id, count(i.extract) AS eligible, count(*) FILTER (extract = 'body') AS with_excerpts, count(*) FILTER (extract = 'headline-only') AS headline_only, count(*) FILTER (extract = 'failed') AS unreadable, max(published) AS latest FROM range(12) s LEFT JOIN i ON i.source_id = s.range GROUP BY 1""")
def news_coverage(spark, d):
    """Items per source, with and without a readable body."""
    p = table(spark, d, "pages").filter("page_id % 12 <> 7")
    kind = F.when(F.length("html") > 3000, "body").when(F.col("page_id") % 5 == 0, "failed").otherwise("headline-only")
    return evaluation.news_coverage(spark.range(12).withColumnRenamed("id", "source_id"), p.select((F.col("page_id") % 12).alias("source_id"), kind.alias("extract"), F.col("page_id").alias("published")))


def _evidence_tables(spark, d):
    """Benchmark passages as posts, and pages as articles; both dated by their ids within a month."""
    stamp = lambda c: F.timestamp_seconds(F.lit(1704067200) + (F.col(c) * 7919 % 2_592_000))
    posts = table(spark, d, "benchmark").select(F.col("item_id").alias("post_id"), stamp("item_id").alias("created"), "text")
    pages = readers.extract_articles(spread(table(spark, d, "pages")))
    news = pages.select(F.col("page_id").alias("news_id"), stamp("page_id").alias("published"), stamp("page_id").alias("fetched"), "title", F.lit("").alias("summary"), "passages", "extract")
    return posts, cut(news)  # stored once read, as a news store is


@query()
def evidence_range_join(spark, d):
    """Dated articles for posts, up to three each."""
    posts, news = _evidence_tables(spark, d)
    out = evidence.retrieve(posts, news, F.lit("2024-02-28").cast("timestamp"))
    return out.select("post_id", "news_id", "score", "kind", "rank")


@query()
def asof_evidence(spark, d):
    """The same with what was known at the time of the post only."""
    posts, news = _evidence_tables(spark, d)
    return evidence.retrieve(posts, news).select("post_id", "news_id", "score", "kind", "rank")


@query()
def label_cluster_merge(spark, d):
    """Page titles of similar words as one label."""
    titles = readers.extract_articles(spread(table(spark, d, "pages"))).filter("title <> ''").select(F.col("title").alias("label"), (F.col("page_id") % 5).alias("day"), F.array("page_id").alias("ids"))
    out = stories.label_clusters(cut(titles))
    return out.select("label", F.size("labels").alias("n_labels"), F.size("ids").alias("n_ids"), F.size("days").alias("n_days"))


@query(f"WITH RECURSIVE {S.SQL.strip()} SELECT day, macro, count(*) AS posts FROM posts GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    """ST06: a stream over the events' file, counted by day and macro; complete mode, so it equals the batch."""
    src = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    k = F.get_json_object("props", "$.k").cast("int")
    p = src.select(F.col("ts").cast("timestamp").alias("created"), F.concat(F.lit("m"), F.floor(k / 10).cast("string")).alias("macro"))
    import uuid

    return stream.run_to_end(stream.daily(p, ["macro"]), f"s{uuid.uuid4().hex}", "complete")


@query("SELECT event_id AS id, user_id FROM events")
def stream_dedupe(spark, d):
    """ST03: the events streamed twice, each kept once."""
    src = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    p = src.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("created"), "user_id")
    import uuid

    return stream.run_to_end(stream.dedupe(p.union(p)), f"s{uuid.uuid4().hex}").select("id", "user_id")


@query(f"WITH {S.SQL}, h AS (SELECT post_id, floor((epoch({AT}) - epoch(created)) / 3600) AS age FROM posts) SELECT CASE WHEN age < 12 THEN 'active' WHEN age < 36 THEN 'monitoring' ELSE 'resolved' END AS phase, count(*) AS n FROM h GROUP BY 1")
def lifecycle_ladder(spark, d):
    """phase of each post by its age; whole hours."""
    p = S.posts(spark, d)
    hour = F.floor(T.age_seconds(F.col("created"), S.as_of()) / 3600)
    return p.withColumn("phase", F.when(hour < 12, "active").when(hour < 36, "monitoring").otherwise("resolved")).groupBy("phase").agg(F.count("*").alias("n"))
