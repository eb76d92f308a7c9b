"""Readers: strict and lenient JSON lines, day partitions, rosters, feeds, pages, agendas, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import timefn as T
from ..operators.windows import first_row, ranked
from . import schemas

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all cores if it has fewer files than there are cores: one file can't keep more than a few busy.

    For work that costs much more than its rows' transport; tables of many files are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines; a malformed line is an error, or dropped if not strict; a missing file is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def json_document(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """One JSON document; absent: no row; corrupt: an error if strict, else no row."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The spend ledger; a line that doesn't fit the schema, or a negative count, is an error."""
    rows = jsonl(spark, path, schemas.LEDGER)
    bad = F.least("calls", "input", "output", "cache_read", "cache_write") < 0
    return rows.withColumn("calls", F.when(bad, F.raise_error(F.lit("negative count in the ledger")).cast("bigint")).otherwise(F.col("calls")))


def capture_state(spark: SparkSession, path: str, archive_path: str) -> DataFrame:
    """The capture state; it may be missing only while there is no archive, lest the cursor starts over."""
    if not exists(spark, path) and exists(spark, archive_path):
        raise ValueError("an archive without its capture state: restore the state first")
    return json_document(spark, path, "sinceId string, sinceIdSupported boolean, recentNewCounts array<bigint>, usage map<string,struct<posts:bigint,users:bigint>>")


def quoted_store(spark: SparkSession, path: str) -> DataFrame:
    """Originals that other posts quote, by id."""
    return jsonl(spark, path, "post_id string, text string, createdAt string").dropDuplicates(["post_id"])


def archive(spark: SparkSession, path: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Posts of a day-partitioned archive, each id once (oldest partition, then first captured).

    days limits the partitions that are read.
    """
    posts = spark.read.schema(schemas.POST + ", et_date date").json(path)
    if days:
        posts = posts.filter(F.col("et_date").between(*days))
    return first_row(posts, "id", ["et_date", "capturedAt"])


def post_columns(posts: DataFrame) -> DataFrame:
    """Typed columns of archive posts."""
    m = F.col("metricsAtCapture")
    total = F.coalesce(m["likes"], F.lit(0)) + F.coalesce(m["retweets"], F.lit(0)) + F.coalesce(m["replies"], F.lit(0)) + F.coalesce(m["quotes"], F.lit(0))
    created = F.to_timestamp("createdAt")
    return posts.select(F.col("id").alias("post_id"), F.col("authorId").alias("author_id"), created.alias("created"), F.to_timestamp("capturedAt").alias("captured"), "type", F.col("refId").alias("ref_id"), "lang", "text", total.alias("engagement"), T.et_date(created).alias("day"), F.coalesce("quoted.text", "reposted.text").alias("embedded"))


def api_records(pages: DataFrame) -> DataFrame:
    """Records of API pages (id, author_id, created_at, text, note_text, refs, public_metrics).

    refs: array of (type, id).  The type is retweet before quote before reply; ref_id is the first reference of it.
    """
    kind = lambda k: F.get(F.transform(F.filter("refs", lambda r: r["type"] == k), lambda r: r["id"]), F.lit(0))
    rt, qt, rp = kind("retweeted"), kind("quoted"), kind("replied_to")
    blank = lambda c: F.when(F.trim(c) != "", c)
    count = lambda c: F.coalesce(F.col(f"public_metrics.{c}"), F.lit(0).cast("bigint"))
    return pages.select(
        "id", "author_id", "created_at", F.when(rt.isNotNull(), "retweet").when(qt.isNotNull(), "quote").when(rp.isNotNull(), "reply").otherwise("tweet").alias("type"),
        F.coalesce(rt, qt, rp).alias("ref_id"), F.coalesce(blank(F.col("note_text")), F.col("text")).alias("text"),
        F.struct(count("like_count").alias("likes"), count("retweet_count").alias("retweets"), count("reply_count").alias("replies"), count("quote_count").alias("quotes")).alias("metrics"),
    )


def safe_links(urls: Column) -> Column:
    """http(s) links without user info or control characters, each once."""
    return F.array_distinct(F.filter(urls, lambda u: u.rlike("^https?://[^/@\\s]+(/|$|\\?|#)") & ~u.rlike("[\\x00-\\x20\\x7f]")))


def allowed_host(url: Column, hosts: Column) -> Column:
    """Whether a link's host is one of the hosts or below one."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce(url.rlike("^https?://") & F.exists(hosts, lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h))), F.lit(False))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with quotes, doubled quotes and line breaks inside; rows without any value go."""
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    return rows.filter(F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in rows.columns]).isNotNull())


def roster(rows: DataFrame) -> DataFrame:
    """Roster rows typed; a status that is unknown is an error."""
    status = F.coalesce(F.nullif(F.trim("status"), F.lit("")), F.lit("house"))
    handle = F.regexp_replace(F.trim("handle"), "^@", "")
    typed = rows.filter(F.coalesce(handle, F.lit("")) != "").select(handle.alias("handle"), "member", F.col("account_type"), F.filter(F.split(F.coalesce("caucuses", F.lit("")), r"\|"), lambda c: F.trim(c) != "").alias("caucuses"), "state_district", status.alias("status"))
    bad = F.raise_error(F.concat(F.lit("unknown status: "), F.col("status"))).cast("string")
    return typed.withColumn("status", F.when(F.col("status").isin(*schemas.STATUSES), F.col("status")).otherwise(bad))


def taxonomy(spark: SparkSession, document: dict) -> DataFrame:
    """Rows of a taxonomy tree (parsed YAML): macro, labels, sub, flags, aliases, anchors."""
    fields = "macro string, macro_label string, sub string, sub_label string, aliases array<string>, story string, since date, provisional boolean, promoted date, retired boolean, dual boolean, anchors array<string>, merged_into string"
    rows = []
    for macro, m in document.items():
        for sub, s in (m.get("subtopics") or {None: {}}).items():
            rows.append((macro, m.get("label"), sub, s.get("label"), s.get("aliases") or [], s.get("story"), s.get("since"), bool(s.get("provisional")), s.get("promoted"), bool(s.get("retired")), bool(s.get("dual")), s.get("anchors") or [], s.get("merged_into")))
    return spark.createDataFrame(rows, fields)


def corrections(spark: SparkSession, entries: list[dict], pairs: set[tuple[str, str | None]]) -> DataFrame:
    """Corrections from parsed YAML; an id must be a string, topics must be known, a note and a day are needed."""
    rows = []
    for n, e in enumerate(entries):
        key = e.get("id")
        if key is not None and not isinstance(key, str):
            raise ValueError(f"entry {n}: an id must be a string, else digits are lost")
        if key is None and not (e.get("handle") and e.get("date") and e.get("match")):
            raise ValueError(f"entry {n}: an id, or handle, date and match")
        topics = [(t[0], t[1] if len(t) > 1 else None) for t in e.get("topics") or []]
        if bad := [t for t in topics if t not in pairs]:
            raise ValueError(f"entry {n}: unknown topic {bad[0]}")
        if not e.get("on"):
            raise ValueError(f"entry {n}: no filing day")
        rows.append((key, e.get("handle"), e.get("date"), e.get("match"), topics, e.get("note"), e.get("by"), str(e["on"]), n))
    return spark.createDataFrame(rows, "post_id string, handle string, date string, match string, topics array<struct<macro:string,sub:string>>, note string, by string, filed string, position int")


def explode_day(day: DataFrame) -> dict[str, DataFrame]:
    """Tables of an interpretation day file: assignment, incident_flag, emerging, pending."""
    pairs = day.select(F.explode("assignments").alias("post_id", "topics"))
    return {
        "classified": pairs.select("post_id"),
        "assignment": pairs.select("post_id", F.explode("topics").alias("t")).select("post_id", F.get("t", F.lit(0)).alias("macro"), F.get("t", F.lit(1)).alias("sub")),
        "incident_flag": day.select(F.explode("incidents").alias("post_id", "f")).select("post_id", "f.*"),
        "emerging": day.select(F.explode("emerging").alias("e")).select("e.label", F.explode("e.ids").alias("post_id")),
        "pending": day.select(F.explode("pendingIds").alias("post_id")),
    }


def feed_items(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Items of RSS and Atom documents: format, title, link, guid, published, summary; those without link or title go."""
    x = F.col(xml)
    atom = x.rlike(r"(?i)<feed\b") & x.rlike(r"(?i)<entry\b")
    piece = F.when(atom, F.regexp_extract_all(x, F.lit(r"(?is)<entry\b.*?</entry>"), F.lit(0))).otherwise(F.regexp_extract_all(x, F.lit(r"(?is)<item\b.*?</item>"), F.lit(0)))
    rows = feeds.withColumn("_atom", atom).withColumn("_i", F.explode(piece))
    i = F.col("_i")

    def tag(*names: str) -> Column:
        found = [F.nullif(F.trim(F.regexp_replace(F.regexp_extract(i, rf"(?is)<{n}(?:\s[^>]*)?>(.*?)</{n}>", 1), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")), F.lit("")) for n in names]
        return X.decode_entities(F.coalesce(*found, F.lit("")))

    attr = lambda pattern: F.nullif(X.decode_entities(F.regexp_extract(i, pattern, 1)), F.lit(""))
    alternate = F.coalesce(attr(r"(?i)<link\b[^>]*rel=[\"']alternate[\"'][^>]*href=[\"']([^\"']+)[\"']"), attr(r"(?i)<link\b[^>]*href=[\"']([^\"']+)[\"']"))
    link = F.when(F.col("_atom"), alternate).otherwise(F.coalesce(F.nullif(tag("link"), F.lit("")), alternate, F.nullif(tag("guid"), F.lit(""))))
    out = rows.select(
        *feeds.columns, F.when(F.col("_atom"), "atom").otherwise("rss").alias("format"), X.strip_html(tag("title")).alias("title"), link.alias("link"),
        F.when(F.col("_atom"), tag("id")).otherwise(tag("guid")).alias("guid"), T.parse_date(F.when(F.col("_atom"), tag("published", "updated")).otherwise(tag("pubDate", "dc:date", "published"))).alias("published"),
        F.substring(X.strip_html(F.when(F.col("_atom"), tag("summary", "content")).otherwise(tag("description", "content:encoded"))), 1, 1000).alias("summary"),
    )
    return out.filter((F.coalesce("link", F.lit("")) != "") & (F.col("title") != ""))


def _meta(html: Column, name: str) -> Column:
    n = name.replace(".", r"\.")
    a = F.regexp_extract(html, rf"(?i)<meta\b[^>]*(?:property|name)=[\"']{n}[\"'][^>]*content=[\"']([^\"']+)[\"']", 1)
    b = F.regexp_extract(html, rf"(?i)<meta\b[^>]*content=[\"']([^\"']+)[\"'][^>]*(?:property|name)=[\"']{n}[\"']", 1)
    return X.decode_entities(F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")), F.lit("")))


_DROPPED = r"(?is)<(script|style|noscript|svg|iframe|nav|header|footer|aside|figure|figcaption|form)\b.*?</\1>"
_SKIPPED_CLASS = r"(?i)class=[\"'][^\"']*(caption|credit|byline|dateline|meta|promo|newsletter|disclaimer)"
_SKIPPED_START = r"(?i)^(advertisement|sign up|subscribe|read more|file\s*[-–—]|photo\b|image\b|credit\b)"
_PHOTO = r"(?i)\b(getty images|ap photo|reuters/|/ap\b|photo by|photograph by)\b"


def paragraphs(scope: Column, most: int, chars: int) -> Column:
    """Readable paragraphs of cleaned HTML: 40 code points at least, no captions, credits or invitations."""
    found = F.regexp_extract_all(scope, F.lit(r"(?is)<p\b[^>]*>.*?</p>"), F.lit(0))
    good = F.filter(found, lambda p: ~F.regexp_extract(p, r"(?is)^<p\b[^>]*>", 0).rlike(_SKIPPED_CLASS))
    texts = F.transform(good, lambda p: F.trim(F.regexp_replace(X.strip_html(F.regexp_replace(p, r"(?is)^<p\b[^>]*>", "")), r"\n+", " ")))
    kept = F.filter(texts, lambda t: (F.length(t) >= 40) & ~t.rlike(_SKIPPED_START) & ~(t.rlike(_PHOTO) & (F.length(t) < 240)))
    return F.transform(F.slice(kept, 1, most), lambda t: F.when(F.length(t) > chars, F.concat(F.substring(t, F.lit(1), F.lit(chars - 1)), F.lit("…"))).otherwise(t))


def extract_articles(pages: DataFrame, html: str = "html", url: str = "url", most: int = 3, chars: int = 600) -> DataFrame:
    """Canonical link, date, language, title and up to three passages of public pages."""
    h = F.coalesce(F.col(html), F.lit(""))
    canon = F.coalesce(F.nullif(F.regexp_extract(h, r"(?i)<link\b[^>]*\brel=[\"']canonical[\"'][^>]*\bhref=[\"']([^\"']+)[\"']", 1), F.lit("")), F.nullif(F.regexp_extract(h, r"(?i)<link\b[^>]*\bhref=[\"']([^\"']+)[\"'][^>]*\brel=[\"']canonical[\"']", 1), F.lit("")))
    cleaned = F.regexp_replace(F.regexp_replace(h, r"(?s)<!--.*?-->", " "), _DROPPED, " ")
    body = F.nullif(F.regexp_extract(cleaned, r"(?is)<article\b.*?</article>", 0), F.lit(""))
    inside = F.when(body.isNotNull(), paragraphs(body, most, chars)).otherwise(F.array().cast("array<string>"))
    rows = pages.withColumn("_in", inside).withColumn("passages", F.when(F.size("_in") > 0, F.col("_in")).otherwise(paragraphs(cleaned, most, chars))).drop("_in")
    date = F.coalesce(F.nullif(_meta(h, "article:published_time"), F.lit("")), F.nullif(_meta(h, "datePublished"), F.lit("")), F.nullif(F.regexp_extract(h, r"\"datePublished\"\s*:\s*\"([^\"]+)\"", 1), F.lit("")))
    title = F.coalesce(F.nullif(_meta(h, "og:title"), F.lit("")), F.nullif(X.decode_entities(F.regexp_extract(h, r"(?is)<title(?:\s[^>]*)?>(.*?)</title>", 1)), F.lit("")), F.lit(""))
    return (
        rows.withColumn("canonical", F.coalesce(X.decode_entities(canon), F.nullif(_meta(h, "og:url"), F.lit("")), F.col(url)))
        .withColumn("published", T.parse_date(date)).withColumn("lang", F.nullif(F.regexp_extract(h, r"(?i)<html\b[^>]*\blang=[\"']([a-zA-Z-]+)[\"']", 1), F.lit("")))
        .withColumn("title", X.strip_html(title)).withColumn("extract", F.when(F.size("passages") > 0, "body").otherwise("headline-only"))
    )


def transcript_passages(html: Column, most: int = 3) -> Column:
    """Paragraphs of a transcript; a speaker's label in its own paragraph goes before the next one."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>.*?(?=<p\b|</p>|$)"), F.lit(0))
    texts = F.transform(raw, lambda p: F.trim(F.regexp_replace(X.strip_html(F.regexp_replace(p, r"(?is)^<p\b[^>]*>", "")), r"\n+", " ")))
    label = r"^[A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ ,.'’()-]{1,100}:"
    start = F.struct(F.lit("").alias("speaker"), F.array().cast("array<string>").alias("out"))

    def step(a, t):
        own = (a["speaker"] != "") & (t != "") & ~t.rlike(r"^\(")
        said = F.when(own & ~t.rlike(label), F.concat(a["speaker"], F.lit(" "), t)).otherwise(t)
        return F.when(t.rlike(label + "$"), F.struct(t.alias("speaker"), a["out"].alias("out"))).otherwise(
            F.struct(F.when(own, "").otherwise(a["speaker"]).alias("speaker"), F.when(F.length(said) >= 40, F.concat(a["out"], F.array(said))).otherwise(a["out"]).alias("out"))
        )

    return F.slice(F.aggregate(texts, start, step, lambda a: a["out"]), 1, most)


def floor_agenda(spark: SparkSession, path: str) -> DataFrame:
    """Items of a floor schedule in XML: congress, week, category, item, bill, title, documents; ids must be unique."""
    raw = spark.read.format("xml").option("rowTag", "floorschedule").option("mode", "FAILFAST").schema(schemas.FLOOR).load(path)
    items = raw.select(F.col("`_congress-num`").cast("int").alias("congress"), F.col("`_week-date`").alias("week"), F.explode("category").alias("c")).select("congress", "week", F.col("c._type").alias("category"), F.explode(F.col("c.floor-items.floor-item")).alias("i"))
    out = items.select("congress", "week", "category", F.col("i._id").alias("id"), bill_id(F.col("i.legis-num")).alias("bill_id"), F.col("i.floor-text").alias("title"), F.col("i._remove-date").isNotNull().alias("withdrawn"), F.coalesce(F.transform(F.col("i.files.file"), lambda f: f["_doc-url"]), F.array().cast("array<string>")).alias("documents"))
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("congress", "week", "id"))
    return out.withColumn("_n", n).withColumn("id", F.when(F.col("_n") == 1, F.col("id")).otherwise(F.raise_error(F.concat(F.lit("repeated item "), F.col("id"))).cast("string"))).drop("_n")


def floor_links(html: Column) -> Column:
    """The one dated link to a schedule in a page; null unless there is exactly one."""
    found = F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*class=[\"'][^\"']*downloadXML[^\"']*[\"'][^>]*href=[\"']([^\"']*\d{8}[^\"']*\.xml)[\"']"), F.lit(1)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


_BILL = r"(?i)(?<![A-Za-z0-9.])(H\.?\s?R\.?|S\.?|H\.?\s?Res\.?|S\.?\s?Res\.?|H\.?\s?J\.?\s?Res\.?|S\.?\s?J\.?\s?Res\.?|H\.?\s?Con\.?\s?Res\.?|S\.?\s?Con\.?\s?Res\.?)\s?(\d{1,5})(?![\dA-Za-z])"


def bill_id(text: Column) -> Column:
    """the first bill named in a text, normalised (hr-1234); null without one."""
    kind = F.lower(F.regexp_replace(F.regexp_extract(text, _BILL, 1), r"[.\s]", ""))
    return F.when(kind != "", F.concat(kind, F.lit("-"), F.regexp_extract(text, _BILL, 2)))


def bill_refs(text: Column) -> Column:
    """all bills named in a text, normalised, each once."""
    found = F.regexp_extract_all(text, F.lit(_BILL), F.lit(0))
    return F.array_distinct(F.transform(found, lambda b: F.concat(F.lower(F.regexp_replace(F.regexp_replace(b, r"\d+$", ""), r"[.\s]", "")), F.lit("-"), F.regexp_extract(b, r"(\d+)$", 1))))


def latest_news(news: DataFrame, as_of: Column | None = None, days: int | None = None) -> DataFrame:
    """Newest version per item, of equal ones the last line (position); with days only the recent ones."""
    newest = ranked(news, "id", [F.desc("version"), F.desc("position")], 1, "_r").drop("_r")
    return newest if days is None else newest.filter(F.col("published") >= as_of - F.expr(f"INTERVAL {days} DAYS"))


def due(items: DataFrame, as_of: Column) -> DataFrame:
    """Items to fetch again: never tried, six hours after a failure, a day after a success without a body."""
    age = T.age_seconds(F.col("attempted"), as_of)
    return items.withColumn("due", F.col("attempted").isNull() | (F.col("failed") & (age >= 6 * 3600)) | (~F.col("failed") & (F.col("extract") != "body") & (age >= 24 * 3600)))


def quantised_vectors(index: DataFrame, dim: int) -> DataFrame:
    """Unit vectors from bytes and a scale; a wrong size is an error."""
    from ..functions import mathfn as M

    bad = F.raise_error(F.concat(F.lit("vector of the wrong size: "), F.col("post_id").cast("string")))
    ok = index.withColumn("q", F.when(F.size("q") == dim, F.col("q")).otherwise(bad.cast("array<tinyint>")))
    return ok.select("post_id", M.dequantise(F.struct("scale", "q")).alias("embedding"))


def unique_verdicts(rows: DataFrame) -> DataFrame:
    """Verdicts with each item once; a repeated one is an error."""
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("item_id"))
    return rows.withColumn("_n", n).withColumn("item_id", F.when(F.col("_n") == 1, F.col("item_id")).otherwise(F.raise_error(F.concat(F.lit("repeated item "), F.col("item_id"))).cast("string"))).drop("_n")


def shards(spark: SparkSession, main: str, parts: str, schema: str) -> DataFrame:
    """Rows of a document's shards; their number and uniqueness are checked against the main document."""
    total = json_document(spark, main, "total bigint")
    rows = spark.read.schema(schema).json(parts)
    n = rows.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))
    ok = n.join(F.broadcast(total)).select(F.assert_true((F.col("n") == F.col("total")) & (F.col("n") == F.col("ids")), F.lit("shards don't match their document")).alias("ok"))  # one row each
    return rows.join(F.broadcast(ok)).drop("ok")
