"""Operators on small cases: rollups, phrases, incidents, evidence, stories, state, sources, sinks, streams."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import enrich, evaluation, evidence, graph, incidents, phrases, rollup, state, stories, vectors, windows
from corpusloom.sources import readers, schemas, sinks
from corpusloom.streaming import stream



def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.select(*cols).collect())


def test_rollup_counts_a_post_once_per_macro(spark):
    t = "array<struct<macro:string,sub:string>>"
    p = spark.createDataFrame([(1, "2024-01-01", "tweet", "A", ["x"], 10, [("m", "a"), ("m", "b")]), (2, "2024-01-01", "retweet", "B", None, 5, [("m", None)])], f"post_id int, day string, type string, member string, groups array<string>, engagement int, topics {t}")
    got = {(r.sub, r.scope): (r.posts, r.retweets, r.members, r.engagement) for r in rollup.topic_day(p).collect()}
    assert got[None, "all"] == (1, 1, 2, 15) and got["a", "all"] == (1, 0, 1, 10) and got[None, "x"] == (1, 0, 1, 10) and ("a", "y") not in got


def test_phrases_count_authors_and_drop_contained_ones(spark):
    p = spark.createDataFrame([(i, a, i, "d", ty, "The health care act now passes") for i, (a, ty) in enumerate([("u", "tweet"), ("u", "tweet"), ("v", "tweet"), ("w", "quote"), ("x", "retweet")])], "post_id int, author_id string, created int, day string, type string, text string")
    uses = phrases.phrase_uses(p)
    mined = phrases.mine(uses, 3)
    assert {r.members for r in mined.collect()} == {3} and "health care" in rows(mined, "phrase")
    kept = rows(phrases.prune_contained(mined), "phrase")
    assert "care act" not in kept and "health care act" in kept
    odd = spark.createDataFrame([("d", "care act", 3), ("d", "healthcare action", 3), ("d", "care plan", 3), ("d", "xcare plans", 2)], "day string, phrase string, members int")
    assert rows(phrases.prune_contained(odd), "phrase") == ["care plan", "healthcare action", "xcare plans"]


def test_families_and_components(spark):
    p = spark.createDataFrame([("big tax cut",), ("big tax cuts",), ("huge tax cut",), ("clean water act",), ("border bill",)], "phrase string")
    assert len({r.family for r in phrases.families(p).collect()}) == 3
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (102, 101)], "a int, b int")
    assert {r.root for r in graph.components(edges).collect()} == {0, 100}
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "s string, t string")
    assert dict(rows(graph.follow(chain, "s", "t"), "s", "t")) == {"a": "d", "b": "d", "c": "d"}


def test_kinds_places_and_cues(spark):
    df = spark.createDataFrame([("brush fire", "Napa County, CA", "Evacuate now"), ("Severe Weather", "Texas", "Today we remember the victims"), ("parade", "", "Praying for all"), ("outage", "New York, NY", "")], "kind string, place string, text string")
    out = df.select(incidents.canonical_kind(F.col("kind")).alias("k"), incidents.place_reason(F.col("place")).alias("p"), incidents.cue_reason(F.col("text"))["reason"].alias("c")).collect()
    assert [tuple(r) for r in out] == [("wildfire", None, None), ("severe storm", "place is a whole state", "commemoration"), ("parade", "no place", "reaction only"), ("power outage", None, None)]


def test_evidence_span(spark):
    text = "Stay safe. A brush fire burns near Napa tonight! More soon https://x.y"
    df = spark.createDataFrame([(text, "wildfire", "Napa County, CA"), ("Nothing here at all", "flooding", "Napa, CA")], "text string, kind string, place string")
    a, b = (r.evidence for r in incidents.evidence(df).collect())
    assert a.exact and a.span == "A brush fire burns near Napa tonight!" and text[a.start : a.stop] == a.span
    assert not b.exact and b.span == "Nothing here at all"


def test_incidents_split_after_48_hours(spark):
    at = lambda h: datetime(2024, 1, 1) if h == 0 else datetime.fromtimestamp(1704067200 + h * 3600)
    p = spark.createDataFrame([("k", i, at(h), i, i) for i, h in enumerate((0, 48, 97))], "key string, post_id int, created timestamp, author_id int, member int")
    out = incidents.group_incidents(p, F.lit("2024-01-05 02:00:00").cast("timestamp"))
    assert sorted((r.posts, r.lifecycle) for r in out.collect()) == [(1, "active"), (2, "resolved")]


def test_evidence_needs_a_name_and_the_window(spark):
    posts = spark.createDataFrame([(1, datetime(2024, 1, 10), "The Dilley detention center in South Texas again holds 2,400 people")], "post_id int, created timestamp, text string")
    body = ["Officials said the detention center at Dilley in South Texas now holds 2,400 people, more than ever."]
    news = [(1, datetime(2024, 1, 9), datetime(2024, 1, 9), "Dilley center fills", "", body, "body"), (2, datetime(2023, 12, 1), datetime(2023, 12, 1), "Dilley center fills", "", body, "body"), (3, datetime(2024, 1, 9), datetime(2024, 1, 9), "Markets", "", ["Stocks rose on the day as people bought."], "body"), (4, datetime(2024, 1, 11), datetime(2024, 1, 11), "Dilley", "", body, "body")]
    n = spark.createDataFrame(news, "news_id int, published timestamp, fetched timestamp, title string, summary string, passages array<string>, extract string")
    assert rows(evidence.retrieve(posts, n), "news_id") == [1]
    assert rows(evidence.retrieve(posts, n, F.lit("2024-02-01").cast("timestamp")), "news_id") == [1, 4]


def test_clusters_merge_the_closest_first():
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99], [-1, 0]], float)
    assert vectors.merge_groups(v, 0.9) == [[0, 1], [2, 3], [4]] and vectors.merge_groups(v[:0]) == []


def test_stories(spark):
    s = spark.createDataFrame([("New thing", "m", 9, 4, 3), ("new  thing!", "m", 6, 4, 3), ("Old", "m", 9, 4, 3), ("Few", "m", 2, 4, 3), ("Lost", "q", 9, 4, 3)], "story string, macro string, posts int, members int, days int")
    t = spark.createDataFrame([("m", "old")], "macro string, sub string")
    assert {r.story: r.reason for r in stories.promote(s, t).collect()} == {"New thing": None, "new  thing!": "twin", "Old": "exists", "Few": "few posts", "Lost": "unknown macro"}
    g = spark.createDataFrame([("a", 9, [1, 2]), ("b", 3, [3]), ("c", 1, [4])], "key string, posts int, ids array<int>")
    m = {r.key: (r.posts, r.merged_from) for r in stories.apply_merges(g, spark.createDataFrame([("b", "a")], "a string, b string")).collect()}
    assert m == {"a": (3, ["b"]), "c": (1, [])}
    labels = spark.createDataFrame([("Farm bill vote", 1, [1]), ("farm bills", 2, [2, 3]), ("Water main", 1, [4])], "label string, day int, ids array<int>")
    assert sorted((r.label, r.ids) for r in stories.label_clusters(labels).collect()) == [("Water main", [4]), ("farm bills", [1, 2, 3])]


def test_packing_keeps_its_bounds(spark):
    d = spark.createDataFrame([(1, i, 50_000 if i == 3 else 10) for i in range(100)], "day int, o int, w int")
    out = state.pack(d, "day", "o", "w", 40, 50_100)
    per = {}
    for r in out.collect():
        per.setdefault(r.chunk, []).append((r.o, r.w))
    assert all(len(v) <= 40 and sum(w for _, w in v) <= 50_100 for v in per.values()) and sum(map(len, per.values())) == 100


def test_replies_and_merges(spark):
    tax = spark.createDataFrame([("m", "a")], "macro string, sub string")
    r = spark.createDataFrame([(1, [("m", "a")], ["e"]), (2, [("q", None)], []), (2, [("m", None)], []), (9, [], [])], "post_id int, topics array<struct<macro:string,sub:string>>, evidence array<string>")
    e = spark.createDataFrame([(1, ["e"]), (2, []), (3, [])], "post_id int, supplied array<string>")
    got = {x.post_id: x.errors for x in state.reply_errors(r, e, tax).collect()}
    assert got == {1: [], 2: ["duplicate", "unknown-topic"], 3: ["missing"], 9: ["unexpected"]}
    frame = lambda v: spark.createDataFrame([("a", v)], "name string, value string")
    assert rows(state.merge_state(frame("1"), frame("2"), frame("1")), "value") == ["2"]
    with pytest.raises(Exception, match="conflict"):
        state.merge_state(frame("1"), frame("2"), frame("3")).collect()


def test_topics_are_validated(spark):
    tax = F.create_map(F.lit("m"), F.array(F.lit("a")))
    df = spark.createDataFrame([([("m", "a"), ("m", "zz"), ("q", None), ("m/a", None), ("m", "a")],)], "t array<struct<macro:string,sub:string>>")
    assert [tuple(x) for x in df.select(enrich.topic_pairs(F.col("t"), tax)).first()[0]] == [("m", "a"), ("m", None)]


def test_strict_and_lenient_lines(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text('{"a": 1}\n\n{"a": 2}\nnope\n')
    assert rows(readers.jsonl(spark, str(f), "a int", strict=False), "a") == [1, 2]
    with pytest.raises(Exception):  # noqa: B017, PT011
        readers.jsonl(spark, str(f), "a int").collect()
    assert readers.jsonl(spark, str(tmp_path / "none"), "a int").count() == 0


def test_csv_roster_feed_and_floor(spark, tmp_path):
    f = tmp_path / "r.csv"
    f.write_text('handle,member,account_type,caucuses,state_district,status\r\n@a,"Doe, ""J""",personal,x|y,CA-1,\r\n,,,,,\r\n')
    (r,) = readers.roster(readers.csv(spark, str(f), schemas.ROSTER)).collect()
    assert (r.handle, r.member, r.caucuses, r.status) == ("a", 'Doe, "J"', ["x", "y"], "house")
    rss = "<rss><item><title><![CDATA[A &amp; B]]></title><link>http://x/1</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item><item><title>no link</title></item></rss>"
    atom = "<feed><entry><title>T</title><link rel='alternate' href='http://x/2'/><id>i</id><updated>2024-01-02T10:00:00Z</updated></entry></feed>"
    items = readers.feed_items(spark.createDataFrame([(rss,), (atom,)], "xml string")).collect()
    assert [(i.format, i.title, i.link, str(i.published)) for i in items] == [("rss", "A & B", "http://x/1", "2024-01-02 10:00:00"), ("atom", "T", "http://x/2", "2024-01-02 10:00:00")]
    x = tmp_path / "f.xml"
    x.write_text('<floorschedule congress-num="118" week-date="2024-01-08"><category type="a"><floor-items><floor-item id="1" add-date="x"><legis-num>H.R. 12</legis-num><floor-text>Act</floor-text></floor-item></floor-items></category></floorschedule>')
    assert rows(readers.floor_agenda(spark, str(x)), "bill_id") == ["hr-12"]


def test_articles(spark):
    html = '<html lang="en"><head><title>T</title><meta property="article:published_time" content="2024-01-02T10:00:00Z"><link rel="canonical" href="http://c/"></head><nav><p>' + "n" * 50 + '</p></nav><article><p class="caption">' + "c" * 50 + "</p><p>short</p><p>" + "word " * 200 + "</p><p>" + "Second paragraph of the article, long enough." + "</p></article></html>"
    (a,) = readers.extract_articles(spark.createDataFrame([("http://u/", html)], "url string, html string")).collect()
    assert (a.canonical, a.lang, a.title, a.extract, len(a.passages)) == ("http://c/", "en", "T", "body", 2) and len(a.passages[0]) == 600


def test_appends_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "a")
    b = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02"), ("2", "2024-01-02")], "id string, et_date string").withColumn("et_date", F.col("et_date").cast("date"))
    sinks.append_new(b, path)
    sinks.append_new(b.union(b.limit(1).withColumn("id", F.lit("3"))), path)
    assert rows(spark.read.parquet(path), "id") == ["1", "2", "3"]
    sinks.overwrite_days(b.filter("id = '1'"), path)
    assert rows(spark.read.parquet(path), "id") == ["1", "2"]
    sinks.swap(b.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_stream_ingest_and_sessions(spark, tmp_path):
    src, arch = str(tmp_path / "in"), str(tmp_path / "arch")
    made = lambda ids: spark.createDataFrame([(str(i), datetime(2024, 1, 1 + i % 3)) for i in ids], "id string, created timestamp").withColumn("et_date", F.to_date("created"))
    made(range(5)).write.parquet(src)
    schema = made([0]).schema
    for more in ((), (3, 4, 5)):
        if more:
            made(more).write.mode("append").parquet(src)
        stream.ingest(stream.read_posts(spark, src, schema), arch, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(arch), "id") == [str(i) for i in range(6)]


def test_samples_weights_and_health(spark):
    df = spark.range(100).withColumn("stratum", (F.col("id") % 4).cast("string"))
    s = evaluation.sha_sample(df, "id", "x", F.lit(5), ["stratum"])
    assert s.count() == 20 and rows(evaluation.weights(s, df), "weight") == [5.0] * 20
    states = evaluation.health(spark.createDataFrame([("a", 5.0), ("b", 1.0)], "name string, value double"), spark.createDataFrame([("a", 3.0, 6.0), ("b", 3.0, 6.0), ("c", 1.0, 2.0)], "name string, warn double, fail double"))
    assert {r.name: r.state for r in states.collect()} == {"a": "warn", "b": "ok", "c": "fail"} and evaluation.worst(states).first()[0] == "fail"


def test_windows(spark):
    df = spark.createDataFrame([("k", 1, 2, "a"), ("k", 2, 2, "b"), ("k", 3, 1, "c")], "key string, position int, version int, v string")
    assert rows(windows.latest_version(df, "key", "version", "position"), "v") == ["b"] and rows(windows.first_row(df, "key", "position"), "v") == ["a"]
    n = spark.range(10).withColumn("n", F.lit(10).cast("bigint"))
    assert windows.fitting_prefix(n, F.col("n"), 35, "id", bucket=F.floor(F.col("id") / 4)).count() == 3


def test_stream_windows_sessions_and_lifecycles(spark, tmp_path):
    src = str(tmp_path / "ev")
    at = [datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 0), datetime(2024, 1, 5, 0), datetime(2024, 1, 9, 0)]
    for i, t in enumerate(at):  # one file a batch, so that the watermark moves on
        spark.createDataFrame([(i, "k" if i < 3 else "z", t, i, 10, "m")], "post_id int, incident string, created timestamp, author_id int, engagement int, macro string").coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    read = lambda: stream.read_posts(spark, src, schema, files=1)
    out = stream.run_to_end(stream.sessions(read(), ["incident"], late="1 hour"), "sess")
    assert ("k", 3) in {(r.incident, r.posts) for r in out.collect()}
    out = stream.run_to_end(stream.rolling(read(), ["macro"], size="2 days", slide="1 day", late="1 hour"), "roll", "complete")
    assert {r.start.day: r.posts for r in out.collect()}[1] == 3
    phases = [(r.incident, r.phase) for r in stream.run_to_end(stream.lifecycles(read()), "life").collect()]
    assert ("k", "active") in phases and ("k", "monitoring") in phases
    assert {r.posts for r in stream.run_to_end(stream.daily(read(), ["macro"]), "days", "complete").collect()} == {1, 2}
