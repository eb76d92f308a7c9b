"""Serving, learning and acquisition on small cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import learning as L
from corpusloom.operators import serving as V
from corpusloom.sources import acquire as A

NOW = "2024-01-10 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.select(*cols).collect())


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def test_cursor_engagement_and_people(spark):
    df = spark.createDataFrame([("9007199254740993", (1, 2, None, 3), "Ann Lee"), ("9007199254740992", None, None)], "id string, m struct<likes:bigint,retweets:bigint,replies:bigint,quotes:bigint>, member string")
    assert rows(df.filter(V.after_cursor(F.col("id"), F.lit("9007199254740992"))), "id") == ["9007199254740993"]
    assert rows(df.select(V.engagement(F.col("m")).alias("e")), "e") == [0, 6]
    assert rows(df.select(F.coalesce(V.person_key(F.lit(None), F.lit(None), F.col("member")), F.lit("-")).alias("k")), "k") == ["-", "member:ann lee"]


def test_drill_down_and_badges(spark):
    p = spark.createDataFrame([(1, "m", "a", 1, 5), (2, "m", "b", 2, 9), (3, "q", None, 3, 1)], "post_id int, macro string, sub string, created int, engagement int")
    keys = spark.createDataFrame([("m",), ("m/a",), ("z",)], "key string")
    assert rows(V.drill_down(keys, p), "key", "post_id", "place") == [("m", 1, 2), ("m", 2, 1), ("m/a", 1, 1)]
    assert rows(V.badges(p, "macro", "engagement", "post_id", 1), "post_id") == [2, 3]
    assert rows(V.facets(p), "macro", "n") == [("m", 2), ("q", 1)]


def test_unity_gain_and_cards(spark):
    a = spark.createDataFrame([("x", "s1", 3), ("x", "s2", 2), ("x", "s3", 9)], "phrase string, scope string, people int")
    all_ = spark.createDataFrame([("s1", 20), ("s2", 5), ("s3", 100)], "scope string, people int")
    assert rows(V.unity(a, all_), "unity", "groups") == [(1, 3)]
    assert rows(V.adoption_gain(spark.createDataFrame([("x", 0, 1), ("x", 6, 8)], "phrase string, bucket int, people int")), "gain") == [7]
    p = spark.createDataFrame([(1, i, datetime(2024, 1, 10, 11 - 3 * i), i, i, 10 * i) for i in range(3)], "cluster int, post_id int, created timestamp, author_id int, member int, engagement int")
    (c,) = V.cluster_cards(p, now()).collect()
    assert (c.posts, c.people, c.engagement, c.sample) == (3, 3, 30, 2) and c.shape[-1] == 3 and c.shape == sorted(c.shape)


def test_status_and_highlight(spark):
    assert one(spark, V.highlight(F.lit("one two"), F.lit(4), F.lit(7), F.lit("two"))) == "one <mark>two</mark>"
    c = spark.createDataFrame([(datetime(2024, 1, 10, 11, 50), 0, 1), (datetime(2024, 1, 10, 11, 50), 3, 1), (datetime(2024, 1, 9), 0, 1), (None, 0, 0)], "last_run timestamp, pending int, classified int")
    assert rows(V.interpretation_state(c, now()), "state") == ["behind", "current", "off", "stale"]


def test_alias_screen_and_rules(spark):
    t = spark.createDataFrame([("m", "a", ["farm bill"]), ("m", "b", ["water main"])], "macro string, sub string, aliases array<string>")
    p = spark.createDataFrame([(1, "The Farm Bill passed"), (2, "A water main broke"), (3, "nothing")], "post_id int, text string")
    given = spark.createDataFrame([(1, "m", "a"), (2, "m", None)], "post_id int, macro string, sub string")
    assert rows(L.alias_screen(p, t, given), "post_id", "sub") == [(2, "b")]
    assert {r.post_id: len(r.topics) for r in L.rule_classifier(p, t).collect()} == {1: 1, 2: 1, 3: 0}
    assert rows(L.existing_sub(spark.createDataFrame([("m", "FARM BILL"), ("m", "x")], "macro string, label string"), t.withColumn("sub_label", F.col("sub"))), "sub") == ["a"]


def test_corrections_are_located_only_if_unique(spark):
    p = spark.createDataFrame([(1, "Ann", "d", "I said this"), (2, "ann", "d", "I said that"), (3, "bob", "d", "“Quoted” &amp; more")], "post_id int, handle string, day string, text string")
    c = spark.createDataFrame([(10, 1, None, None, None), (11, None, "ANN", "d", "i said"), (12, None, "bob", "d", '"quoted" & more'), (13, 99, None, None, None)], "correction_id int, post_id int, handle string, day string, match string")
    assert rows(L.locate_corrections(c, p), "correction_id", "post_id") == [(10, 1), (12, 3)]


def test_merge_edges_and_emerging_groups(spark):
    g = spark.createDataFrame([("a", "s", "Farm bill", [1, 2], None), ("b", "s", "farm bills", [2, 3], None), ("c", "t", "Farm", [1, 2], None), ("d", "s", "farm vote", [9], "a")], "key string, kind string, label string, ids array<int>, hint string")
    assert rows(L.merge_edges(g, spark.createDataFrame([("a", "c")], "a string, b string")), "a", "b", "why") == [("a", "b", "overlap"), ("a", "d", "hint")]
    e = "label string, macro string, key string, ids array<int>"
    out = L.emerging_groups(spark.createDataFrame([("New Bridge", "m", "k", [1])], e), spark.createDataFrame([("new bridge!", None, None, [2]), ("Other", "m", "k", [3]), ("Alone", None, None, [4])], e))
    assert sorted((r.label, r.ids) for r in out.collect()) == [("Alone", [4]), ("New Bridge", [1, 2, 3])]


def test_alias_lists_and_groups(spark):
    arr = lambda *v: F.array(*map(F.lit, v))
    assert one(spark, L.merge_aliases(arr("Tax", "tax", "Bill"), arr("BILL", "Act"))) == ["Tax", "Bill", "Act"]
    assert one(spark, L.confirmed_groups(F.array(arr("b", "a"), arr("a", "b"), arr("c", "c")))) == [["a", "b"]]


def test_samples_that_cover(spark):
    i = spark.createDataFrame([("m", 1, ["a", "b"]), ("m", 2, ["a"]), ("m", 3, ["c"])], "macro string, item_id int, subs array<string>")
    assert rows(L.greedy_coverage(i, 5), "item_id", "place") == [(1, 1), (3, 2)]
    frame = spark.createDataFrame([("m", k) for k in range(6)], "macro string, item_id int")
    assert L.top_up(frame.limit(1), frame, 4).count() == 4
    order = L.separate([1, 2, 3, 4, 5, 6], {2: 1}, 3)
    assert sorted(order) == [1, 2, 3, 4, 5, 6] and order.index(2) - order.index(1) >= 3
    assert one(spark, L.swap_places(F.lit("Fire in Napa today"), ["Napa", "Reno"], "s")) == "Fire in Reno today"


def test_paged_source_and_lookup(spark, tmp_path):
    spark.dataSource.register(A.PagedSource)
    s = spark.readStream.format("paged").option("client", "tests.client_stub:timeline").option("schema", "id int, text string").option("pages", "2").load()
    q = s.writeStream.format("memory").queryName("paged_rows").option("checkpointLocation", str(tmp_path / "c")).start()
    for _ in range(30):
        q.processAllAvailable()
        if spark.table("paged_rows").count() >= 10:
            break
    q.stop()
    assert rows(spark.table("paged_rows"), "id") == list(range(10))
    out = A.lookup(spark.range(4).select(F.col("id").alias("post_id")), "tests.client_stub:records", "post_id bigint, text string")
    assert [(r.post_id, r.unavailable) for r in out.orderBy("post_id").collect()] == [(0, False), (1, True), (2, False), (3, True)]


def test_strict_xml(spark):
    df = spark.createDataFrame([("<a><b/></a>",), ("<!DOCTYPE a><a/>",), ("<a>",), ("<x:a xmlns:x='u'/>",), ("<a>" * 13 + "</a>" * 13,), (None,)], "xml string")
    assert [r.fault for r in A.check_xml(df).collect()] == [None, "declares types or entities", "malformed", "namespace", "too deep", "empty"]


def test_jobs_queues_and_journals(spark):
    j = "job_id int, position int, state string"
    good = spark.createDataFrame([(1, 1, "prepared"), (1, 2, "submitted"), (1, 3, "unknown"), (2, 1, "prepared")], j)
    assert rows(A.job_states(good), "job_id", "state", "may_submit") == [(1, "unknown", False), (2, "prepared", True)]
    with pytest.raises(Exception, match="not allowed"):
        A.job_states(spark.createDataFrame([(1, 1, "prepared"), (1, 2, "finished")], j)).collect()
    q = "post_id int, created int"
    queue, take = A.pending_queue(spark.createDataFrame([(1, 1), (2, 2)], q), spark.createDataFrame([(3, 0), (2, 2)], q), spark.createDataFrame([(1,)], "post_id int"), 1)
    assert rows(queue, "post_id") == [2, 3] and rows(take, "post_id") == [3]
    r = "request_id int, state string, value string"
    merged = A.merge_journals(spark.createDataFrame([(1, "submitted", None)], r), spark.createDataFrame([(1, "finished", "x")], r), spark.createDataFrame([(1, "unknown", None)], r))
    assert rows(merged, "state", "value") == [("finished", "x")]
    assert one(spark, A.receipt_fault(F.lit("ok"), F.lit(3), F.lit(2))) == "ok but incomplete"


def test_embedding_is_a_unit_vector(spark):
    (v,) = spark.createDataFrame([("some words here",)], "t string").select(L.hashed_embedding(16)("t").alias("v")).first()
    assert abs(sum(x * x for x in v) - 1) < 1e-5


def test_ledgers_state_and_rendering(spark, tmp_path):
    from corpusloom.sources import readers, sinks

    f = tmp_path / "l.jsonl"
    f.write_text('{"day":"2024-01-01","stage":"s","model":"m","batch":false,"calls":1,"input":1,"output":1,"cache_read":0,"cache_write":-1}')
    with pytest.raises(Exception, match="negative"):
        readers.ledger(spark, str(f)).collect()
    with pytest.raises(ValueError, match="without"):
        readers.capture_state(spark, str(tmp_path / "none.json"), str(tmp_path))
    uses = lambda *r: spark.createDataFrame(list(r), "phrase string, author_id int, day int")
    path = str(tmp_path / "phrases")
    sinks.upsert_phrases(uses(("x", 1, 5)), path)
    sinks.upsert_phrases(uses(("x", 1, 3), ("x", 2, 9)), path)
    assert rows(spark.read.parquet(path), "author_id", "day") == [(1, 3), (2, 9)]
    t = spark.createDataFrame([("m", "b", ["z", "y"], False), ("m", "a", [], None), ("m", "c", [], True)], "macro string, sub string, aliases array<string>, retired boolean")
    assert rows(sinks.render_taxonomy(t), "text") == ["m\n  a\n  b: y, z"]
