"""Terms, names and scores of evidence, worked out by hand; plans without Python; vectors and mining in linear time."""

import io
from contextlib import redirect_stdout
from datetime import datetime

from pyspark.sql import functions as F

from corpusloom.functions import mathfn as M
from corpusloom.operators import evidence as E
from corpusloom.operators import phrases


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_terms_of_a_query(spark):
    text = F.lit("The Dilley Center in South Texas holds 2,400 people. Farmers in Iowa’s fields lost 30 acres! Senate votes at https://x.y/Zed today")
    r = one(spark, q=E.query_terms(text), s=E.subject_terms(E.query_terms(text)))
    assert {x.term: x.weight for x in r.q} == {
        "dilley": 0.5, "center": 0.5, "dilley center": 4.0, "south": 0.5, "texas": 0.5, "south texas": 4.0, "holds": 1.0, "2400": 2.0, "people": 1.0,
        "farmers": 1.0, "iowa": 3.0, "fields": 1.0, "lost": 1.0, "30": 2.0, "acres": 1.0, "senate": 1.0, "votes": 1.0,
    }
    assert sorted(r.s) == ["acres", "farmers", "fields", "holds", "lost", "votes"]


def test_names_of_an_article(spark):
    r = one(spark, n=E.proper_nouns(F.lit("Officials in Springfield met Maria Anna Lopez. Rain fell in Springfield; springs and Rivers and rivers rose. Trump spoke.")))
    assert sorted(r.n.words) == ["anna", "lopez", "maria", "springfield"] and sorted(r.n.phrases) == ["anna lopez", "maria anna", "maria anna lopez"]


def test_score_counts_title_body_and_repeats(spark):
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(w).alias("weight")) for t, w in (("flood", 1.0), ("lake erie", 4.0), ("mayor", 3.0))])
    found = E.hits(E.searchable(F.lit("Flood at Lake Erie")), E.searchable(F.lit("A flood, the flood; flood and flood near lake. Erie")), terms)
    r = one(spark, f=found, s=E.score(found))
    assert [(x.t, x.b) for x in r.f] == [(1, 4), (1, 1), (0, 0)]
    # flood 1 * (2 + 1 + 0.5 * 2), lake erie 4 * (2 + 1); two of three terms
    assert r.s == round((4 + 12) * (1 + 2 / 3), 2)


def test_evidence_needs_a_subject_besides_the_name(spark):
    posts = spark.createDataFrame([(1, datetime(2024, 1, 10), "Farmers near Springfield lost wheat harvest to hail")], "post_id int, created timestamp, text string")
    at = datetime(2024, 1, 9)
    news = [
        (1, at, at, "Hail over Springfield", "", ["Hail ruined wheat around Springfield.", "Crops near Springfield: harvest gone, wheat gone."], "body"),
        (2, at, at, "Parade", "", ["A parade went through Springfield and Springfield cheered in Springfield."], "body"),
        (3, at, at, "Hail", "In Springfield there was hail", ["Nothing more."], "body"),
        (4, datetime(2023, 12, 29), at, "Hail in Springfield", "", ["Wheat and hail, at Springfield"], "body"),
        (5, at, at, "Hail in Springfield ruins wheat harvest", "", ["Mayor of Springfield spoke"], "headline"),
    ]
    n = spark.createDataFrame(news, "news_id int, published timestamp, fetched timestamp, title string, summary string, passages array<string>, extract string")
    out = E.retrieve(posts, n)
    # 2 shares the name only; 3 has name and subject in no one passage; 4 is before the window; 5 has both in its title
    assert {r.news_id: (r.kind, r.passage) for r in out.collect()} == {1: ("report", "Crops near Springfield: harvest gone, wheat gone."), 5: ("lead", "Hail in Springfield ruins wheat harvest")}
    assert "Python" not in plan(out) and "InArrow" not in plan(out)


def test_mining_sorts_and_expands_nothing(spark):
    p = spark.createDataFrame([(i, a, datetime(2024, 1, 1, 5 - i), "d", "tweet", "big red barn") for i, a in enumerate("uvwu")], "post_id int, author_id string, created timestamp, day string, type string, text string")
    mined = phrases.mine(phrases.phrase_uses(p))
    assert {(r.phrase, r.members, r.posts, r.first_seen.hour, r.first_author) for r in mined.collect()} == {(x, 3, 4, 2, "u") for x in ("big red", "big red barn", "red barn")}
    assert "Expand" not in plan(mined) and "SortAggregate" not in plan(mined)
    tied = spark.createDataFrame([(2, "b", 1, "d", "x y"), (1, "a", 1, "d", "x y"), (0, "c", 9, "d", "x y")], "post_id int, author_id string, created int, day string, phrase string")
    words = tied.withColumn("post_id", F.col("post_id").cast("string"))
    assert [r.first_author for r in phrases.mine(tied).collect()] == [r.first_author for r in phrases.mine(words).collect()] == ["a"]


def test_vectors_are_normalised_and_quantised(spark):
    v = F.array(*[F.lit(float(x)) for x in (3, 4, 0, -12)])
    none = F.lit(None).cast("array<float>")
    r = one(spark, n=M.normalise(v), z=M.normalise(F.array(F.lit(0.0))), x=M.normalise(none), q=M.quantise(v), d=M.cosine(M.dequantise(M.quantise(v)), v))
    assert [round(x * 13, 9) for x in r.n] == [3, 4, 0, -12] and r.z == [0.0] and r.x is None
    assert r.q.q == [32, 42, 0, -127] and r.d > 0.999
