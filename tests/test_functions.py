"""Text, time, number and vector functions on small literal cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import mathfn as M
from corpusloom.functions import text as X
from corpusloom.functions import timefn as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Trump’s plan", "trump plan"), ("I don't know", "i do not know"), ("We won't", "we will not"), ("can't shan't", "can not shall not"), ("the U.S. and D.C.", "the us and dc"),
        ("see https://t.co/x @me #Big-Deal!", "see big-deal"), ("", ""), (None, ""),
    ],
)
def test_tokenize(spark, text, want):
    assert " ".join(one(spark, X.tokenize(F.lit(text).cast("string")))) == want


def test_ngrams(spark):
    got = one(spark, X.ngrams(F.split(F.lit("state of the union 2024 10"), " "), 2, 4))
    assert "state of the union" in got and "of the" not in got and "union 2024" in got and "2024 10" not in got
    assert one(spark, X.ngrams(F.array(F.lit("one")))) == [] and one(spark, X.ngrams(F.array().cast("array<string>"))) == []


@pytest.mark.parametrize(("a", "b", "want"), [("a b c", "a x c", True), ("a b c", "a b", True), ("a b", "x a b", True), ("a b c", "a b c", False), ("a b c", "x y c", False), ("a b c d", "a b", False)])
def test_one_token_edit(spark, a, b, want):
    assert one(spark, X.one_token_edit(F.lit(a), F.lit(b))) is want


def test_entities_and_html(spark):
    assert one(spark, X.decode_entities(F.lit("a &amp; b &#39;c&#x27; &nope; &#128512; &#xD800; &RSQUO;"))) == "a & b 'c' &nope; 😀 � ’"
    html = "<p>One<br>two</p><script>x<y</script><!-- no --><style>p{}</style><div>a &lt; b</div>"
    assert one(spark, X.strip_html(F.lit(html))) == "One\ntwo\na < b"


def test_folding_and_stems(spark):
    assert one(spark, X.fold(F.lit("Kaʻū É’s"))) == "kau es"
    for w, s in (("flooding", "flood"), ("cities", "city"), ("crashes", "crash"), ("closed", "clos"), ("fires", "fir"), ("cars", "car"), ("gas", "gas")):
        assert one(spark, X.stem(F.lit(w))) == s


def test_small_texts(spark):
    assert one(spark, X.clip(F.lit("one two  three four"), 12)) == "one two…"
    assert one(spark, X.slug(F.lit("  Big, Bad Wolf! "))) == "big-bad-wolf"
    assert one(spark, X.label_key(F.lit("É-Tax / 2024!"))) == "é tax 2024"
    assert one(spark, X.parse_budget(F.lit("15,000"))) == 15000 and one(spark, X.parse_budget(F.lit("50_000"))) == 50000 and one(spark, X.parse_budget(F.lit("junk"))) is None
    assert [one(spark, X.short_number(F.lit(n))) for n in (999, 12300, 1230000)] == ["999", "12.3K", "1.23M"]
    assert one(spark, X.initials(F.lit("Ann van Dyke"))) == "AD" and one(spark, X.query_value(F.lit("x#row=a%2Fb&w=t"), "row")) == "a/b"
    assert one(spark, X.prepare_text(F.lit(" https://t.co/abc "))) == "(no text)"
    assert one(spark, X.similar_labels(F.lit("Farm bill vote"), F.lit("farm bills"))) and not one(spark, X.similar_labels(F.lit("Farm bill"), F.lit("Water main")))


def test_hashes(spark):
    h = 2166136261
    for b in "abé".encode():
        h = ((h ^ b) * 16777619) % 2**32
    assert one(spark, X.fnv1a(F.lit("abé"))) == h
    assert one(spark, X.snowflake_time(F.lit("1541815603606036480"))) == datetime(2022, 6, 28, 16, 7, 40, 105000)


def test_dates(spark):
    at = lambda s: F.to_timestamp(F.lit(s))
    assert one(spark, T.et_date(at("2026-09-02 03:00:00"))) == date(2026, 9, 1) and one(spark, T.et_date(at("2026-09-02 05:00:00"))) == date(2026, 9, 2)
    now = at("2024-01-02 12:00:00")
    assert [one(spark, T.lifecycle(at(s), now)) for s in ("2024-01-02 11:00:00", "2024-01-01 16:00:00", "2023-12-31 20:00:00")] == ["active", "monitoring", "resolved"]
    assert [one(spark, T.congress_at(F.lit(d).cast("date"))) for d in ("2025-01-02", "2025-01-03", "2024-06-01")] == [118, 119, 118]
    assert one(spark, T.parse_date(F.lit("Tue, 02 Jan 2024 10:00:00 GMT"))) == datetime(2024, 1, 2, 10) and one(spark, T.parse_date(F.lit("2024-01-02T10:00:00Z"))) == datetime(2024, 1, 2, 10) and one(spark, T.parse_date(F.lit("soon"))) is None
    assert one(spark, T.clock_valid(F.lit("2024-01-02T10:00Z"))) and not one(spark, T.clock_valid(F.lit("2024-01-02T10:00")))


def momentum(spark, c, trend, d, m, m_mean, eng, per):
    arr = lambda v: F.array(*map(F.lit, v))
    return one(spark, M.momentum(arr(c), arr(trend), F.lit(float(d)), F.lit(float(m)), F.lit(float(m_mean)), F.lit(float(eng)), F.lit(float(per))))


def test_momentum(spark):
    steady = [10] * 7
    assert momentum(spark, [10, 0, 0], steady, 0, 5, 5, 100, 10).score == 45
    assert momentum(spark, [5, 5], steady, 0, 5, 5, 100, 10).score == 55
    assert momentum(spark, [20, 20], [1, 1, 2, 3, 5, 10, 40], 300, 30, 5, 4000, 10).score > 80
    assert momentum(spark, [1, 0, 0], [40, 30, 20, 10, 5, 3, 1], -90, 1, 20, 1, 10).score < 30


def test_vectors(spark):
    v = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, M.normalise(v)) == [0.6, 0.8] and one(spark, M.norm(v)) == 5.0 and one(spark, M.cosine(v, F.array(F.lit(0.0), F.lit(0.0)))) == 0.0
    q = one(spark, M.quantise(F.array(F.lit(-1.0), F.lit(0.5), F.lit(0.0))))
    assert list(q.q) == [-127, 64, 0] and one(spark, M.quantise(F.array(F.lit(0.0)))).scale == 1.0
    assert one(spark, M.half_up(F.lit(-0.5))) == 0 and one(spark, M.or_one(F.lit(0))) == 1.0
