"""Phrases slice by slice are those of all uses listed."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import grams, phrases


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(4)
    words = ["tax", "bill", "the", "of", "vote", "12", "house", "café", "don't", "u.s.", "x-y", "won't", "#road", "@me", "7"]
    rows = [(i, rng.choice(["a", "b", "c", "d", None]), rng.randrange(40), rng.choice(["en", "de", None]), rng.choice(["tweet", "tweet", "retweet"]), rng.choice([None, "", "tax", " ".join(rng.choices(words, k=rng.randrange(1, 40)))])) for i in range(400)]
    return spark.createDataFrame(rows, "post_id bigint, author_id string, created bigint, day string, type string, text string")


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("uses", [150_000_000, 2_000])
def test_slices_are_the_whole(spark, posts, monkeypatch, uses):
    monkeypatch.setattr(grams, "SLICE_USES", uses)
    monkeypatch.setattr(grams, "BLOCK_WORDS", 300)
    listed = phrases.phrase_uses(posts)
    known = posts.filter("author_id is not null and day is not null")
    assert rows(phrases.mine_posts(known, 3)) == rows(phrases.mine(phrases.phrase_uses(known), 3))
    assert rows(phrases.widespread_posts(posts, 2)) == rows(phrases.widespread(listed, 2))
    assert rows(phrases.widespread_posts(posts, 3, ())) == rows(phrases.widespread(listed, 3, ()))
    dated = posts.withColumn("day", F.col("created"))
    assert rows(phrases.widespread_first_posts(dated, 3)) == rows(phrases.widespread_first(phrases.phrase_uses(dated), 3).select("phrase", "author_id", "day"))
    few = spark.createDataFrame([("tax bill",), ("bill of vote",), ("house tax",), ("no such phrase",)], "phrase string")
    assert rows(phrases.uses_of(posts, few)) == rows(listed.join(few, "phrase").select("post_id", "author_id", "phrase"))


def test_only_shared_phrases_become_rows(spark):
    df = spark.createDataFrame([(i, f"a{i % 5}", i, "en", "tweet", f"common words here own{i} tail{i}") for i in range(200)], "post_id bigint, author_id string, created bigint, day string, type string, text string")
    tokens, authors = grams.store(df, ("day",))
    got = grams.rows_of(tokens, grams.candidates(tokens, authors, 3)).groupBy("phrase").agg(F.sum("posts").alias("n")).collect()
    want = phrases.widespread(phrases.phrase_uses(df), 3).collect()
    assert {r.phrase: r.n for r in got} == {r.phrase: r.posts for r in want} and want


def test_slices_are_few_and_their_parts_small(spark):
    tokens = lambda n: spark.range(1).select(F.lit(n).cast("bigint").alias("size"))
    assert grams.slices(tokens(1000)) == (1, grams.PARTS)
    for words in (10**8, 10**9, 2 * 10**9, 10**10):
        parts, dealt = grams.slices(tokens(words))
        assert parts <= grams.MOST_SLICES and 3 * words / parts / 2**dealt <= grams.SLICE_USES / 2**grams.PARTS


def test_parts_dealt_finer_are_the_same(spark, posts):
    tokens, authors = grams.store(posts, ("day",))
    assert (grams.candidates(tokens, authors, 3) == grams.candidates(tokens, authors, 3, dealt=10)).all()


def test_rows_of_long_posts_are_made_without_their_text(spark):
    # 40,000 rows that each carried a copy of the post's 270,000 characters
    text = " ".join(f"w{i}x" for i in range(40_000))
    df = spark.createDataFrame([(i, f"a{i}", i, "en", "tweet", text) for i in range(2)], "post_id bigint, author_id string, created bigint, day string, type string, text string")
    began = time.time()
    assert phrases.widespread_posts(df, 2).count() == 3 * 40_000 - 6
    assert time.time() - began < 60


def test_stored_tokens_are_those_of_tokenize(spark):
    rng = random.Random(9)
    bits = [*"abzAZ09_-#@.'‘’`&é ßKİ  \t\n\x0b\x1f😀", "won't", "CAN'T", "shan’t", "n't", "'s", "'ll", "u.s.", "e.g", "http://", "https://x.y/a'b", " ", "  "]
    texts = [None, "", " ", "-", "one"] + ["".join(rng.choices(bits, k=rng.randrange(1, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(i, "a", i, "tweet", t) for i, t in enumerate(texts)], "post_id bigint, author_id string, created bigint, type string, text string")
    tokens, _ = grams.store(df)
    got = {r.post_id: (r.tokens, r.size) for r in tokens.collect()}
    # the rules one after another, over every text
    word = "[a-z0-9_]"
    c = F.lower(F.coalesce("text", F.lit("")))
    for pattern, new in (
        (r"https?://\S+", " "), (rf"@{word}+", " "), ("#", ""), ("[‘’`]", "'"), (rf"(?<!{word})won't(?!{word})", "will not"), (rf"(?<!{word})can't(?!{word})", "can not"), (rf"(?<!{word})shan't(?!{word})", "shall not"),
        (rf"n't(?!{word})", " not"), (rf"'(s|ll|re|ve|d|m)(?!{word})", ""), ("'", ""), (rf"(?<!{word})([a-z])\.([a-z])\.?", "$1$2"), (r"[^a-z0-9\s-]", " "),
    ):
        c = F.regexp_replace(c, pattern, new)
    rules = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    want = {r.post_id: r.t for r in df.select("post_id", rules.alias("t")).collect()}
    assert {r.post_id: r.t for r in df.select("post_id", X.tokenize(F.col("text")).alias("t")).collect()} == want
    assert got == {k: (" ".join(t), len(t)) for k, t in want.items()}


def test_pruning_lists_no_pairs(spark):
    # 60,000 phrases begin with "go to" and 60,000 others hold it: as pairs 3,600,000,000 rows of one key
    begins = spark.range(60_000).select(F.concat(F.lit("go to p"), F.col("id").cast("string"), F.lit("x")).alias("phrase"), F.lit(5).alias("members"))
    holds = spark.range(60_000).select(F.concat(F.lit("ago to q"), F.col("id").cast("string"), F.lit("x y")).alias("phrase"), F.lit(5).alias("members"))
    began = time.time()
    assert phrases.prune_contained(begins.union(holds).withColumn("day", F.lit(1))).count() == 120_000
    assert time.time() - began < 60


def test_pruning_is_that_of_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("ab", k=rng.randrange(1, 4)))
    rows = sorted({(rng.choice([1, 2, None]), " ".join(word() for _ in range(rng.randrange(1, 5))), rng.randrange(3, 6)) for _ in range(600)}, key=repr)
    rows = list({(d, p): (d, p, m) for d, p, m in rows}.values())
    df = spark.createDataFrame(rows, "day int, phrase string, members int")
    tokens = lambda p: len(p.split(" "))
    gone = {(d, p) for d, p, m in rows if d and tokens(p) > 1 for e, q, n in rows if e == d and tokens(q) > 1 and len(q) > len(p) and p in q and n >= m}
    assert gone and sorted(map(repr, (tuple(r) for r in phrases.prune_contained(df).collect()))) == sorted(repr(r) for r in rows if r[:2] not in gone)
