"""Methods against plain code: centroids, phrases and minima, token counts and digests of whole tables, contexts, blocks."""

import collections
import hashlib
import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, common, langid, lzfingerprint, neardup, toxicity
from corpusloom.llm import textkernel as K
from corpusloom.llm.queries import ORACLE, QUERIES
from test_queries import SMALL, distance, texts


def test_oracles_are_sql():
    assert all(isinstance(x, str) for x in ORACLE.values()) and set(ORACLE) <= set(QUERIES)


def column(gram):
    """Column of an n-gram of bytes, by the definition of the hash."""
    value = sum(b << (8 * i) for i, b in enumerate(gram))
    return ((value * int(langid._ODD[len(gram) - 1]) + len(gram) - 1) % 2**32) >> (32 - langid.DIM_BITS)


def grams(text):
    raw = bytearray()
    for c in text:
        low = c.lower() if c.isascii() or ("À" <= c <= "Þ" and c != "×") else c
        for b in low.encode():
            keep = 97 <= b <= 122 or b >= 128
            if keep or (raw and raw[-1] != 32):
                raw.append(b if keep else 32)
    if raw and text and not (97 <= (x := text[0].lower().encode()[0]) <= 122 or x >= 128):
        pass
    return collections.Counter(column(bytes(raw[i : i + k])) for k in range(1, langid.GRAM + 1) for i in range(len(raw) - k + 1))


def test_predictions_equal_cosines_by_plain_code(spark):
    rows = [r for r in duckdb.sql(f"select doc_id, text, lang from '{SMALL}/documents.parquet' where text is not null order by 1").fetchall()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.learn(df)
    count = {i: grams(t) for i, t, _ in rows}
    frequency = collections.Counter(c for x in count.values() for c in x)
    idf = {c: math.log((1 + len(rows)) / (1 + frequency[c])) + 1 for c in range(langid.DIM)}
    assert np.allclose(model["idf"], [idf[c] for c in range(langid.DIM)])
    got = {r.doc_id: r for r in langid.predict(df.select("doc_id", "text"), model).collect()}
    for i, _, _ in rows:
        x = {c: (1 + math.log(n)) * idf[c] for c, n in count[i].items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        near = [(sum(v * float(centre[c]) for c, v in x.items()) / size, lang) for centre, lang in zip(model["centre"], model["lang"], strict=True)] if size else [(0, "und")]
        assert got[i].lang_pred in {lang for s, lang in near if s > max(near)[0] - 1e-5} and got[i].score == pytest.approx(max(near)[0], abs=1e-5)
    # centroids have unit length and lie where their language is: a document's own mean is nearer than other languages'
    assert np.allclose(np.linalg.norm(model["centre"], axis=1), 1, atol=1e-5)


def test_sample_is_broadcast_and_repeated_ids_count_once(spark):
    rows = [(1, "alpha beta gamma", "en")] * 1000 + [(i, f"wort satz zeile nummer {i}", "de") for i in range(2, 30)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(model["lang"]) == {"en", "de"}


def lz78(raw):
    """Phrases of a text: the longest known one and a byte more."""
    known, out, at = set(), [], 0
    while at < len(raw):
        end = at + 1
        while raw[at:end] in known and end < len(raw):
            end += 1
        known.add(raw[at:end])
        out.append(raw[at:end])
        at = end
    return out


def minima(raw):
    out = [lzfingerprint.EMPTY] * lzfingerprint.BINS
    for phrase in lz78(raw):
        data = np.frombuffer(phrase, np.uint8)
        h = int(K.Hasher(data)(np.array([0]), np.array([len(data)]))[0])
        out[h % lzfingerprint.BINS] = min(out[h % lzfingerprint.BINS], h >> 48, lzfingerprint.EMPTY - 1)
    return out


def test_fingerprints_equal_plain_parsing(spark):
    got = {r.doc_id: r for r in QUERIES["op6_lz_fingerprint"](spark, SMALL).collect()}
    rows = texts()[::-1]
    for k, (i, t) in enumerate(rows):
        after, third = rows[(k + 1) % len(rows)][1], len(t) // 3
        own, edited, following = (minima(x.encode()) for x in (t, t[: len(t) - third] + after[:third], after))
        like = lambda a, b: (lambda full: sum(x == y for x, y in full) / len(full) if full else 1.0)([(x, y) for x, y in zip(a, b, strict=True) if (x, y) != (lzfingerprint.EMPTY,) * 2])
        assert got[i].fingerprint == "".join(f"{x:04x}" for x in own) and got[i].edited_fingerprint == "".join(f"{x:04x}" for x in edited)
        assert got[i].near_edited == pytest.approx(like(own, edited)) and got[i].near_next == pytest.approx(like(own, following))
    assert lz78(b"aaaaaa") == [b"a", b"aa", b"aaa"] and lz78(b"abab") == [b"a", b"b", b"ab"]


def test_token_ids_of_a_whole_table_equal_the_library(spark):
    import tiktoken

    path, pattern = bpe.public_vocabulary()
    e = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.Tokenizer(bpe.load_ranks(path), pattern).ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op4_byte_bpe"](spark, SMALL).collect()}
    for i, t in texts():
        ids = e.encode_ordinary(t)
        want = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


def hits(model, *docs):
    return [h for b in K.blocks(pa.array(docs)) for h in model.in_context(b)[1]]


def test_quotation_is_told_from_abuse_by_each_hits_own_window():
    m = toxicity.Matcher([("idiot", False), ("moron", False)], set())
    far = "word " * 20
    quoted = [q for *_, q, _ in hits(m, 'He said "you idiot" to them', 'You moron, "you idiot" indeed', f'You moron {far} he said "you idiot" there', f'"idiot" and "moron" were the words {far} "idiot" once more')]
    assert quoted == [True, False, False, False, True, True, True, True]


def test_scores_equal_plain_code(spark):
    """Hits by edit distance, windows and the regression, recomputed word by word."""
    import re

    rows = [(1, "you idiot, you idiot"), (2, 'she wrote "idiot" about it'), (3, "a plain text of words"), (4, ""), (5, "idi0t and m0ron " * 3)]
    model = {"terms": [("idiot", False), ("moron", False), ("achl", True)], "known": [], "strength": [2.0, 1.0, 3.0], "coef": [-1.0, 0.5, 0.2, 0.7, -0.3, 0.4]}
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    for i, t in rows:
        found = []
        words = t.split()
        for p, raw in enumerate(words):
            w = re.sub(r"^\W+|\W+$", "", raw.lower())
            near = [(distance(w, x), n) for n, (x, stem) in enumerate(model["terms"]) if not stem and distance(w, x) <= 1]
            if near:
                found.append((p, min(near)[1], min(near)[0], raw.count('"') == 2))
        total = []
        for p, n, k, q in found:
            excused = q and not any(abs(p - o) <= toxicity.WINDOW and not z for o, _, _, z in found)
            total.append(model["strength"][n] * (toxicity.MISSPELLED if k else 1) * (toxicity.QUOTED if excused else 1))
        s, n = sum(total), len(words)
        x = [1.0, min(s, 40) ** 0.5, min(100 * s / max(n, 1), 40) ** 0.5, math.log1p(len(total)), math.log1p(n) / 5, float(s >= 3)]
        assert got[i].hits == len(total) and got[i].score == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model["coef"], strict=True)))))


def test_blocks_hold_every_pair_of_different_components_once(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = [(1, 7, i, 0 if i < 20 else 20 + i % 4, 31, 11, 0) for i in range(31)]
    df = spark.createDataFrame(rows, "band int, value bigint, cid bigint, root bigint, members bigint, outside bigint, main bigint").withColumns({"n_shingles": F.lit(5), "sig": F.array(F.lit(1))})
    blocks = collections.defaultdict(list)
    for r in neardup._deal(df).collect():
        blocks[r.key].append((r.side, r.cid, r.root))
    met = collections.Counter()
    for own in blocks.values():
        left, right = [x for x in own if x[0] == 0], [x for x in own if x[0] == 1]
        for n, a in enumerate(left):
            met.update(frozenset((a[1], b[1])) for b in (right or left[n + 1 :]) if a[2] != b[2])
    root = {c: r for _, _, c, r, *_ in rows}
    want = {frozenset((a, b)) for a in root for b in root if a < b and root[a] != root[b]}
    assert met == collections.Counter(want)
    # a bucket of n classes with one outsider costs n rows and a part or two, not their square
    one = df.withColumn("root", F.when(F.col("cid") < 30, 0).otherwise(30)).withColumn("outside", F.lit(1))
    assert neardup._deal(one).count() == 30 + 10 + 1


def test_a_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), type("C", (), {"get": lambda self, k, d: d})()

    with pytest.raises(ValueError, match="checkpoint"):
        common.checkpoint_dir(Session())
