"""The ten queries and the pipeline over awkward rows, empty tables, and against brute force on small tables."""

import collections
import hashlib
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import bpe, linededup, lzfingerprint, mixing, neardup, pii, quality, tokencount, toxicity
from corpusloom.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
PROSE = " ".join(f"word{i % 47} of{i % 13} tale{i}" for i in range(40))
LONG = "x" * 150_000 + " 4111 1111 1111 1111 " + "a@b.cd " * 300
ROWS = [
    (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, "en", "b"), (3, None, "en", "a"), (4, "", None, "a"), (5, " \n\t\n ", "de", None), (6, LONG, "en", "a"),
    (7, PROSE + " end", "en", "a"), (None, "Null id, five words here now", "en", "a"), (None, None, None, None), (8, "é €😀 ok\nidiot +1 (555) 010-2000", "fr", "ü"), (9, "1.2.3.4 x@y.z\n" + PROSE + "\n" + PROSE, "en", "b"),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = {}
    for name, rows in (("odd", ROWS), ("none", [])):
        d = str(tmp_path_factory.mktemp(name))
        documents(spark, rows).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(r[0], 1, r[0] % 2) for r in rows if r[0]] , "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        out[name] = d
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_and_empty_tables(spark, tables, name):
    assert QUERIES[name](spark, tables["odd"]).count() == len(ROWS)
    assert QUERIES[name](spark, tables["none"]).count() == 0


def test_pipeline_on_odd_rows_and_clashing_columns(spark, tables):
    assert corpus_pipeline.run(spark, tables["none"]).count() == 0
    docs = documents(spark, ROWS)
    for c in ("n_words", "kept", "distance", "size", "hash", "doc", "part", "d0", "copies", "_text", "g1", "centre"):
        docs = docs.withColumn(c, F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables["odd"])
        assert out.columns == docs.columns, name
        assert out.filter("kept = 'clash' and size = 'clash'").count() == out.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "byte_bpe"]
    kept = {r.doc_id for r in neardup.neardup_stage(spark, docs, "").collect()}
    assert 1 in kept and 2 not in kept


def texts():
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{SMALL}/documents.parquet' order by 1").fetchall()


def test_quality_base_counts_equal_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op1_quality_mcd"](spark, SMALL).collect()}
    for i, t in texts():
        w, r = WORD.findall(t), got[i]
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r.base_failed and r.kept)


def test_quality_verdicts_follow_labels(spark):
    d = "/root/testdata/sf0.01"
    out = QUERIES["op1_quality_mcd"](spark, d).filter("not base_failed").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) == 0


def test_mcd_ignores_a_quarter_of_outliers():
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (300, 2)), rng.normal(30, 1, (80, 2))])
    centre, scatter = quality.mcd(np.ones(len(x)), x, np.einsum("ij,ik->ijk", x, x))
    assert np.abs(centre).max() < 0.3 and 0.6 < scatter[0, 0] < 1.6
    assert abs(quality.chi2_quantile(0.95, 5) - 11.0705) < 1e-3


def test_language_of_held_out_documents(spark):
    out = QUERIES["op2_language_centroids"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.filter("lang = lang_pred").count() >= 0.99 * out.count()


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(key, QUERIES["op3_mix_min_cost_flow"](spark, SMALL).select(*cols).collect())) == sorted(map(key, con.sql(f"select {', '.join(cols)} from ({ORACLE['op3_mix_min_cost_flow']})").fetchall()))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_each_oracle_is_sql_that_equals_its_query(spark, name):
    assert isinstance(ORACLE[name], str)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.sql(ORACLE[name])
    plain = lambda r: repr([round(x, 6) if isinstance(x, float) else x for x in r])
    got = QUERIES[name](spark, SMALL).select(*want.columns).collect()
    assert sorted(map(plain, got)) == sorted(map(plain, want.fetchall()))


def test_flow_is_maximal_and_repeats_least():
    # pattern 1 can serve both sources; taking it for the second leaves the first its own
    sent = mixing.flow([10, 10, 4], [[0], [0, 1], [1]], [15, 12], 2)
    assert sum(sum(s.values()) for s in sent) == 27
    assert sum(max(0, sum(s.values()) - c) for s, c in zip(sent, [10, 10, 4], strict=True)) == 3
    assert mixing.targets({"a": 10, "b": 100, None: 1}) == {"a": 20.0, "b": min(200.0, 144.5), None: 2.0}


def test_bpe_equals_the_library(spark):
    import tiktoken

    path, pattern = bpe.public_vocabulary()
    t = bpe.Tokenizer(bpe.load_ranks(path), pattern)
    e = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=t.ranks, special_tokens={})
    for x in ["", "a", "aaaa" * 500, "<|endoftext|>", " \n\n  x", "it's we'll", "é€😀" * 50, PROSE, "abab" * 3000]:
        ids = t.encode(x)
        assert ids == e.encode_ordinary(x) and t.decode(ids).decode() == x
    df = spark.createDataFrame([(1, PROSE), (2, None)], "doc_id bigint, text string")
    coded = bpe.encode(df, path, pattern)
    assert {r.doc_id: r.ids for r in coded.collect()} == {1: e.encode_ordinary(PROSE), 2: []}
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, path, pattern).collect()} == {1: PROSE.encode(), 2: b""}


def test_bpe_with_ranks_out_of_order():
    # a merge whose result has a lower rank than its parts must still be taken in time
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"bc": 300, b"abc": 5, b"ab": 400, b"cd": 350}
    t = bpe.Tokenizer(ranks, r"\S+")

    def plain(piece):
        parts = [bytes([x]) for x in piece]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for x in (b"abcd", b"bcbcabcd", b"aabbccdd" * 5, b"abcabcabab"):
        assert t.merge(x) == ([ranks[x]] if x in ranks else plain(x))


def test_line_dedup_equals_brute_force(spark):
    got = {r.doc_id: r.runs for r in QUERIES["op5_line_dedup"](spark, SMALL).collect()}
    seen = collections.defaultdict(list)
    seqs = {i: [(x, len(WORD.findall(x))) for x in t.split("\n") if WORD.search(x)] for i, t in texts()}
    for i, s in sorted(seqs.items()):
        mark = [False] * len(s)
        for p in range(len(s)):
            best = 0
            for j, q in seen[s[p][0]]:
                k = 0
                while p + k < len(s) and q + k < len(seqs[j]) and s[p + k][0] == seqs[j][q + k][0]:
                    k += 1
                best = max(best, k)
            if sum(n for _, n in s[p : p + best]) >= linededup.MIN_WORDS:
                mark[p : p + best] = [True] * best
            seen[s[p][0]].append((i, p))
        found = [False] * len(s)
        for a, n in (map(int, x.split(":")) for x in got[i].split(",") if x):
            found[a : a + n] = [True] * n
        assert found == mark, i


def test_line_dedup_deletes_later_runs_with_blank_lines_between(spark):
    block = PROSE + "\n\n" + PROSE[::-1]
    df = spark.createDataFrame([(1, f"a\n{block}\nb"), (2, f"c\n{block}\n\nd"), (3, "short\nshort")], "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in linededup.delete_lines(df, linededup.deletions(df)).collect()}
    assert out == {1: f"a\n{block}\nb", 2: "c\n\nd", 3: "short\nshort"}


def test_fingerprints_equal_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op6_lz_fingerprint"](spark, SMALL).collect()}
    rows = texts()[::-1]
    for k, (i, t) in enumerate(rows):
        n, third = rows[(k + 1) % len(rows)][1], len(t) // 3
        edited = t[: len(t) - third] + n[:third]
        f, g = lzfingerprint.fingerprint_text(t), lzfingerprint.fingerprint_text(edited)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g)
        assert abs(r.near_edited - lzfingerprint.compare(f, g)) < 1e-9 and abs(r.near_next - lzfingerprint.compare(f, lzfingerprint.fingerprint_text(n))) < 1e-9
    assert lzfingerprint.compare(lzfingerprint.fingerprint_text(""), lzfingerprint.fingerprint_text("")) == 1.0


def shingle_set(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
    return frozenset(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_duplicates_equal_brute_force(spark):
    # a chain of copies with growing changes, next to the small table
    words = PROSE.split()
    chain = [(10_000 + i, " ".join(words[: 100 - 0] + [f"new{i}{j}" for j in range(i)] + words[100:])) for i in range(12)]
    rows = texts() + chain + [(20_000, "one two"), (20_001, "One two"), (20_002, "")]
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in neardup.near_duplicates(df).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_near_copies_take_no_other_text_of_their_id_along(spark):
    other = " ".join(f"apple{i} pear{i}" for i in range(30))
    third = " ".join(f"stone{i} wood{i}" for i in range(30))
    rows = [(1, PROSE), (None, PROSE + " end"), (None, third), (5, PROSE + " fin"), (5, other), (9, other + " end")]
    out = neardup.neardup_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert out.columns == ["doc_id", "text"]
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, third), (1, PROSE), (5, other)]


def test_blocks_find_links_that_no_star_has(spark, monkeypatch):
    """With tiny blocks, buckets are cut and every pair of parts still meets."""
    monkeypatch.setattr(neardup, "BLOCK", 2)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 57 - i % 3] + [f"q{i}{j}" for j in range(i % 4)])) for i in range(14)]
    out = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(out.values()) == {0}


def test_estimate_is_corrected_for_chance():
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    mixed = np.concatenate([a, b])
    sig = neardup.registers(np.concatenate([a, b, a[:2500], b[:2500], mixed[:0]]), np.array([0, 5000, 10000]))
    share = (sig[0] == sig[1]).mean()
    assert neardup.estimate(np.array([share]), np.array([5000]), np.array([5000]))[0] < 0.05
    assert 0 < neardup.chance(np.array([5000]), np.array([5000]))[0] < 0.01


def test_token_trees_equal_counting_anew(spark):
    import random

    c = tokencount.counter(*bpe.public_vocabulary())
    random.seed(5)
    bits = ["'re", "  ", "\n", "x", "É ", "12", " 's", "%%%", "", " word", "\t \n a", "'"]
    for x in ["", "a", " \n \n x", "'r'e's '' 're", PROSE, PROSE * 3]:
        tree, now = tokencount.TokenTree(c, x), x
        for _ in range(25):
            a = random.randint(0, len(now))
            b, new = a + random.choice([0, 1, 5, 60]), "".join(random.choices(bits, k=random.choice([1, 3, 30])))
            now = now[:a] + new + now[b:]
            tree.edit(a, b, new)
            assert tree.text() == now and tree.total == len(c.encode(now)) and tree.chars == len(now)
    big = tokencount.TokenTree(c, PROSE * 200)
    big.edit(9000, 9003, "ZZ")
    assert big.recoded < 100
    df = spark.createDataFrame([(1, PROSE, [(0, 4, "Word"), (7, 7, "!")]), (2, None, None)], f"doc_id bigint, text string, edits {tokencount.EDITS}")
    args = bpe.public_vocabulary()
    kept = tokencount.trees(df, *args)
    after = {r.doc_id: r for r in tokencount.apply_edits(kept, *args).collect()}
    once = {r.doc_id: r for r in tokencount.count_edits(df, *args).collect()}
    edited = "Word" + PROSE[4:7] + "!" + PROSE[7:]
    assert after[1].text == edited and after[1].n_tokens == once[1].n_tokens_after == len(c.encode(edited)) and after[2].n_tokens == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def test_entities_equal_brute_force(spark):
    odd = ["a@b.cd_x@e.fg", "x@" + ".a" * 20000, "1.2.3.4.5.6.7.8", "999.1.1.1 001.02.3.255", "4111 1111-1111 1111 1", "+1 (((", "+1 (555) 010-2000 +49 30", "é a.b@c-d.e €", "9" * 300, "a@b..c a@b.c.", LONG, "7 7 " * 900]
    rows = texts() + [(90_000 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find_entities(df).collect()}
    for i, t in rows:
        for kind, p in PATTERNS.items():
            want = [(m.start(), m.end(), m[0]) for m in re.finditer(p, t) if valid(kind, m[0])]
            assert [(x.s, x.e, x.v) for x in got[i][kind]] == want, (i, kind)


def test_terms_that_reveal_an_entity_are_found_and_generalised(spark):
    common = "the report of the day says that nothing much has changed"
    rows = [(i, f"{common} case{i} Zorblax wrote ann@mail.org today") for i in range(5)] + [(100 + i, f"{common} number{i}") for i in range(200)] + [(999, f"{common} said Zorblax again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [x.v.lstrip("-") for x in r.term] for r in pii.find_personal_data(df).collect()}
    assert "Zorblax" in found[0] and "Zorblax" in found[999] and found[100] == [] and "report" not in found[0]
    out = {r.doc_id: r.sanitised for r in pii.sanitise(df).collect()}
    assert "ann@mail.org" not in out[0] and "[EMAIL]" in out[0] and "Zorblax" not in out[999] and out[100] == f"{common} number0"


def test_copies_of_a_text_hide_no_disclosing_term(spark):
    rows = [(i, f"tale{i} quillfeather writes from quill@example.org on day{i}") for i in range(3)]
    rows += [(100 + i, rows[0][1]) for i in range(300)] + [(1000 + i, f"plain words of text{i}") for i in range(400)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"))
    marked = {r.doc_id for r in found.collect() if any(x.v.lstrip("-") == "quillfeather" for x in r.term)}
    assert marked == {0, 1, 2, *range(100, 400)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        row = _next(row, a, i, b)
    return row[-1]


def _next(row, a, i, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a[i - 1] != y)))
    return new


def test_automaton_equals_edit_distance():
    import random

    random.seed(2)
    terms = [("idiot", False), ("moron", False), ("worthless", False), ("disgusting", False), ("achl", True), ("abc", False)]
    auto = toxicity.Automaton(terms)
    words = ["idiot", "idi0t", "idot", "xmoron", "wrthles", "disgustng", "achlx", "achl", "ab", "abc", "", "diisgustinng"]
    for t, _ in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(random.randint(0, 3)):
                k = random.randint(0, len(w))
                w[k : k + random.randint(0, 1)] = random.choices("abcdiort", k=random.randint(0, 1))
            words.append("".join(w))
    for w in words:
        want = {(i, distance(w, t)) for i, (t, stem) in enumerate(terms) if not stem and distance(w, t) <= auto.errors(t, stem)}
        want |= {(i, 0) for i, (t, stem) in enumerate(terms) if stem and w.startswith(t) and len(w) > len(t)}
        assert set(auto.match(w)) == want, w


def test_matching_filters_lose_nothing():
    import pyarrow as pa

    from corpusloom.llm import textkernel as K

    terms = [("idiot", False), ("worthless", False), ("achl", True)]
    m = toxicity.Matcher(terms, set())
    text = 'You IDIOT, "idi0t!" worthles... Achlung (idot) idiotic xachl worthlessss'
    (b,) = K.blocks(pa.array([text]))
    found = [(i, k, w.decode()) for _, i, k, _, w in m.hits(b)[1]]
    assert found == [(0, 0, "idiot"), (0, 1, "idi0t"), (1, 1, "worthles"), (2, 0, "achlung"), (0, 1, "idot"), (1, 2, "worthlessss")]
    assert [q for *_, q, _ in m.hits(b)[1]][1]


def test_filter_keeps_edits_of_letters_beyond_ascii():
    import random

    import pyarrow as pa

    from corpusloom.llm import textkernel as K

    random.seed(5)
    names = ["idiot", "blöde", "crétin", "estúpido", "дурак", "worthless"]
    m = toxicity.Matcher([(t, False) for t in names], set())
    words = ["idiót", "blode", "cretin", "estupido", "idi\u043et", "dурак", "idiot😀x"]
    for t in names:
        for _ in range(80):
            w = list(t)
            for _ in range(random.randint(1, 2)):
                k = random.randint(0, len(w))
                w[k : k + random.randint(0, 1)] = random.choices("aioéöúßжо語😀", k=random.randint(0, 1))
            words.append("".join(w))
    found = {w.decode(): (i, k) for b in K.blocks(pa.array([" ".join(words)])) for _, i, k, _, w in m.hits(b)[1]}
    for w in words:
        near = [(distance(w, t), -len(t), i) for i, t in enumerate(names) if distance(w, t) <= toxicity.Automaton.errors(t, False)]
        if w[0] != "😀" and w[-1] != "😀":
            assert (w in found) == bool(near) and (not near or found[w] == (min(near)[2], min(near)[0])), w


def test_words_between_any_marks_and_of_any_length_match():
    import pyarrow as pa

    from corpusloom.llm import textkernel as K

    m = toxicity.Matcher([("idiot", False), ("achl", True), ("crétin", False), ("x" * 1500, False)], set())
    words = ["idiot" + "!" * 20, "?" * 300 + "idiot", "“idiot”", "idiot…", "«idiot»😀", "achl" + "y" * 500, "“crétin”", "cre\u0301tin…", "!!!", "…", "\u0301", "x" * 1500, "idiet…„", "„idaot”"]
    column = pa.array([*words, None, "", "…idiot", "\u0301idiot"])
    hits = [(d + b.rows.start, i, k) for b in K.blocks(column) for d, i, k, _, _ in m.hits(b)[1]]
    assert hits == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0), (6, 2, 0), (11, 3, 0), (12, 0, 1), (13, 0, 1), (16, 0, 0), (17, 0, 0)]
    # a text's hits don't depend on its neighbours
    alone = [(n, i, k) for n, t in enumerate(column) for b in K.blocks(pa.array([t.as_py()], pa.string())) for _, i, k, _, _ in m.hits(b)[1]]
    assert alone == hits


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    out = QUERIES["op10_toxicity"](spark, d).filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    hit = sum(r.toxic and r.predicted for r in out)
    assert hit >= 0.85 * sum(r.toxic for r in out) and sum(r.predicted and not r.toxic for r in out) <= 0.05 * max(hit, 1)


def test_scores_are_bounded_and_empty_texts_have_one(spark, tables):
    for r in QUERIES["op10_toxicity"](spark, tables["odd"]).collect():
        assert 0 <= r.score <= 1 and r.predicted in (0, 1)


def test_checkpoints_go_to_the_shared_folder(spark):
    from corpusloom.llm import common

    where = spark.conf.get("spark.checkpoint.dir")
    kept = common.cut(spark.range(3))
    assert kept.loom_path.startswith(where) and kept.count() == 3
    common.drop(kept)
    assert not os.path.exists(kept.loom_path.removeprefix("file://"))
