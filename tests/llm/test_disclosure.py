"""Disclosure values against a plain count over texts, and what copies, spelling and other words change."""

import collections
import math
import re

import duckdb
import pytest
import regex

from corpusloom.llm import pii
from corpusloom.llm.common import cut

from test_queries import PATTERNS, SMALL, valid

WORD = regex.compile(r"(?<![^\s\"'“”„«»‘’(\[{])\p{L}[\p{L}\p{M}]*+(?:['’-][\p{L}\p{M}]++)*+(?=[.,;:!?…\"'“”«»‘’)\]}]*+(?:\s|$))")


def secret(v):
    n = collections.Counter(v)
    bits = -sum(k * math.log2(k / len(v)) for k in n.values())
    return len(re.findall("[0-9]+", v)) >= 3 and sum(c.isalpha() for c in v) >= 3 and bits >= 60


def spans(t):
    out = [(k, m.start(), m.end(), m[0]) for k, p in PATTERNS.items() for m in re.finditer(p, t) if valid(k, m[0])]
    return out + [("secret", m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9_]+", t) if len(m[0]) >= 20 and secret(m[0])]


def names(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "email":
        local, domain = v.lower().split("@")
        return {"email", f"email:{v.lower()}", f"email:@{domain}", "email:=" + re.sub("[^a-z]", "", local)}
    if kind == "ip":
        return {"ip", f"ip:{v}", "ip:/" + v.rsplit(".", 1)[0]}
    more = {"card": [d, "/" + d[:6]], "phone": [d, "/" + d[:-4]], "secret": [v]}[kind]
    return {kind, *(f"{kind}:{x}" for x in more)}


def beside(t, s, e):
    """Words wholly within the window; one that its edge cuts is none."""
    c = pii.CONTEXT
    left, right = t[max(s - c, 0) : s], t[e : e + c]
    left = re.sub(r"^\S+", "", left) if s > c else left
    right = re.sub(r"\S+$", "", right) if e + c < len(t) else right
    return {w for x in (left, right) for w in WORD.findall(x.lower()) if len(w) >= pii.SHORTEST}


def by_hand(texts, least):
    n_e, n_et, n_t = collections.Counter(), collections.Counter(), collections.Counter()
    texts = set(texts)
    for t in texts:
        pairs, entities = set(), set()
        for kind, s, e, v in spans(t):
            own, near = names(kind, v), beside(t, s, e)
            entities |= own
            pairs |= {(x, w) for x in own for w in near}
        n_e.update(entities)
        n_et.update(pairs)
        n_t.update(set(WORD.findall(t.lower())))
    out = {}
    for (x, w), n in n_et.items():
        if n >= pii.SUPPORT and n_t[w]:
            p = n_e[x] / (len(texts) + 1)
            d = 1 - math.log(min((n + p) / (n_t[w] + 1), 1)) / math.log(p)
            if d >= least:
                out[w] = max(d, out.get(w, -9))
    return out


def measured(spark, rows, least):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = cut(pii.find_entities(df))
    return {r.term: r.disclosure for r in pii.disclosing_terms(df, found, least)[0].collect()}


def test_disclosures_equal_counting_by_hand(spark):
    rows = duckdb.sql(f"select doc_id, coalesce(text, '') from '{SMALL}/documents.parquet' order by 1").fetchall()
    who = ["Quill", "Zorblax", "d'Arcy-Lee", "Müller", "naïve"]
    for i in range(60):
        name, key = who[i % 5], "".join("0123456789abcdef"[(i * 7 + k * k * (i + 3)) % 16] for k in range(32))
        rows.append((50_000 + i, f"Report {i} says “{name}” ({name.upper()}), {'mere filler ' * (i % 4)}writes from {name[:2].lower()}{i % 3}@mail{i % 2}.example.org or +1 (555) 01{i % 3}-2000; " + "and so on " * (i % 30) + f"token = {key} from 10.0.{i % 2}.{i % 9} {name}"))
    rows += [(60_000 + i, f"nothing here but {w} and mail") for i, w in enumerate(who)] + [(70_000, rows[-20][1])]
    for least in (0.2, 0.6):
        want, got = by_hand([t for _, t in rows], least), measured(spark, rows, least)
        assert got.keys() == want.keys() and len(want) > 5
        assert all(got[w] == pytest.approx(want[w], abs=1e-9) for w in want)


def test_copies_and_group_names_leave_disclosures_alone(spark):
    """Five texts with five addresses of one domain; copies of one of them change nothing."""
    rows = [(i, f"tale{i} quillfeather writes from quill{i}@example.org on day{i}") for i in range(5)]
    rows += [(1000 + i, f"plain words of text{i}") for i in range(400)]
    few = measured(spark, rows, pii.DISCLOSED)
    many = measured(spark, [*rows, *((2000 + i, rows[0][1]) for i in range(50))], pii.DISCLOSED)
    assert few == many and "quillfeather" in few and "plain" not in few


def test_parts_of_mentions_are_no_terms(spark):
    rows = [(i, f"some text{i} at ann.lee@mail.example.org ends") for i in range(30)] + [(100 + i, "an example of mail by Ann Lee") for i in range(30)]
    assert not {"example", "mail", "ann", "lee", "org"} & measured(spark, rows, 0.1).keys()


def test_dense_texts_and_odd_edges(spark):
    dense = "a1@b.cd " * 20_000 + "zebra"
    rows = [(1, dense), (2, ""), (3, None), (4, "1.2.3.4"), (5, "x" * 119 + " 1.2.3.4" + " y" * 200), (6, "😀" * 130 + " Zed 9.9.9.9")]
    out = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(out[1].email) == 20_000 and out[1].term == [] and out[3].ip == [] and [x.s for x in out[6].ip] == [135]
