"""Personal data by information-theoretic sanitisation, in DataFrame functions only.

Protected entities are what five patterns find: mail and IP addresses, card and phone numbers, and secrets
(long strings of letters and digits that mix and hold ``SECRET_BITS`` bits by their own characters' frequencies).
Each mention names several entities: its kind, its value, and the groups it belongs to (a mail domain and holder,
a network, a card's issuer, a phone's exchange).  Terms, free-standing words beside a mention, may reveal
an entity even where it is removed.  How strongly is estimated from the corpus: with p(e) the share of
distinct texts that hold entity e, and p(e|t) = (n_et + p(e)) / (n_t + 1) the share, smoothed by one text that
is like any other, of the n_t texts with term t in which t stands beside e, the disclosure of e by t is
PMI(e, t) / IC(e) = 1 - log p(e|t) / log p(e): the share of e's information content that t gives away.
A term whose disclosure of some entity is at least ``DISCLOSED`` is generalised to a label, from ``REMOVED`` on
removed, wherever it stands.

Beside means wholly within ``CONTEXT`` code points of a mention, on either side; that is what co-occurrence is
here, so a name that stands further away is not found.  Terms have ``SHORTEST`` code points or more, and have to
stand beside an entity in ``SUPPORT`` distinct texts.  A word that is part of a mention is no term.

Scale.  One pass finds entities; all that follows is narrow.  Numbers of texts count exact copies once.  A bound
that needs no text drops nearly all terms first: texts that hold t near any entity already limit
p(e|t) from above.  Only what is left is counted over all documents, through a join that is broadcast
if a count allows it.  Groups are partially aggregated; nothing is collected.  A text is cut into pieces once,
and each mention looks at four of them, so very many mentions cost no more than their number.

Defined results: null text counts as empty.  Positions are code points, end exclusive.  Rows that agree
in doc_id and text get the same spans.  Term spans that touch an entity are dropped, the entity stays.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, drop, join_small, table

#: The contract's patterns, with possessive repeats where nothing can be given back, and look-behinds
#: that keep a failed start from being tried again at each later character of the same run.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+",
}
BASE = ("email", "ip", "card", "phone")
#: What a text must hold for its pattern to be tried.
NEEDS = {"email": "contains(t, '@')", "ip": "t rlike '[0-9][.][0-9]'", "card": "t rlike '[0-9]'", "phone": "contains(t, '+')", "secret": "t rlike '(?<![A-Za-z0-9_])[A-Za-z0-9_]{20}'"}
VALID = {
    "email": "true",
    "ip": "forall(split(x.v, '[.]'), p -> coalesce(try_cast(p as bigint), 999) <= 255)",
    "card": "length(digits(x.v)) between 13 and 19 and luhn(x.v)",
    "phone": "length(digits(x.v)) between 9 and 15",
    "secret": "size(regexp_extract_all(x.v, '[0-9]+', 0)) >= 3 and length(regexp_replace(x.v, '[^A-Za-z]', '')) >= 3 and bits(x.v) >= SECRET_BITS",
}
#: Entities that a mention x names, besides its kind.
NAMES = {
    "email": "lower(x.v), concat('@', lower(substring_index(x.v, '@', -1))), concat('=', regexp_replace(lower(substring_index(x.v, '@', 1)), '[^a-z]', ''))",
    "ip": "x.v, concat('/', substring_index(x.v, '.', 3))",
    "card": "digits(x.v), concat('/', left(digits(x.v), 6))",
    "phone": "digits(x.v), concat('/', left(digits(x.v), length(digits(x.v)) - 4))",
    "secret": "x.v",
}
#: A word between blanks, with nothing but marks of quotation, brackets and punctuation on its sides.
TERM = r"(?<![^\s\"'“”„«»‘’(\[{])[\p{L}\p{M}]++(?:['’-][\p{L}\p{M}]++)*+(?=[.,;:!?…\"'“”«»‘’)\]}]*+(?:\s|$))"
CONTEXT, SUPPORT, DISCLOSED, REMOVED, SHORTEST = 120, 3, 0.9, 0.98, 4
SECRET_BITS = 60
SALTS = 16
CHUNK = 256
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "secret": "[SECRET]", "term": "[TERM]"}


def _sql(text: str) -> str:
    """Spell out the shorthands digits(x), luhn(x) and bits(x), the information content of a string by its own characters' frequencies."""
    digits = "regexp_replace({0}, '[^0-9]', '')"
    d = digits.format("x.v")
    at = f"cast(substring({d}, length({d}) - i, 1) as int)"
    luhn = f"aggregate(sequence(0, length({d}) - 1), 0, (s, i) -> s + CASE WHEN i % 2 = 0 THEN {at} WHEN {at} > 4 THEN 2 * {at} - 9 ELSE 2 * {at} END) % 10 = 0"
    signs = ", ".join(repr(c) for c in string.ascii_letters + string.digits + "_")
    bits = f"aggregate(filter(transform(array({signs}), c -> length(x.v) - length(replace(x.v, c, ''))), k -> k > 0), 0D, (a, k) -> a - k * log2(k / length(x.v)))"
    return text.replace("luhn(x.v)", luhn).replace("digits(x.v)", d).replace("bits(x.v)", bits).replace("SECRET_BITS", str(SECRET_BITS))


def located(text: str, pattern: str) -> Column:
    """Array of (s, e, v): start, end and value of each match of pattern in a column.

    Starts are running sums of the lengths between and of the matches, in chunks of CHUNK, so that a
    text with very many matches doesn't cost their square.
    """
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    pairs = f"zip_with(slice(split({text}, '{p}', -1), 1, size(regexp_extract_all({text}, '{p}', 0))), regexp_extract_all({text}, '{p}', 0), (g, v) -> struct(length(g) as g, length(v) as n, v as v))"
    step = "(a, x) -> struct(a.at + x.g + x.n as at, concat(a.out, array(struct(a.at + x.g as s, a.at + x.g + x.n as e, x.v as v))) as out)"
    none = "cast(array() as array<struct<s:int,e:int,v:string>>)"
    small = f"aggregate(m, struct(0 as at, {none} as out), {step}).out"
    chunks = f"transform(sequence(0, cast((size(m) - 1) div {CHUNK} as int)), c -> slice(m, c * {CHUNK} + 1, {CHUNK}))"
    total = "aggregate(k, 0, (a, x) -> a + x.g + x.n)"
    begins = f"aggregate(transform({chunks}, k -> {total}), struct(0 as at, cast(array() as array<int>) as out), (a, n) -> struct(a.at + n as at, concat(a.out, array(a.at)) as out)).out"
    large = f"flatten(zip_with({chunks}, {begins}, (k, b) -> aggregate(k, struct(b as at, {none} as out), {step}).out))"
    return F.expr(f"transform(array({pairs}), m -> CASE WHEN size(m) <= {CHUNK} THEN {small} ELSE {large} END)[0]")


def find_entities(df: DataFrame, text: str = "text") -> DataFrame:
    """df with h (hash of the text) and one array of (s, e, v) per kind, named after it."""
    keep = df.columns
    out = df.withColumn("t", F.coalesce(F.col(text), F.lit(""))).withColumn("h", F.xxhash64(text))
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    for kind, pattern in PATTERNS.items():
        found = F.expr(f"filter(raw, x -> {_sql(VALID[kind])})")
        out = out.withColumn("raw", F.when(F.expr(NEEDS[kind]), located("t", pattern)).otherwise(none)).withColumn(kind, F.when(F.size("raw") > 0, found).otherwise(none))
    return out.select(*keep, "h", *PATTERNS, "t")


def _named(kind: str) -> str:
    """Mentions of a kind as (entities, s, e)."""
    names = f"array_distinct(concat(array('{kind}'), transform(array({_sql(NAMES[kind])}), n -> concat('{kind}:', n))))"
    return f"transform({kind}, x -> struct({names} as entities, x.s as s, x.e as e))"


def mentions(found: DataFrame) -> DataFrame:
    """(h, entities, terms): per mention, the entities it names and the distinct terms wholly within CONTEXT code points of it."""
    c = CONTEXT
    # the text in pieces of CONTEXT code points: what stands beside a mention lies in two of them on either side
    piece = lambda i: f"coalesce(get(z.g, {i}), '')"
    before, after = f"concat({piece(f'm.s div {c} - 1')}, {piece(f'm.s div {c}')})", f"concat({piece(f'm.e div {c}')}, {piece(f'm.e div {c} + 1')})"
    until = f"(m.s % {c} + CASE WHEN m.s >= {c} THEN {c} ELSE 0 END)"
    left = f"substring({before}, greatest({until} - {c}, 0) + 1, least({until}, {c}))"
    right = f"substring({after}, m.e % {c} + 1, {c})"
    # a word that the window cuts is none
    left = f"CASE WHEN m.s > {c} THEN regexp_replace({left}, '^\\\\S+', '') ELSE {left} END"
    right = f"CASE WHEN m.e + {c} < z.n THEN regexp_replace({right}, '\\\\S+$', '') ELSE {right} END"
    every = f"concat({', '.join(map(_named, PATTERNS))})"
    beside = f"transform(array(struct(regexp_extract_all(t, '(?s).{{1,{c}}}', 0) as g, length(t) as n)), z -> transform({every}, m -> struct(m.entities as entities, {left} as l, {right} as r)))[0]"
    each = found.filter(" or ".join(f"size({k}) > 0" for k in PATTERNS)).select("h", F.explode(F.expr(beside)).alias("m"))
    terms = lambda side: F.regexp_extract_all(F.lower(f"m.{side}"), F.lit(TERM), F.lit(0))
    return each.select("h", "m.entities", F.array_distinct(F.filter(F.concat(terms("l"), terms("r")), lambda x: F.length(x) >= SHORTEST)).alias("terms"))


def disclosures(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, term, n_et, n_e, n_near, total) of each pair with enough support, and (h, entities, terms) per mention, both written."""
    near = cut(mentions(found))
    pairs = near.select("h", F.explode("entities").alias("entity"), "terms").select("h", "entity", F.explode("terms").alias("term")).distinct()
    by_entity = near.select("h", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= SUPPORT)
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= SUPPORT)
    around = near.select("h", F.explode("terms").alias("term")).distinct().groupBy("term").agg(F.count("*").alias("n_near")).filter(F.col("n_near") >= SUPPORT)
    total = found.select("h").distinct().count()
    # a kind, or a common word, has many rows: either is dealt over SALTS keys
    salted = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    counted = both.withColumn("salt", by("term")).join(salted(by_entity), ["entity", "salt"]).withColumn("salt", by("entity")).join(salted(around), ["term", "salt"])
    return cut(counted.select("entity", "term", "n_et", "n_e", "n_near", F.lit(total).alias("total"))), near


def disclosure(n_t: str) -> Column:
    """Share of an entity's information content that a term in n_t texts gives away."""
    p = F.col("n_e") / (F.col("total") + 1)
    return 1 - F.log(F.least((F.col("n_et") + p) / (F.col(n_t) + 1), F.lit(1.0))) / F.log(p)


def disclosing_terms(docs: DataFrame, found: DataFrame, least: float = DISCLOSED) -> tuple[DataFrame, DataFrame]:
    """(term, disclosure), and the documents (doc_id, h, term) that hold one.

    found is the written result of find_entities on docs (doc_id, text).
    """
    pairs, near = disclosures(found)
    candidates = cut(pairs.filter(disclosure("n_near") >= least).drop("n_near"))
    wanted = candidates.select("term").distinct()
    words = docs.select("doc_id", F.xxhash64("text").alias("h"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    holders = cut(join_small(words, wanted, ["term"], "left_semi") if candidates.limit(1).count() else words.limit(0))
    counts = holders.select("term", "h").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    terms = candidates.join(counts, "term").withColumn("d", disclosure("n_t")).groupBy("term").agg(F.max("d").alias("disclosure"))
    terms = cut(terms.filter(F.col("disclosure") >= least))
    drop(near, pairs, candidates)
    return terms, holders


def term_spans(docs: DataFrame, terms: DataFrame, holders: DataFrame) -> DataFrame:
    """(doc_id, h, term): spans (s, e, v) of disclosing terms in each document that holds any; v is the term, "-" before one to remove."""
    marked = holders.join(terms, "term").groupBy("doc_id", "h").agg(F.collect_set(F.struct("term", "disclosure")).alias("own"))
    marked = marked.select(F.col("doc_id").alias("id_"), F.col("h").alias("h_"), F.map_from_entries("own").alias("own"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    small = marked.limit(20_001).count() <= 20_000
    marked = F.broadcast(marked) if small else marked
    rows = keyed.join(marked, keyed["doc_id"].eqNullSafe(marked["id_"]) & (keyed["h"] == marked["h_"]))
    rows = rows.withColumn("all", located("text", TERM))
    spans = F.expr(f"transform(filter(all, x -> own[lower(x.v)] is not null), x -> struct(x.s as s, x.e as e, concat(CASE WHEN own[lower(x.v)] >= {REMOVED} THEN '-' ELSE '' END, x.v) as v))")
    return rows.select("doc_id", "h", spans.alias("term")).dropDuplicates(["doc_id", "h"])


def find_personal_data(docs: DataFrame, least: float = DISCLOSED) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, h, the spans (s, e, v) of each kind in PATTERNS, and of terms."""
    narrow = docs.select("doc_id", "text")
    found = cut(find_entities(narrow).withColumn("t", F.when(F.expr(" or ".join(f"size({k}) > 0" for k in PATTERNS)), F.col("t"))).drop("text"))
    terms, holders = disclosing_terms(narrow, found, least)
    base = found.drop("t")
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    if not terms.limit(1).count():
        return base.withColumn("term", none)
    spans = cut(term_spans(narrow, terms, holders))
    drop(holders, terms)
    out = join_small(base, spans, ["doc_id", "h"])
    entities = F.concat(*[F.col(k) for k in PATTERNS])
    clear = F.filter("term", lambda x: ~F.exists(entities, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))
    return out.withColumn("term", F.coalesce(clear, none))


def sanitise(docs: DataFrame, text: str = "text", out: str = "sanitised") -> DataFrame:
    """docs (doc_id, text, ...) with each text in which spans are replaced by labels, or removed.

    Entities that overlap are replaced from left to right; what remains of a later one stays as a label.
    """
    spans = find_personal_data(docs.select("doc_id", F.col(text).alias("text"))).dropDuplicates(["doc_id", "h"])
    label = lambda k: f"transform({k}, x -> struct(x.s as s, x.e as e, {"CASE WHEN startswith(x.v, '-') THEN '' ELSE '[TERM]' END" if k == 'term' else repr(LABELS[k])} as l))"
    every = F.expr(f"array_sort(concat({', '.join(label(k) for k in (*PATTERNS, 'term'))}))")
    spans = spans.select(F.col("doc_id").alias("id_"), F.col("h").alias("h_"), every.alias("spans_")).filter("size(spans_) > 0")
    keyed = docs.join(spans, docs["doc_id"].eqNullSafe(spans["id_"]) & (F.xxhash64(docs[text]) == spans["h_"]), "left")
    step = "(a, x) -> CASE WHEN x.s < a.at THEN struct(greatest(a.at, x.e) as at, concat(a.out, x.l) as out) ELSE struct(x.e as at, concat(a.out, substring(t_, a.at + 1, x.s - a.at), x.l) as out) END"
    done = f"aggregate(spans_, struct(0 as at, '' as out), {step}, a -> concat(a.out, substring(t_, a.at + 1)))"
    replaced = keyed.withColumn("t_", F.col(text)).withColumn("new_", F.when(F.col("spans_").isNull(), F.col(text)).otherwise(F.expr(done)))
    return replaced.select(*[F.col(c) for c in docs.columns if c != out], F.col("new_").alias(out))


def _joined(kinds: list[str]) -> Column:
    return F.array_join(F.concat(*[F.expr(f"transform({k}, x -> concat('{k}:', x.s, ':', x.e))") for k in kinds]), ",")


def op9_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = [*PATTERNS, "term"]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(list(BASE)), 256).alias("base_sha256"),
        _joined(kinds).alias("spans"),
        F.size("secret").cast("long").alias("n_secret"),
        F.size("term").cast("long").alias("n_term"),
        sum((F.size(k) for k in kinds), F.lit(0)).cast("long").alias("n_spans"),
    )
