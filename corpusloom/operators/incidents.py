"""Incidents: cue filters, kinds and places, evidence spans, grouping with lifecycles."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..functions import timefn as T
from .windows import islands


def canonical_kind(kind: Column) -> Column:
    """kind of an incident by the first pattern that matches; else the kind as it is."""
    raw = F.lower(F.trim(F.coalesce(kind, F.lit(""))))
    out = None
    for pattern, name in fixed.KINDS:
        out = F.when(raw.rlike(pattern), name) if out is None else out.when(raw.rlike(pattern), name)
    return out.otherwise(raw)


def state_of(place: Column) -> Column:
    """F16: postal code at the end of a place, or null."""
    return F.upper(F.nullif(F.regexp_extract(F.coalesce(place, F.lit("")), r",\s*([A-Za-z]{2})\.?\s*$", 1), F.lit("")))


def district_label(place: Column, district: Column) -> Column:
    """F16: place with the district behind it if both name the same state."""
    own = F.upper(F.split(F.coalesce(district, F.lit("")), "-")[0])
    return F.when(state_of(place) == own, F.concat(place, F.lit(" · "), district)).otherwise(place)


def place_reason(place: Column) -> Column:
    """Why a place can't locate an incident, or null."""
    raw = F.trim(F.coalesce(place, F.lit("")))
    head = F.lower(F.trim(F.regexp_replace(raw, r",\s*[A-Za-z]{2}\.?\s*$", "")))
    norm = F.trim(F.regexp_replace(head, "[^a-z]+", " "))
    state = state_of(raw)
    names = F.create_map(*[F.lit(x) for kv in fixed.STATE_NAMES.items() for x in kv])
    vague = norm.rlike(r"\b(unspecified|unknown|not specified|n a|tbd|unclear)\b") | norm.rlike("^(the )?(district|statewide|nationwide|national|state|country)$")
    whole = F.coalesce(F.try_element_at(names, state) == norm, F.lit(False)) & ~((state == "NY") & (norm == "new york"))
    bare = state.isNull() & norm.isin(*fixed.STATE_NAMES.values()) & ~norm.isin("new york", "washington")
    return F.when(raw == "", "no place").when((norm == "") | vague, "no place named").when(whole | bare, "place is a whole state")


def _any(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def cue_reason(text: Column) -> Column:
    """Struct of reason and cue for a text that shouldn't open an incident, or null; live cues keep any text."""
    t = F.coalesce(text, F.lit(""))
    found = F.lit(None).cast("struct<reason:string,cue:string>")
    start = F.regexp_replace(F.regexp_replace(t, r"^RT @\w+:\s*", ""), "^[^A-Za-z]+", "")
    hit = lambda c, reason, pattern: F.when(c.rlike(pattern), F.struct(F.lit(reason).alias("reason"), F.regexp_extract(c, pattern, 0).alias("cue")))
    tries = [hit(t, reason, f"(?i){p}") for reason, patterns in fixed.FILTER_CUES.items() for p in patterns]
    found = F.coalesce(*tries, hit(start, "reaction only", f"(?i){fixed.REACTION_OPENER}"))
    return F.when((F.trim(t) != "") & ~t.rlike(_any(fixed.LIVE_CUES)), found)


def filter_flags(flags: DataFrame) -> DataFrame:
    """Flags (post_id, kind, place, text, status) with the first reason to drop each: house, place, text."""
    cue = cue_reason(F.col("text"))
    other = ~(F.coalesce(F.col("status"), F.lit("house")) == "house")
    place = place_reason(F.col("place"))
    reason = F.when(other, F.struct(F.lit("non-House account").alias("reason"), F.lit(None).cast("string").alias("cue"))).when(place.isNotNull(), F.struct(place.alias("reason"), F.col("place").alias("cue"))).otherwise(cue)
    return flags.withColumn("dropped", reason)


def kind_terms(kind: Column) -> Column:
    """stems that speak of a kind, with synonyms."""
    synonyms = F.create_map(*[x for k, v in fixed.KIND_SYNONYMS.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())))])
    words = F.filter(X.fold_words(kind), lambda w: (F.length(w) >= 3) & ~w.isin(fixed.KIND_MODIFIERS))
    more = F.flatten(F.transform(words, lambda w: F.coalesce(F.try_element_at(synonyms, w), F.try_element_at(synonyms, X.stem(w)), F.array().cast("array<string>"))))
    return F.array_distinct(F.transform(F.concat(words, more), X.stem))


def place_terms(place: Column) -> Column:
    """words of a place without generic ones, unless there are no others."""
    every = X.fold_words(F.regexp_replace(F.coalesce(place, F.lit("")), r",\s*[A-Za-z]{2}\.?\s*$", ""))
    own = F.filter(every, lambda w: ~w.isin(fixed.PLACE_GENERIC))
    return F.when(F.size(own) > 0, own).otherwise(every)


def has_kind(words: Column, terms: Column) -> Column:
    return F.exists(terms, lambda t: F.exists(words, lambda w: X.word_matches(w, t)))


def has_place(words: Column, terms: Column) -> Column:
    return (F.size(terms) > 0) & F.forall(terms, lambda t: F.exists(words, lambda w: (w == t) | ((F.length(t) >= 5) & w.startswith(t))))


def sentences(text: Column) -> Column:
    """array of (start, end) of sentences and lines, in code points; blank ones are left out."""
    end = "[.!?…]+[\"”’)\\]]*\\s+|\\n+"
    gaps = F.split(text, end, -1)
    marks = F.concat(F.regexp_extract_all(text, F.lit(end), F.lit(0)), F.array(F.lit("")))
    step = lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), (a["at"] + F.length(x)).alias("e")))).alias("out"))
    whole = F.zip_with(gaps, marks, lambda g, m: F.concat(g, m))
    spans = F.aggregate(whole, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out")), step, lambda a: a["out"])
    return F.filter(spans, lambda x: F.trim(F.regexp_replace(F.substring(text, x["s"] + 1, x["e"] - x["s"]), r"\s+", " ")) != "")


def evidence(df: DataFrame, text: str = "text", kind: str = "kind", place: str = "place", fallback: int = 140) -> DataFrame:
    """df with evidence (span, exact, start, stop): the shortest run of up to three sentences that names both.

    Of equally short runs the first; if there is none, the beginning of the text, exact false.
    """
    own = df.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("_k", kind_terms(F.col(kind))).withColumn("_p", place_terms(F.col(place))).withColumn("_s", sentences(F.col("_t")))
    words = own.withColumn("_w", F.transform("_s", lambda x: X.fold_words(F.substring(F.col("_t"), x["s"] + 1, x["e"] - x["s"]))))

    def runs(n: int) -> Column:
        at = F.when(F.size("_s") >= n, F.sequence(F.lit(1), F.size("_s") - (n - 1))).otherwise(F.array().cast("array<int>"))
        good = F.filter(at, lambda i: has_kind(F.flatten(F.slice(F.col("_w"), i, n)), F.col("_k")) & has_place(F.flatten(F.slice(F.col("_w"), i, n)), F.col("_p")))
        return F.transform(good, lambda i: F.struct(F.get("_s", i - 1)["s"].alias("s"), F.get("_s", i + (n - 2))["e"].alias("e")))

    first = F.get(F.concat(runs(1), runs(2), runs(3)), F.lit(0))
    spanned = words.withColumn("_f", first).withColumn("_a", F.coalesce(F.col("_f")["s"], F.lit(0))).withColumn("_b", F.coalesce(F.col("_f")["e"], F.least(F.length("_t"), F.lit(fallback))))
    piece = F.substring(F.col("_t"), F.col("_a") + 1, F.col("_b") - F.col("_a"))
    links = r"^\s*(?:https?://\S+\s*)*"
    lead = F.length(F.regexp_extract(piece, links, 0))
    lead = F.when(lead < F.length(piece), lead).otherwise(F.length(F.regexp_extract(piece, r"^\s*", 0)))
    rest = F.substring(piece, lead + 1, F.length(piece))
    done = F.regexp_replace(F.when(F.regexp_replace(rest, r"(?:\s*https?://\S+)+\s*$", "") != "", F.regexp_replace(rest, r"(?:\s*https?://\S+)+\s*$", "")).otherwise(rest), r"\s+$", "")
    out = F.struct(done.alias("span"), F.col("_f").isNotNull().alias("exact"), (F.col("_a") + lead).alias("start"), (F.col("_a") + lead + F.length(done)).alias("stop"))
    return spanned.withColumn("evidence", out).drop("_t", "_k", "_p", "_s", "_w", "_f", "_a", "_b")


def incident_key(kind: Column, place: Column, name: Column) -> Column:
    """place--kind, and the name behind it if there is one."""
    norm = lambda c: F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", "")), r"\s+", "-")
    return F.concat(norm(place), F.lit("--"), norm(kind), F.when(name.isNotNull(), F.concat(F.lit("--"), F.regexp_replace(X.fold(name), "[^a-z0-9]", ""))).otherwise(""))


def event_name(name: Column, kind: Column, text: Column) -> Column:
    """a name that the text supports, else a hashtag that names a fire, storm, flood or hurricane."""
    plain = lambda c: F.regexp_replace(X.fold(c), "[^a-z0-9]", "")
    good = (F.length(plain(name)) >= 4) & (plain(name) != plain(kind)) & plain(text).contains(plain(name))
    tag = F.nullif(F.regexp_extract(text, "#([A-Za-z][A-Za-z0-9]*(?:Fire|Storm|Flood|Hurricane))(?![A-Za-z0-9_])", 1), F.lit(""))
    return F.when(F.coalesce(good, F.lit(False)), name).otherwise(tag)


def group_incidents(posts: DataFrame, as_of: Column, gap_hours: int = 48, keep_days: int = 7) -> DataFrame:
    """Incidents from flagged posts (key, post_id, created, author_id, member): runs of one key at most 48 hours apart.

    Each has its first and last post, counts, an ordered timeline, a lifecycle by its quiet time, and an id
    of key and first day.  Resolved ones that have been quiet for more than a week are dropped.
    """
    runs = islands(posts, "key", "created", gap_hours * 3600, "post_id")
    out = runs.groupBy("key", "island").agg(
        F.min("created").alias("since"), F.max("created").alias("last"), F.count("*").alias("posts"), F.countDistinct("author_id").alias("accounts"), F.countDistinct("member").alias("people"),
        F.min_by("post_id", F.struct("created", "post_id")).alias("lead"), F.max_by("post_id", F.struct("created", "post_id")).alias("latest"),
        F.array_sort(F.collect_list(F.struct("created", "post_id"))).alias("timeline"),
    )
    out = out.withColumn("lifecycle", T.lifecycle(F.col("last"), as_of)).withColumn("id", F.concat("key", F.lit("--"), F.date_format("since", "yyyy-MM-dd")))
    old = (F.col("lifecycle") == "resolved") & (T.age_seconds(F.col("last"), as_of) > keep_days * 86400)
    return out.filter(~old).drop("island")


def phase_order() -> list[Column]:
    """Active, monitoring, resolved; the latest first."""
    return [F.when(F.col("lifecycle") == "active", 0).when(F.col("lifecycle") == "monitoring", 1).otherwise(2), F.desc("last"), F.asc("id")]


def corroboration(entries: DataFrame) -> DataFrame:
    """Per incident statements, people, accounts without a person, and references cited by several sources.

    entries: incident, author_id, person_id, source_id, reference_ids.  Repetition is no confirmation, so
    nothing is ever marked as corroborated.
    """
    base = entries.groupBy("incident").agg(
        F.count("*").alias("statements"), F.countDistinct("person_id").alias("people"), F.countDistinct("author_id").alias("accounts"),
        F.countDistinct(F.when(F.col("person_id").isNull(), F.col("author_id"))).alias("unresolved"), F.sort_array(F.collect_set("source_id")).alias("source_ids"),
    )
    cited = entries.select("incident", "source_id", F.explode("reference_ids").alias("ref")).groupBy("incident", "ref").agg(F.countDistinct("source_id").alias("n")).filter("n > 1")
    repeated = cited.groupBy("incident").agg(F.count("*").alias("repeated_references"))
    return base.join(repeated, "incident", "left").withColumn("repeated_references", F.coalesce("repeated_references", F.lit(0).cast("bigint"))).withColumn("corroborated", F.lit(False)).withColumn("status", F.lit("provisional"))


def status_counts(incidents: DataFrame) -> DataFrame:
    """Incidents per lifecycle."""
    return incidents.groupBy("lifecycle").agg(F.count("*").alias("n"))


def brief(incident: Column) -> Column:
    """A short text of an incident for copying."""
    return F.concat_ws("\n", F.concat(F.upper(incident["lifecycle"]), F.lit(": "), incident["key"]), F.concat(F.lit("posts "), incident["posts"].cast("string"), F.lit(", people "), incident["people"].cast("string")), F.concat(F.lit("since "), incident["since"].cast("string"), F.lit(", last "), incident["last"].cast("string")))


def complete_passage(texts: pd.Series, quotes: pd.Series) -> pd.Series:
    """each quote, widened to whole sentences of its text; null where the text doesn't hold it."""
    out = []
    for t, q in zip(texts, quotes, strict=True):
        if not t or not q or (a := t.find(q)) < 0:
            out.append(None)
            continue
        ends = [m.end() for m in re.finditer(r"[.!?…]+[\"”’)\]]*(?:\s+|$)|\n+", t)]
        start = max([e for e in ends if e <= a], default=0)
        stop = min([e for e in ends if e >= a + len(q)], default=len(t))
        out.append(t[start:stop].strip())
    return pd.Series(out, dtype=object)
