"""Toxicity: Levenshtein automata intersected with a lexicon trie, and scores of context windows.

Learning.  A bounded sample of labelled documents (``SAMPLE`` of each class, those of least hash) gives the
lexicon, up to ``TERMS`` terms that cover the toxic ones and as many that only they use (both bounds hold for
the fit only): whole words, and stems that begin longer words, chosen one after another by how well they tell toxic documents from others among those that
no earlier term has caught.  A logistic regression on what matching finds turns hits into a score.

Matching.  The terms form a trie.  For a word of a text, the Levenshtein automaton of that word (bit
sets of positions, one for each number of errors) is run along the trie; branches where it dies are
not entered.  A word is only tried if it can match: a word within k edits of a term differs from it
by k in length and in 2k letters at most, which is tested for whole blocks at once, with a bit for each
code point.  A word reaches from the first to the last letter or digit between blanks, whatever its length.  Words that the
sample's other documents use themselves, such as a name one letter away from a term, are no misspellings.

Context.  Each hit is scored by its own window of ``WINDOW`` words on either side.  Between marks of quotation it
counts less (``QUOTED``): words that are reported.  Unless the window holds other hits outside of any
quotation: then the quotation is part of the abuse and excuses nothing.

Defined results: null and empty texts get the score of a text without hits.  Without labels of both
classes nothing can be learned and each score is 0.  Rows are scored one by one, so repeated rows,
ties and skewed keys make no difference.
"""

from __future__ import annotations

import bisect
import functools
import json
import unicodedata
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import bounded_sample, crc_mod, small_batches, table

SAMPLE, TERMS, THRESHOLD = 3000, 96, 0.7
STEMS = range(3, 11)
QUOTED, WINDOW, MISSPELLED = 0.4, 6, 0.7
#: Least support of a term: documents, and share of the toxic ones.
LEAST, LEAST_SHARE = 5, 0.004

_LETTER = np.zeros(256, np.uint64)
for _i in range(26):
    _LETTER[97 + _i] = 1 << _i
QUOTES = '"“”„«»'


@functools.cache
def _kinds() -> np.ndarray:
    """For each code point: 1 for letters and digits, 2 for marks, which belong to the letter before, 0 for the rest."""
    return np.array([{"L": 1, "N": 1, "M": 2}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)


def inner(b: K.Block, data: np.ndarray) -> np.ndarray:
    """Is this the first byte of a letter or digit, or of a mark that follows one?"""
    kinds = _kinds()
    out = kinds[data]
    out[data >= 0x80] = 0
    lead, value = scalars(data)
    out[lead] = kinds[np.minimum(value, 0x10FFFF)]
    if (out == 2).any():
        out[b.off[:-1][b.off[:-1] < len(data)]] &= 1  # nothing stands before a text's first
        first = np.flatnonzero((data & 0xC0) != 0x80)
        kind = out[first]
        out[first] = kind[np.maximum.accumulate(np.where(kind != 2, np.arange(len(kind)), 0))] == 1
    return out == 1


def tokens(b: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end and document of words from their first to their last letter or digit, empty if they have none."""
    data = K.lowered(b.data)
    s, e, doc = K.words(b)
    if not len(s):
        return data, s, e, doc
    inside = inner(b, data)
    at = np.flatnonzero(inside)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    some = np.flatnonzero(before[e] > before[s])
    left, last = at[before[s[some]]], at[before[e[some]] - 1]
    s, e, stop = e.copy(), e.copy(), e[some]
    s[some] = left
    e[some] = np.minimum(last + 1 + (data[last] >= 0xC0) + (data[last] >= 0xE0) + (data[last] >= 0xF0), stop)
    return data, s, e, doc


def scalars(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the code points beyond ASCII."""
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead].astype(np.int64)
    tail = [(data[np.minimum(lead + i, max(len(data) - 1, 0))] & 0x3F).astype(np.int64) for i in (1, 2, 3)]
    two = (first & 0x1F) << 6 | tail[0]
    three = (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
    four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    return lead, np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))


def letter_bits(data: np.ndarray) -> np.ndarray:
    """One bit, or none, at each code point's first byte, so that an edit changes two bits of a word's union at most.

    Only letters and digits have bits, so marks between two words add none to the first.
    """
    out = _LETTER[data]
    lead, value = scalars(data)
    letter = _kinds()[np.minimum(value, 0x10FFFF)] == 1
    out[lead[letter]] = np.uint64(1) << (26 + value[letter] % 37).astype(np.uint64)
    return out


class Automaton:
    """The trie of a lexicon; match() intersects it with the Levenshtein automaton of a word."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.nodes: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        for i, (term, _) in enumerate(terms):
            at = 0
            for c in term:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.ends.append([])
                at = self.nodes[at][c]
            self.ends[at].append(i)

    @staticmethod
    def errors(term: str, stem: bool) -> int:
        """Edits allowed: none in stems and short words."""
        return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2

    def match(self, word: str) -> list[tuple[int, int]]:
        """(term, edits) for each term that the word is or misspells, or that is a stem of it."""
        most = 2
        at: dict[str, int] = defaultdict(int)
        for i, c in enumerate(word):
            at[c] |= 1 << i
        n, full = len(word), (1 << (len(word) + 1)) - 1
        start, reach = [], 1
        for _ in range(most + 1):
            start.append(reach)
            reach |= reach << 1 & full
        found = []

        todo = [(0, start)]
        while todo:
            node, states = todo.pop()
            for i in self.ends[node]:
                term, stem = self.terms[i]
                if stem:
                    if states[0] & ((1 << n) - 1):
                        found.append((i, 0))
                else:
                    for k in range(self.errors(term, stem) + 1):
                        if states[k] >> n & 1:
                            found.append((i, k))
                            break
            below = []
            for c, child in self.nodes[node].items():
                hit = at.get(c, 0)
                new = [(states[0] & hit) << 1]
                for k in range(1, most + 1):
                    low = states[k - 1]
                    new.append(((states[k] & hit) << 1 | low | low << 1 | new[k - 1] << 1) & full)
                if any(new):
                    below.append((child, new))
            todo += reversed(below)
        return found


class Matcher:
    """Finds the hits of a lexicon in blocks of text."""

    def __init__(self, terms: list[tuple[str, bool]], known: set[str]):
        self.terms, self.known = terms, known
        self.automaton = Automaton(terms)
        self.fuzzy, self.exact, self.stems = [], [], defaultdict(list)
        for term, stem in terms:
            raw = np.frombuffer(term.encode(), np.uint8)
            h = K.Hasher(raw)(np.array([0]), np.array([len(raw)]))[0]
            if stem:
                self.stems[len(term)].append(h)
            else:
                self.exact.append(h)
                if k := Automaton.errors(term, stem):
                    self.fuzzy.append((len(term), np.bitwise_or.reduce(letter_bits(raw)), k))
        self.exact = np.array(self.exact, np.uint64)
        self.stems = {k: np.array(v, np.uint64) for k, v in self.stems.items()}
        # what is longer than the longest term by 3 is no misspelling of it; its stems lie in these first code points
        self.longest = max((len(t) for t, _ in terms), default=0) + 3
        self.cache: dict[bytes, list[tuple[int, int]]] = {}

    def _match(self, word: bytes) -> list[tuple[int, int]]:
        word = word[: 4 * self.longest]
        if word not in self.cache:
            if len(self.cache) > 200_000:
                self.cache.clear()
            text = word.decode("utf-8", "replace")[: self.longest]
            self.cache[word] = [(i, k) for i, k in self.automaton.match(text) if not k or text not in self.known]
        return self.cache[word]

    def hits(self, b: K.Block) -> tuple[np.ndarray, list[tuple[int, int, int, bool, bytes]]]:
        """Words per document; (document, term, edits, quoted, word) of each hit."""
        n, out, _ = self.placed(b)
        return n, out

    def in_context(self, b: K.Block) -> tuple[np.ndarray, list[tuple[int, int, int, bool, bytes]]]:
        """The same, quoted only where the hit's window leaves it at that."""
        n, out, at_word = self.placed(b)
        return n, excused(out, at_word)

    def placed(self, b: K.Block) -> tuple[np.ndarray, list[tuple[int, int, int, bool, bytes]], list[int]]:
        """The same as hits, and the number of each hit's word in the block."""
        data, s, e, doc = tokens(b)
        n = K.per_doc(doc, len(b.off) - 1)
        if not len(s) or not self.terms:
            return n, [], []
        at = K.code_points(data)
        size = at[e] - at[s]
        hasher = K.Hasher(data)
        mine = np.isin(hasher(s, e), self.exact)
        begins = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]])
        for k, wanted in self.stems.items():
            longer = np.flatnonzero(size > k)
            mine[longer] |= np.isin(hasher(s[longer], begins[at[s[longer]] + k]), wanted)
        if self.fuzzy:
            letters = np.bitwise_or.reduceat(letter_bits(data), np.minimum(s, len(data) - 1))
            for length, mask, k in self.fuzzy:
                near = np.flatnonzero(np.abs(size - length) <= k)
                mine[near[np.bitwise_count(letters[near] ^ mask) <= 2 * k]] = True
        out, at_word = [], []
        raw = b.data
        for j in np.flatnonzero(mine & (s < e)):
            word = data[s[j] : e[j]].tobytes()
            found = self._match(word)
            if found:
                d = int(doc[j])
                a, z = max(int(b.off[d]), int(s[max(j - WINDOW, 0)])), min(int(b.off[d + 1]), int(e[min(j + WINDOW, len(s) - 1)]))
                left, right = (raw[x:y].tobytes().decode("utf-8", "ignore") for x, y in ((a, int(s[j])), (int(e[j]), z)))
                quoted = sum(left.count(q) for q in QUOTES) % 2 == 1 and any(q in right for q in QUOTES)
                i, k = min(found, key=lambda x: (x[1], -len(self.terms[x[0]][0])))
                out.append((d, i, k, quoted, word))
                at_word.append(int(j))
        return n, out, at_word


def excused(hits: list[tuple[int, int, int, bool, bytes]], place: list[int]) -> list[tuple[int, int, int, bool, bytes]]:
    """Hits, quoted only if no other hit of the text within WINDOW words stands outside of quotations; place numbers their words."""
    free = [(d, p) for (d, _, _, quoted, _), p in zip(hits, place, strict=True) if not quoted]
    out = []
    for (d, i, k, quoted, word), p in zip(hits, place, strict=True):
        at = bisect.bisect_left(free, (d, p - WINDOW))
        near = at < len(free) and free[at][0] == d and free[at][1] <= p + WINDOW
        out.append((d, i, k, quoted and not near, word))
    return out


def _g2(a, n1, b, n0):
    """Signed likelihood ratio of a of n1 against b of n0."""
    p = np.clip((a + b) / (n1 + n0), 1e-12, 1 - 1e-12)
    x = lambda k, n, p: k * np.log(np.maximum(k, 1e-9) / (n * p)) + (n - k) * np.log(np.maximum(n - k, 1e-9) / (n * (1 - p)))
    return np.where(a * n0 > b * n1, x(a, n1, p) + x(b, n0, p), 0)


def learn_terms(texts: pa.Array, toxic: np.ndarray, most: int = TERMS) -> list[tuple[str, bool]]:
    """Words and stems (term, is it a stem) by sequential covering of the toxic documents."""
    docs, keys, spell = [], [], {}
    base = 0
    for b in K.blocks(texts):
        data, s, e, doc = tokens(b)
        at = K.code_points(data)
        begins = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]])
        hasher = K.Hasher(data)
        for k in (0, *STEMS):
            long = np.flatnonzero(at[e] - at[s] > max(k, 2))
            ends = begins[at[s[long]] + k] if k else e[long]
            both = hasher(s[long], ends) ^ K.U64(k and 1)
            order = np.lexsort((both, doc[long]))
            first = np.ones(len(order), bool)
            first[1:] = (both[order][1:] != both[order][:-1]) | (doc[long][order][1:] != doc[long][order][:-1])
            pick = order[first]
            docs.append(doc[long][pick] + base)
            keys.append(both[pick])
            bad = toxic[docs[-1]] > 0
            for h, x, y in zip(keys[-1][bad], s[long][pick][bad], ends[pick][bad], strict=True):
                spell.setdefault(int(h), (data[x:y].tobytes(), k > 0))
        base += len(b.off) - 1
    docs, keys = (np.concatenate(docs), np.concatenate(keys)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    least = max(LEAST, LEAST_SHARE * n1)
    inside = toxic[docs] > 0
    name, index, count = np.unique(keys[inside], return_inverse=True, return_counts=True)
    kept = count >= least
    pos_doc, pos_key = docs[inside][kept[index]], index[kept[index]]
    other = np.searchsorted(name, keys[~inside])
    other[other == len(name)] = 0
    other = other[name[other] == keys[~inside]] if len(name) else other[:0]
    b = np.bincount(other, minlength=len(name)).astype(float)
    alive = np.ones(len(toxic), bool)
    terms: list[tuple[str, bool]] = []
    while len(terms) < most:
        left = alive[pos_doc]
        a = np.bincount(pos_key[left], minlength=len(name)).astype(float)
        n = max(int((alive & (toxic > 0)).sum()), 1)
        score = np.where((a >= least) & (a / n >= 4 * b / max(n0, 1)), _g2(np.minimum(a, n), n, b, max(n0, 1)), 0) if len(name) else np.zeros(1)
        # of terms that are as good, whole words and long stems say more
        best = np.flatnonzero(score >= score.max() - 1e-9)
        if score.max() < 12:
            break
        choice = max(best, key=lambda i: (not spell[int(name[i])][1], len(spell[int(name[i])][0])))
        terms.append((spell[int(name[choice])][0].decode("utf-8", "replace"), spell[int(name[choice])][1]))
        alive[pos_doc[left & (pos_key == choice)]] = False
    # the covering stops at one term per document: also take every word that only toxic documents use
    a = np.bincount(pos_key, minlength=len(name)).astype(float)
    extra = np.where((a >= max(least, 0.02 * n1)) & (b <= 0.002 * n0), _g2(a, max(n1, 1), b, max(n0, 1)), 0) if len(name) else np.zeros(0)
    for i in np.argsort(-extra)[: 4 * most]:
        text, stem = spell[int(name[i])][0].decode("utf-8", "replace"), spell[int(name[i])][1]
        if extra[i] > 12 and not stem and len(terms) < 2 * most and (text, stem) not in terms:
            terms.append((text, stem))
    return terms


def features(n: int, hits: list[tuple[int, int, float]]) -> list[float]:
    """hits: (term, edits, strength after context)."""
    total = sum(x for _, _, x in hits)
    return [1.0, min(total, 40.0) ** 0.5, min(100.0 * total / max(n, 1), 40.0) ** 0.5, float(np.log1p(len(hits))), float(np.log1p(n)) / 5, float(total >= 3)]


def _strength(model: dict, term: int, edits: int, quoted: bool) -> float:
    x = model["strength"][term] * (MISSPELLED if edits else 1.0)
    return x * QUOTED if quoted else x


def _by_doc(model: dict, n: np.ndarray, hits) -> list[list[float]]:
    own: dict[int, list] = defaultdict(list)
    for d, i, k, quoted, _ in hits:
        own[d].append((i, k, quoted))
    out = []
    for d in range(len(n)):
        out.append(features(int(n[d]), [(i, k, _strength(model, i, k, q)) for i, k, q in own.get(d, [])]))
    return out


def fit(texts: pa.Array, toxic: np.ndarray) -> dict:
    """The model of a sample, as plain numbers and strings."""
    if not len(toxic) or toxic.min() == toxic.max():
        return {"terms": [], "known": [], "strength": [], "coef": []}
    terms = learn_terms(texts, toxic)
    probe = Matcher(terms, set())
    seen: dict[tuple[bool, str], set[int]] = defaultdict(set)
    words, hits, base = [], [], 0
    for b in K.blocks(texts):
        n, found = probe.in_context(b)
        words.append(n)
        hits += [(d + base, *x) for d, *x in found]
        base += len(n)
    words = np.concatenate(words)
    for d, _, k, _, word in hits:
        if k and not toxic[d]:
            seen[word.decode("utf-8", "replace")].add(d)
    known = {w for w, x in seen.items() if len(x) >= 2}
    hits = [h for h in hits if not h[2] or h[4].decode("utf-8", "replace") not in known]
    n1, n0 = words[toxic > 0].sum() + 1, words[toxic == 0].sum() + 1
    c1, c0 = np.zeros(len(terms)), np.zeros(len(terms))
    for d, i, k, _, _ in hits:
        if not k:
            (c1 if toxic[d] else c0)[i] += 1
    model = {"terms": terms, "known": sorted(known), "strength": np.clip(np.log((c1 + 0.5) / n1) - np.log((c0 + 0.5) / n0), 0, 8).tolist()}
    x, y = np.array(_by_doc(model, words, hits)), toxic.astype(float)
    coef = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + 0.3 * np.eye(len(coef)), x.T @ (y - p) - 0.3 * coef)
        coef += step
        if np.abs(step).max() < 1e-8:
            break
    return model | {"coef": coef.tolist()}


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on up to sample labelled documents of each class; docs and labels have doc_id, and text and toxic."""
    chosen = labels.filter("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = bounded_sample(chosen, "toxic", "doc_id", sample)
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")  # 2 * sample rows at most

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id").drop_duplicates("doc_id")
        return pd.DataFrame({"model": [json.dumps(fit(pa.array(pdf["text"]), pdf["toxic"].to_numpy()))]})

    found = rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(run, "model string").first()
    model = json.loads(found[0]) if found else fit(pa.array([], pa.string()), np.zeros(0))
    model["terms"] = [tuple(x) for x in model["terms"]]
    return model


def score(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """df without text, with score, hits and terms ("term:edits", in order of the text)."""
    small_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in {text, "score", "hits", "terms"}]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), "score double, hits bigint, terms string"])

    def run(batches):
        K.own("toxicity")
        matcher = Matcher(model["terms"], set(model["known"]))
        coef = np.array(model["coef"])
        for batch in batches:
            scores, counts, names = [], [], []
            for b in K.blocks(batch.column(batch.num_columns - 1)):
                n, hits = matcher.in_context(b)
                own = defaultdict(list)
                for d, i, k, _, _ in hits:
                    own[d].append(f"{model['terms'][i][0]}:{k}")
                x = np.array(_by_doc(model, n, hits))
                scores.append(1 / (1 + np.exp(-np.clip(x @ coef, -30, 30))) if len(coef) else np.zeros(len(n)))
                counts += [len(own.get(d, ())) for d in range(len(n))]
                names += [",".join(own.get(d, ())) for d in range(len(n))]
            made = [pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(counts, pa.int64()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*keep, "score", "hits", "terms"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    small_batches(spark)
    model = learn(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 3) != 1))
    out = score(docs, model)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits")
