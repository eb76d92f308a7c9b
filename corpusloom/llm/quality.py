"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document gives five transformed statistics (``Z``), all of which vary among ordinary texts: shares of
punctuation and of capitals, richness of vocabulary, words in a line, letters in a word.  Their distribution per
language and source is estimated by the minimum covariance determinant (MCD), and a document is rejected if
its squared Mahalanobis distance to the estimate of its group, divided by 1 + ``SHORT`` / words (a share of n
words has a sampling variance in proportion to 1 / n), exceeds ``CUTOFF``.

The fitted scatter decides.  ``FLOOR`` is numerical only.  An axis on which a group hardly varies (a source
without capitals) is widened to ``NARROW`` times the standard deviation over all rows; a group that is narrow
on the whole (copies of one text), by the root of its determinant, is judged by what stands in for it.

Scale.  The statistics are one narrow pass over the texts.  The estimates need no row twice: each
group is summed up over cells of a fixed grid (counts, sums and products of every row; nothing is
sampled), partially aggregated before the shuffle, so that a group costs at most the number of
cells, however many rows it has.  Concentration steps then choose among weighted cells.

Defined results: null or empty text has no words and fails the base rules.  Null language or
source is a value of its own.  A group with fewer than ``min_group`` rows that pass the base rules
is judged by its language's estimate, then by that of all rows; if even these are fewer than ``LEAST``,
the base rules alone decide.  Repeated rows are judged alike.  A column of the input with a name that the
operator returns is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as K
from .common import cut, drop, join_small, small_batches, table

Z = ["z_marks", "z_upper", "z_vocabulary", "z_line", "z_word"]
#: Least standard deviation, so that matrices can be inverted; no statistic of ordinary texts comes near it.
FLOOR = 1e-3
#: Sides of the grid's cells, near the standard deviations of ordinary texts; sums and products are exact.
STEP = np.array([0.02, 0.02, 0.015, 0.5, 0.05])
#: Bounds of the grid: values beyond them share the outermost cells.
EDGE = np.array([1.6, 1.6, 1.0, 12.0, 12.0])
#: Share of rows that the determinant is taken over, least rows of a group, least rows at all.
H, MIN_GROUP, LEAST = 0.75, 200, 50
NARROW, SHORT = 0.25, 100.0
#: Beyond the 1 - 1e-11 quantile of chi-square with five degrees of freedom: texts have heavier tails than a normal.
CUTOFF = 60.0
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _repeated(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (hash, doc) occurs twice or more; whether an equal one comes earlier."""
    key = K.mix(h ^ K.mix(doc.astype(K.U64) + K.U64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, many = np.zeros(len(h), bool), np.zeros(len(h), bool)
    again[order[1:][same]] = True
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return many, again


def block_statistics(b: K.Block) -> np.ndarray:
    """BASE, lines, letters, upper-case letters, distinct words and punctuation marks per document of a block."""
    n = len(b.off) - 1
    at = K.code_points(b.data)
    hasher = K.Hasher(b.data)
    s, e, doc = K.words(b)
    out = np.zeros((n, 10), np.int64)
    out[:, 0] = K.per_doc(doc, n)
    out[:, 1] = np.bincount(doc, at[e] - at[s], n)
    sym = np.concatenate([[0], np.cumsum(_SYMBOL[b.data])])
    out[:, 2] = sym[b.off[1:]] - sym[b.off[:-1]]
    ls, le, owner = K.lines(b)
    ink = np.concatenate([[0], np.cumsum(~K.DELIM[b.data])])
    full = ink[le] > ink[ls]
    ls, le, owner = ls[full], le[full], owner[full]
    out[:, 3] = np.bincount(owner[_repeated(hasher(ls, le), owner)[1]], minlength=n)
    out[:, 5] = K.per_doc(owner, n)
    h = hasher(s, e)
    if len(h) >= 3:
        whole = np.flatnonzero(doc[:-2] == doc[2:])
        many, _ = _repeated(*K.shingles(h, doc, 3))
        covered = np.zeros(len(h), bool)
        for i in range(3):
            covered[whole[many] + i] = True
        out[:, 4] = np.bincount(doc[covered], minlength=n)
    out[:, 8] = out[:, 0] - np.bincount(doc[_repeated(h, doc)[1]], minlength=n)
    d = b.data
    after = np.concatenate([[0], d[:-1]]) == 0xC3  # Latin-1 letters in UTF-8
    up = ((d >= 65) & (d <= 90)) | (after & (d >= 0x80) & (d <= 0x9E))
    any_case = up | ((d >= 97) & (d <= 122)) | (after & (d >= 0x9F) & (d <= 0xBF))
    for k, x in ((6, any_case), (7, up), (9, _MARK[d])):
        c = np.concatenate([[0], np.cumsum(x)])
        out[:, k] = c[b.off[1:]] - c[b.off[:-1]]
    return out


def transform(t: np.ndarray) -> np.ndarray:
    """The vectors Z: angles of shares, which even out their variance, and logarithms of means."""
    words, chars, _, _, _, lines, letters, upper, distinct, marks = t.T.astype(float)
    angle = lambda a, b: np.arcsin(np.sqrt(np.minimum(1, a / np.maximum(b, 1))))
    mean = lambda a, b: np.log(np.maximum(1, a / np.maximum(b, 1)))
    vocabulary = np.log(np.maximum(distinct, 1)) / np.log(np.maximum(words, 2))
    return np.stack([angle(marks, chars), angle(upper, letters), vocabulary, mean(words, lines), mean(chars, words)], 1)


def statistics(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep, BASE and Z for each row."""
    small_batches(df.sparkSession)
    keep = [c for c in keep if c not in {*BASE, *Z}]
    types = df.select(*keep).schema
    add = [*((c, "bigint") for c in BASE), *((c, "double") for c in Z)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in types), *(f"{c} {t}" for c, t in add)])

    def run(batches):
        K.own("quality")
        for batch in batches:
            found = [block_statistics(b) for b in K.blocks(batch.column(batch.num_columns - 1))]
            t = np.concatenate(found) if found else np.zeros((0, 10), np.int64)
            z = transform(t)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(t[:, i]) for i in range(5)), *(pa.array(z[:, i]) for i in range(5))],
                names=[*keep, *BASE, *Z],
            )

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function by its series."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    for i in range(1, 1000):
        term *= x / (a + i)
        total += term
        if term < total * 1e-15:
            break
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < q else (low, mid)
    return low


def mcd(n: np.ndarray, sums: np.ndarray, prods: np.ndarray, h: float = H, starts: int = 60, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Location and scatter of weighted cells: n rows each, sums and products (p x p) of the rows.

    FAST-MCD: seeded elemental starts and one from medians, two concentration steps each, the ten
    of least determinant to convergence, then one reweighting step.  The cell at the edge of the
    subset counts with the part of its weight that completes h.
    """
    p = sums.shape[1]
    mean, total = sums / n[:, None], n.sum()
    most, floor = h * total, np.eye(p) * FLOOR**2
    rng = np.random.default_rng(seed)

    def estimate(share):
        w = (share * n).sum()
        centre = share @ sums / w
        return centre, np.tensordot(share, prods, 1) / w - np.outer(centre, centre) + floor

    def distance(centre, scatter):
        x = mean - centre
        return np.einsum("ij,jk,ik->i", x, np.linalg.inv(scatter), x)

    def step(centre, scatter):
        order = np.argsort(distance(centre, scatter), kind="stable")
        before = np.concatenate([[0], np.cumsum(n[order])[:-1]])
        share = np.zeros(len(n))
        share[order] = np.clip((most - before) / n[order], 0, 1)
        return estimate(share)

    by = [np.argsort(mean[:, j], kind="stable") for j in range(p)]
    median = np.array([mean[o[np.searchsorted(np.cumsum(n[o]), total / 2)], j] for j, o in enumerate(by)])
    spread = np.average((mean - median) ** 2, axis=0, weights=n)
    first = [(median, np.diag(spread) + floor)]
    for _ in range(starts if len(n) > 1 else 0):
        own = rng.choice(len(n), p + 1, p=n / total)
        first.append((mean[own].mean(0), np.cov(mean[own].T, bias=True) + floor))
    tried = [step(*step(*x)) for x in first]
    tried.sort(key=lambda x: np.linalg.slogdet(x[1])[1])
    best, least = None, np.inf
    for x in tried[:10]:
        last = np.inf
        for _ in range(50):
            det = np.linalg.slogdet(x[1])[1]
            if det >= last - 1e-9:
                break
            last, x = det, step(*x)
        if last < least:
            best, least = x, last
    centre, scatter = best
    scatter = scatter * (h / _chi2_cdf(chi2_quantile(h, p), p + 2))
    near = (distance(centre, scatter) <= chi2_quantile(0.975, p)).astype(float)
    if (near * n).sum() >= most / 2:
        centre, scatter = estimate(near)
        scatter = scatter * (0.975 / _chi2_cdf(chi2_quantile(0.975, p), p + 2))
    return centre, scatter


PAIRS = [(i, j) for i in range(len(Z)) for j in range(i, len(Z))]


def cells(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and cell of the grid: rows, sums and products over all rows that pass the base rules."""
    key = [F.floor(F.least(F.col(c), F.lit(float(m))) / F.lit(float(s))).cast("int").alias(f"c{i}") for i, (c, s, m) in enumerate(zip(Z, STEP, EDGE, strict=True))]
    return (
        stats.filter(~base_failed())
        .groupBy(*groups, *key)
        .agg(
            F.count("*").alias("n"),
            *(F.sum(c).alias(f"s{i}") for i, c in enumerate(Z)),
            *(F.sum(F.col(Z[i]) * F.col(Z[j])).alias(f"q{i}{j}") for i, j in PAIRS),
        )
    )


def _fit(pdf: pd.DataFrame, overall: np.ndarray | None = None) -> pd.DataFrame:
    """Centre, inverse scatter and standard deviations of a group, and whether it is narrow beside the overall ones."""
    pdf = pdf.sort_values([f"c{i}" for i in range(len(Z))])
    n, sums = pdf["n"].to_numpy(float), pdf[[f"s{i}" for i in range(len(Z))]].to_numpy()
    prods = np.zeros((len(pdf), len(Z), len(Z)))
    for i, j in PAIRS:
        prods[:, i, j] = prods[:, j, i] = pdf[f"q{i}{j}"]
    centre, scatter = mcd(n, sums, prods)
    narrow = False
    if overall is not None:
        narrow = bool(np.linalg.slogdet(scatter)[1] / 2 < np.log(NARROW * overall).sum())
        scatter = scatter + np.diag(np.maximum((NARROW * overall) ** 2 - np.diag(scatter), 0))
    first = pdf.iloc[0]
    return pd.DataFrame([{"level": first["level"], "g1": first["g1"], "g2": first["g2"], "centre": centre, "inverse": np.linalg.inv(scatter).ravel(), "deviation": np.sqrt(np.diag(scatter)), "narrow": narrow}])


FITTED = "level int, g1 string, g2 string, centre array<double>, inverse array<double>, deviation array<double>, narrow boolean"


def estimates(stats: DataFrame, groups: list[str], min_group: int = MIN_GROUP) -> DataFrame:
    """One row per group: centre and inverse scatter, of the group or of what stands in for it; level 2, 1 or 0 tells which."""
    a, b = groups
    fine = cut(cells(stats, groups).select(F.to_json(F.struct(a)).alias("g1"), F.to_json(F.struct(b)).alias("g2"), "*").drop(a, b))
    inner = [c for c in fine.columns if c[0] == "c"]
    sums = [F.sum(c).alias(c) for c in fine.columns if c[0] in "nsq"]
    order = ["level", *fine.columns]
    none = F.lit(None).cast("string")
    levels = {
        0: fine.groupBy(*inner).agg(*sums).withColumns({"level": F.lit(0), "g1": none, "g2": none}),
        1: fine.groupBy("g1", *inner).agg(*sums).withColumns({"level": F.lit(1), "g2": none}),
        2: fine.withColumn("level", F.lit(2)),
    }

    def fit(rows: DataFrame, least: int, overall: np.ndarray | None) -> DataFrame:
        large = rows.groupBy("level", "g1", "g2").agg(F.sum("n").alias("rows")).filter(F.col("rows") >= least)
        on = [rows[c].eqNullSafe(large[c]) for c in ("level", "g1", "g2")]
        return cut(rows.join(large, on[0] & on[1] & on[2], "left_semi").groupBy("level", "g1", "g2").applyInPandas(lambda pdf: _fit(pdf, overall), FITTED))

    whole = fit(levels[0].select(*order), LEAST, None)
    found = whole.select("deviation").first()  # one row at most
    overall = np.array(found[0]) if found else None
    fitted = fit(levels[1].select(*order).unionByName(levels[2].select(*order)), min_group, overall)
    every = whole.unionByName(fitted.filter(~F.col("narrow")))
    take = lambda k, *on: every.filter(F.col("level") == k).select(*on, F.struct(F.lit(k).alias("level"), "centre", "inverse").alias(f"m{k}"))
    out = (
        fine.select("g1", "g2").distinct().withColumn("one", F.lit(0))
        .join(take(2, "g1", "g2"), ["g1", "g2"], "left")
        .join(take(1, "g1"), ["g1"], "left")
        .join(take(0, F.col("level").alias("one")), ["one"], "left")
    )
    out = cut(out.select("g1", "g2", F.coalesce("m2", "m1", "m0").alias("m")).select("g1", "g2", "m.level", "m.centre", "m.inverse"))
    drop(fine, whole, fitted)
    return out


def judge(stats: DataFrame, fitted: DataFrame, groups: list[str], cutoff: float = CUTOFF) -> DataFrame:
    """Adds base_failed, distance (squared, allowing for length; null without an estimate) and kept."""
    a, b = groups
    keyed = stats.withColumn("g1", F.to_json(F.struct(a))).withColumn("g2", F.to_json(F.struct(b)))
    joined = join_small(keyed, fitted.drop("level"), ["g1", "g2"])
    p = len(Z)
    x = [F.col(c) - F.col("centre")[i] for i, c in enumerate(Z)]
    d2 = sum((x[i] * x[j] * F.col("inverse")[i * p + j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))
    out = joined.withColumn("base_failed", base_failed()).withColumn("distance", d2 / (1 + F.lit(SHORT) / F.greatest("n_words", F.lit(1))))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).drop("g1", "g2", "centre", "inverse")


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = cut(statistics(docs, ["doc_id", "lang", "source"]))
    judged = judge(stats, estimates(stats, ["lang", "source"]), ["lang", "source"])
    return judged.select("doc_id", *BASE, "base_failed", "kept", "distance")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the estimates keep, with the columns of docs."""
    stats = cut(statistics(docs, ["lang", "source"]))
    fitted = estimates(stats, ["lang", "source"])
    drop(stats)
    inner = docs.toDF(*[f"d{i}" for i in range(len(docs.columns))])  # so that no name clashes
    at = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    stats = statistics(inner, inner.columns, at["text"])
    judged = judge(stats, fitted, [at["lang"], at["source"]])
    return judged.filter("kept").select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])
