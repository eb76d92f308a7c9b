"""Minimum covariance determinants against all subsets, and verdicts that the fitted scatter alone explains."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import quality as Q


def test_estimate_equals_the_best_of_all_subsets():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (12, 2)) @ np.array([[1, 0.8], [0, 0.6]]), rng.normal(25, 1, (4, 2))])
    kept = int(Q.H * len(x))
    best = min(itertools.combinations(range(len(x)), kept), key=lambda i: np.linalg.det(np.cov(x[list(i)].T, bias=True)))
    centre, scatter = x[list(best)].mean(0), np.cov(x[list(best)].T, bias=True)
    scatter = scatter * (Q.H / Q._chi2_cdf(Q.chi2_quantile(Q.H, 2), 4))
    d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
    near = x[d2 <= Q.chi2_quantile(0.975, 2)]
    want = near.mean(0), np.cov(near.T, bias=True) * (0.975 / Q._chi2_cdf(Q.chi2_quantile(0.975, 2), 4))
    got = Q.mcd(np.ones(len(x)), x, np.einsum("ij,ik->ijk", x, x))
    assert np.allclose(got[0], want[0], atol=1e-4) and np.allclose(got[1], want[1], atol=1e-3)


def rows(spark, n, make):
    """Statistics as the operator has them, without texts."""
    rng = np.random.default_rng(9)
    out = [(i, *make(rng, i)) for i in range(n)]
    shape = "doc_id bigint, lang string, source string, " + ", ".join(f"{z} double" for z in Q.Z)
    return spark.createDataFrame(out, shape).withColumns({"n_words": F.lit(10_000), "n_repeat_words": F.lit(0)})


def test_correlation_alone_makes_an_outlier(spark):
    def make(rng, i):
        a, b, c, d = rng.normal(0, 1, 4)
        a, b = (2.5, -2.5) if i == 0 else (2.5, 2.5) if i == 1 else (a, 0.98 * a + 0.2 * b)
        return "en", "s", *map(float, (0.2 + 0.02 * a, 0.13 + 0.02 * b, 0.95 + 0.01 * c, 3.5 + 0.4 * d, 1.6 + 0.04 * rng.normal()))

    stats = rows(spark, 1500, make)
    out = {r.doc_id: r for r in Q.judge(stats, Q.estimates(stats, ["lang", "source"]), ["lang", "source"]).collect()}
    # both are 2.5 standard deviations away on either axis; only one goes against the correlation
    assert not out[0].kept and out[1].kept and sum(not r.kept for r in out.values()) == 1


def test_each_source_is_judged_by_its_own_estimate(spark):
    def make(rng, i):
        source = "plain" if i % 4 else "loud"
        upper = {"plain": 0.13, "loud": 0.60}[source] if i > 1 else 0.60
        source = "plain" if i == 1 else source
        z = rng.normal(0, 1, 5) * [0.02, 0.02, 0.01, 0.4, 0.04] + [0.17, upper, 0.95, 3.5, 1.6]
        return "en", source, *map(float, z)

    stats = rows(spark, 4000, make)
    fitted = Q.estimates(stats, ["lang", "source"])
    assert {(r.g2, r.level) for r in fitted.collect()} == {('{"source":"plain"}', 2), ('{"source":"loud"}', 2)}
    out = {r.doc_id: r.kept for r in Q.judge(stats, fitted, ["lang", "source"]).collect()}
    assert [i for i, k in out.items() if not k] == [1]


def test_small_and_narrow_groups_are_judged_by_what_stands_in(spark):
    def make(rng, i):
        z = rng.normal(0, 1, 5) * [0.02, 0.02, 0.01, 0.4, 0.04] + [0.17, 0.13, 0.95, 3.5, 1.6]
        kind = ("wide", "copies", "few", "lower")[0 if i < 1200 else 1 if i < 1700 else 2 if i < 1750 else 3]
        if kind == "copies" and i % 20:
            z = np.array([0.17, 0.13, 0.95, 3.5, 1.6])
        if kind == "lower":
            z[1] = 0.0
        return "en", kind, *map(float, z)

    stats = rows(spark, 2200, make)
    fitted = Q.estimates(stats, ["lang", "source"])
    assert {r.g2: r.level for r in fitted.collect()} == {'{"source":"wide"}': 2, '{"source":"copies"}': 1, '{"source":"few"}': 1, '{"source":"lower"}': 2}
    assert Q.judge(stats, fitted, ["lang", "source"]).filter("not kept").count() == 0


def test_every_language_and_source_has_its_estimate_where_rows_allow(spark):
    """On sf0.1 the sources of English have 250 rows and more; verdicts agree with all labels."""
    d = "/root/testdata/sf0.1"
    stats = Q.cut(Q.statistics(spark.read.parquet(f"{d}/documents.parquet"), ["doc_id", "lang", "source"]))
    fitted = Q.estimates(stats, ["lang", "source"])
    level = {(r.g1, r.level) for r in fitted.collect()}
    assert ('{"lang":"en"}', 2) in level and ('{"lang":"es"}', 1) in level
    out = Q.judge(stats, fitted, ["lang", "source"]).filter("not base_failed").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) == 0 and n.get((1, False), 0) <= 0.002 * n[1, True]
