"""Flows between overlapping sources against shortest augmenting paths on the whole graph."""

import random

from pyspark.sql import functions as F

from corpusloom.llm import mixing


def plain_flow(capacity, member, quota, repeats):
    """Value and cost of a min-cost flow: Bellman-Ford, one path after another."""
    n, m = len(capacity), len(quota)
    source, sink = n + m, n + m + 1
    arcs = []  # from, to, room, cost, index of the reverse arc

    def add(a, b, room, cost):
        arcs.append([a, b, room, cost, len(arcs) + 1])
        arcs.append([b, a, 0, -cost, len(arcs) - 1])

    for p, c in enumerate(capacity):
        for tier in range(repeats):
            add(source, p, c, tier)
        for s in member[p]:
            add(p, n + s, 10**9, 0)
    for s, q in enumerate(quota):
        add(n + s, sink, q, 0)
    value = cost = 0
    while True:
        far, by = {source: 0}, {}
        for _ in range(n + m + 2):
            for k, (a, b, room, price, _) in enumerate(arcs):
                if room > 0 and a in far and far[a] + price < far.get(b, 10**9):
                    far[b], by[b] = far[a] + price, k
        if sink not in far:
            return value, cost
        path, at = [], sink
        while at != source:
            path.append(by[at])
            at = arcs[by[at]][0]
        amount = min(arcs[k][2] for k in path)
        for k in path:
            arcs[k][2] -= amount
            arcs[arcs[k][4]][2] += amount
        value, cost = value + amount, cost + amount * far[sink]


def test_flows_have_greatest_value_and_least_cost():
    random.seed(8)
    for _ in range(300):
        n, m, repeats = random.randint(1, 7), random.randint(1, 4), random.randint(1, 3)
        capacity = [random.randint(0, 12) for _ in range(n)]
        member = [sorted(random.sample(range(m), random.randint(0 if n > 1 else 1, m))) for _ in range(n)]
        quota = [random.randint(0, 25) for _ in range(m)]
        sent = mixing.flow(capacity, member, quota, repeats)
        by_source = [sum(x.get(s, 0) for x in sent) for s in range(m)]
        given = [sum(x.values()) for x in sent]
        assert all(a <= q for a, q in zip(by_source, quota, strict=True)) and all(g <= repeats * c for g, c in zip(given, capacity, strict=True)) and min([0, *(v for x in sent for v in x.values())]) == 0
        cost = sum(max(0, g - t * c) for g, c in zip(given, capacity, strict=True) for t in range(1, repeats))
        assert (sum(given), cost) == plain_flow(capacity, member, quota, repeats)


def test_flow_over_many_patterns_is_quick():
    random.seed(1)
    n, m = 20_000, 40
    member = [sorted(random.sample(range(m), 3)) for _ in range(n)]
    capacity = [random.randint(1, 1000) for _ in range(n)]
    quota = [sum(capacity) // 30] * m
    assert sum(sum(x.values()) for x in mixing.flow(capacity, member, quota, 2)) == sum(quota)


def test_overlapping_sources_share_documents(spark):
    rows = [(i, 10, (["a"], ["a", "b"], ["b", "a", "b"], ["b", "c"], [None])[i % 5]) for i in range(500)]
    sized = spark.createDataFrame(rows, "doc_id bigint, size bigint, s array<string>")
    chosen, quotas = mixing.plan(sized, "s")
    target = {r.source: r.target for r in quotas.collect()}
    assert {r.source: r.source_size for r in quotas.collect()} == {"a": 3000, "b": 3000, "c": 1000, None: 1000}
    assert chosen.count() == 4  # the same members in another order, or twice, are one pattern
    taken = mixing.take(sized, chosen, "s")
    words = {tuple(r.s): r.n for r in taken.withColumn("s", F.array_sort(F.array_distinct("s"))).groupBy("s").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()}
    assert words[(None,)] <= target[None] + 10 and max(r.copies for r in taken.collect()) <= 2
    assert abs(sum(words.values()) - min(sum(target.values()), 10_000)) <= 4 * 10
