"""Swaps that fail leave the old version; vectors beyond the sample get a cluster; orders that can't be repaired are errors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import learning, vectors
from corpusloom.sources import sinks


class Stubborn:
    """A file system whose renames fail from the given one on, until so many have failed."""

    def __init__(self, fs, first, failures):
        self.fs, self.first, self.failures, self.n = fs, first, failures, 0

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, a, b):
        self.n += 1
        if self.n >= self.first and self.failures:
            self.failures -= 1
            return False
        return self.fs.rename(a, b)


@pytest.mark.parametrize("first", [1, 2])
def test_a_failed_swap_leaves_the_old_version(spark, tmp_path, monkeypatch, first):
    path = f"file://{tmp_path}/t"
    sinks.swap(spark.range(3), path)
    real = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, p: (Stubborn(real(s, p)[0], first, 1), real(s, p)[1]))
    with pytest.raises(OSError, match="stays as it was"):
        sinks.swap(spark.range(9), path)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 3 and len([x for x in tmp_path.iterdir() if not x.name.startswith(".")]) == 1
    sinks.swap(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_every_vector_gets_the_nearest_cluster(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "a" if i < 60 else "b", [float(x) for x in np.eye(3)[i % 3] + rng.normal(0, 0.05, 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<double>")
    fitted = vectors.cluster_pools(df.filter("vec_id % 5 = 0"), "label", 0.8)
    out = {r.vec_id: (r.label, r.cluster) for r in vectors.assign_clusters(df, fitted, "label").collect()}
    assert len(out) == 90 and len(set(out.values())) == 6
    assert all((out[i] == out[j]) == (i % 3 == j % 3) for i in range(60) for j in range(60))


def test_twins_change_places_with_free_items_only():
    order = learning.separate([1, 2, 3, 4, 5, 6], {2: 1}, 3)
    assert abs(order.index(2) - order.index(1)) >= 3 and sorted(order) == [1, 2, 3, 4, 5, 6]
    assert learning.separate([3, 4, 5, 6, 1, 2], {2: 1}, 3).index(2) == 1
    assert learning.separate([1, 3, 4, 2], {2: 1}, 3) == [1, 3, 4, 2]
    with pytest.raises(ValueError, match="apart"):
        learning.separate([1, 2, 3, 4], {2: 1, 4: 3}, 3)
