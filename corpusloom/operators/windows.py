"""Window-shaped operators: versions, firsts, islands, baselines, top-k and running prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


def ranked(df: DataFrame, keys, order, k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group in an order; the filter on the rank lets Spark prune before the shuffle."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def latest_version(df: DataFrame, key, version: str, position: str) -> DataFrame:
    """The row of highest version per key; of equal versions the last."""
    return ranked(df, key, [F.desc(version), F.desc(position)], 1, "_r").drop("_r")


def first_row(df: DataFrame, key, position) -> DataFrame:
    """The first row per key."""
    return ranked(df, key, position, 1, "_r").drop("_r")


def argmin(df: DataFrame, keys, value: str, *order: str) -> DataFrame:
    """Per key the value at the least of the order columns, by aggregation instead of a sort."""
    return df.groupBy(*_cols(keys)).agg(F.min_by(value, F.struct(*order)).alias(value))


def islands(df: DataFrame, keys, ts: str, gap_seconds: int, tiebreak: str, name: str = "island") -> DataFrame:
    """Number the runs of rows whose neighbours are at most a gap apart."""
    w = Window.partitionBy(*_cols(keys)).orderBy(ts, tiebreak)
    apart = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp"))
    fresh = F.when(apart.isNull() | (apart > gap_seconds * 1_000_000), 1).otherwise(0)
    return df.withColumn("_new", fresh).withColumn(name, F.sum("_new").over(w)).drop("_new")


def trailing_mean(value: Column, keys, day: str, n: int = 6) -> Column:
    """Mean of the n rows before, the present one excluded; over a dense calendar."""
    return F.avg(value).over(Window.partitionBy(*_cols(keys)).orderBy(day).rowsBetween(-n, -1))


def running_total(value: Column, keys, *order) -> Column:
    return F.sum(value).over(Window.partitionBy(*_cols(keys)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def acceleration(value: Column, keys, day: str) -> Column:
    """Half the change over two rows, less a quarter of that over the four before."""
    w = Window.partitionBy(*_cols(keys)).orderBy(day)
    return (value - F.lag(value, 2).over(w)) / 2 - (F.lag(value, 2).over(w) - F.lag(value, 6).over(w)) / 4


def top_share(df: DataFrame, keys, amount: str, k: int, *order) -> DataFrame:
    """Share of each group's amount that its k greatest rows hold; 0 for nothing."""
    w = Window.partitionBy(*_cols(keys)).orderBy(F.desc(amount), *order)
    top = F.sum(F.when(F.col("_r") <= k, F.col(amount)).otherwise(0))
    return df.withColumn("_r", F.row_number().over(w)).groupBy(*_cols(keys)).agg(F.coalesce(top / F.nullif(F.sum(amount), F.lit(0)), F.lit(0.0)).alias("top_share"))


def interior(df: DataFrame, day: str) -> DataFrame:
    """Rows of days that are neither the first nor the last; the two bounds are one small aggregate."""
    bounds = df.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return df.join(F.broadcast(bounds), (F.col(day) > F.col("_lo")) & (F.col(day) < F.col("_hi"))).drop("_lo", "_hi")  # one row


def fitting_prefix(df: DataFrame, size: Column, cap: int, *order, bucket: Column | None = None) -> DataFrame:
    """The longest prefix in an order whose sizes sum up to no more than a cap.

    bucket is a coarse, monotone function of the order (such as a day): sums per bucket find the one
    where the cap is met, and only its rows are ordered, so no task sorts everything.
    """
    if bucket is None:
        return df.withColumn("_s", F.sum(size).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_s") <= cap).drop("_s")
    sized = df.withColumn("_n", size).withColumn("_b", bucket)
    sums = sized.groupBy("_b").agg(F.sum("_n").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("_before", before).filter(F.col("_before") <= cap)  # one row per bucket
    held = sized.join(sums, "_b")
    inside = F.sum("_n").over(Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return held.withColumn("_s", F.col("_before") + inside).filter(F.col("_s") <= cap).drop("_b", "_n", "_t", "_before", "_s")


def adaptive_size(counts: Column, keys, *order, low: int = 5, high: int = 100) -> Column:
    """Page size from the mean of the last six counts, half as much again, within bounds."""
    mean = F.avg(counts).over(Window.partitionBy(*_cols(keys)).orderBy(*order).rowsBetween(-5, 0))
    return F.least(F.greatest(F.ceil(mean * 1.5), F.lit(low)), F.lit(high)).cast("int")
