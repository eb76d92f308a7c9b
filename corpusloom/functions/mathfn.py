"""Rounding, scores, costs and vectors as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with value computed once; a lambda would compute what it names again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def half_up(x: Column) -> Column:
    """Nearest integer, halves towards positive infinity."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def places(x: Column, n: int) -> Column:
    """F64: x to n decimal places, halves towards positive infinity."""
    return F.floor(x * F.lit(float(10**n)) + F.lit(0.5)).cast("double") / F.lit(float(10**n))


def or_one(x: Column) -> Column:
    """x, or 1 where it is 0, null or no number."""
    return F.coalesce(F.nullif(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(half_up(F.lit(100.0) * part / F.nullif(whole, F.lit(0))), F.lit(0).cast("bigint"))


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def _half(x: Column) -> Column:
    return F.lit(0.5) + F.lit(0.5) * clamp(x)


def momentum(groups: Column, trend: Column, change: Column, people: Column, people_mean: Column, engagement: Column, per_post: Column) -> Column:
    """Struct of score (0 to 100), five components and the two that drive it most.

    groups: posts of the day per group; trend: seven days, the oldest first; change: of the day against
    the six before, in percent; per_post: mean engagement of a post in the week.
    """
    t = lambda i: F.get(trend, F.lit(i)).cast("double")
    total = F.aggregate(groups, F.lit(0.0), lambda a, x: a + x.cast("double"))
    mean = F.aggregate(trend, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(trend)
    volume = _half(change / F.lit(50.0))
    acceleration = _half(((t(6) - t(4)) / 2 - (t(4) - t(0)) / 4) / (or_one(mean) * F.lit(0.1)))
    adoption = _half(((people - people_mean) / or_one(people_mean)) / F.lit(0.5))
    shares = F.aggregate(groups, F.lit(0.0), lambda a, x: a + (x / total) * (x / total))
    effective = F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) / shares)
    spread = (effective - 1) / F.greatest(F.lit(1), F.size(groups) - 1)
    lift = _half((F.when(total > 0, engagement / total).otherwise(F.lit(0.0)) / or_one(per_post) - 1) / F.lit(0.5))
    parts = {"volume": volume, "acceleration": acceleration, "adoption": adoption, "spread": spread, "engagement": lift}
    weights = {"volume": 0.4, "acceleration": 0.2, "adoption": 0.2, "spread": 0.1, "engagement": 0.1}
    score = half_up(F.lit(100.0) * reduce(lambda a, b: a + b, [F.lit(weights[k]) * v for k, v in parts.items()]))
    ranked = F.array_sort(F.array(*[F.struct((-v).alias("v"), F.lit(k).alias("k")) for k, v in parts.items()]))
    drivers = F.transform(F.slice(ranked, 1, 2), lambda x: x["k"])
    return F.struct(score.alias("score"), *[v.alias(k) for k, v in parts.items()], drivers.alias("drivers"))


def read_cost(posts: Column, users: Column) -> Column:
    """Dollars for posts and users read."""
    return posts * F.lit(0.005) + users * F.lit(0.01)


def token_cost(fresh: Column, made: Column, read: Column, written: Column, batch: Column, price_in: float = 5.0, price_out: float = 25.0) -> Column:
    """Dollars for tokens by kind, prices per million; cached reads cost a tenth, writes a quarter more, batches half."""
    usd = (fresh * F.lit(price_in) + read * F.lit(price_in * 0.1) + written * F.lit(price_in * 1.25) + made * F.lit(price_out)) / F.lit(1e6)
    return usd * F.when(batch, F.lit(0.5)).otherwise(F.lit(1.0))


def cost_bound(prompt: Column, most_out: Column, price_in: float = 5.0, price_out: float = 25.0) -> Column:
    """Upper bound of a call's cost before it is made: a byte is a token at most."""
    return (F.octet_length(prompt) * F.lit(price_in) + most_out * F.lit(price_out)) / F.lit(1e6)


def page_size(remaining: Column, wanted: Column, low: int = 5, high: int = 100) -> Column:
    """Rows to ask for: what is wanted, within the bounds and what the budget leaves; 0 if that is below the least."""
    size = F.least(F.greatest(wanted, F.lit(low)), F.lit(high))
    return F.when(remaining < low, 0).otherwise(F.least(size, remaining)).cast("int")


# -- vectors -------------------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalise(v: Column) -> Column:
    """F61."""
    wide = F.transform(v, lambda x: x.cast("double"))
    return F.when(v.isNotNull(), let(F.struct(wide.alias("v"), norm(v).alias("n")), lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])).otherwise(s["v"])))


def cosine(a: Column, b: Column) -> Column:
    """F62."""
    return F.coalesce(dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0)), F.lit(0.0))


def quantise(v: Column) -> Column:
    """Struct of scale and values in -127 to 127."""
    top = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    value = lambda x, scale: F.greatest(F.lit(-127), F.least(F.lit(127), half_up(x.cast("double") / scale))).cast("tinyint")
    return let(F.when(top > 0, top / 127).otherwise(F.lit(1.0)), lambda scale: F.struct(scale.alias("scale"), F.transform(v, lambda x: value(x, scale)).alias("q")))


def dequantise(q: Column) -> Column:
    return let(q, lambda s: normalise(F.transform(s["q"], lambda x: x.cast("double") * s["scale"])))
