"""The corpus as the queries see it: posts, roster, topics and metrics over the driver's tables.

Each DataFrame has a DuckDB twin in ``SQL``; both use integers (cents) for amounts, so sums agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import table

#: The moment that all queries look from, one day past the last event.
AS_OF = "2024-01-31 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def posts(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "view", "retweet").when(F.col("event_type") == "purchase", "quote").when(F.col("event_type") == "error", "reply").otherwise("tweet")
    p = table(spark, d, "events").select(
        F.col("event_id").alias("post_id"), F.col("user_id").alias("author_id"), F.floor(F.col("user_id") / 2).cast("bigint").alias("member"), F.col("ts").alias("created"), F.to_date("ts").alias("day"),
        kind.alias("type"), F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("engagement"), k.alias("k"),
    )
    ref = F.col("post_id") - 1 - F.col("k")
    return p.select(
        "*", F.concat(F.lit("m"), F.floor(F.col("k") / 10).cast("string")).alias("macro"), F.when(F.col("k") % 10 != 0, F.concat(F.lit("s"), F.col("k").cast("string"))).alias("sub"),
        F.when((F.col("type") != "tweet") & (ref >= 0), ref).alias("ref_id"),
    )


def roster(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("c_custkey").alias("author_id"), F.col("c_name").alias("name"), F.array(F.col("r_name"), F.concat(F.lit("seg-"), F.col("c_mktsegment"))).alias("groups"), F.when(F.col("c_nationkey") % 5 == 0, "senate").otherwise("house").alias("status"))


def topics(p: DataFrame) -> DataFrame:
    """post_id, macro, sub: one topic of its own for each post, for every third a second one without a sub."""
    own = p.select("post_id", "macro", "sub")
    more = p.filter("k % 3 = 0").select("post_id", F.concat(F.lit("m"), ((F.col("k") * 7) % 10).cast("string")).alias("macro"), F.lit(None).cast("string").alias("sub"))
    return own.union(more).distinct()


def with_topic_arrays(p: DataFrame) -> DataFrame:
    own = F.struct(F.col("macro"), F.col("sub"))
    more = F.struct(F.concat(F.lit("m"), ((F.col("k") * 7) % 10).cast("string")).alias("macro"), F.lit(None).cast("string").alias("sub"))
    return p.withColumn("topics", F.when(F.col("k") % 3 == 0, F.array(own, more)).otherwise(F.array(own)))


def metrics(spark: SparkSession, d: str) -> DataFrame:
    """Late metrics for a part of the posts: line items per order; some are unavailable."""
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("post_id")).agg(F.sum("l_quantity").cast("bigint").alias("refreshed"), (F.min("l_linenumber") > 3).alias("unavailable"))


SQL = """
p0 AS (
  SELECT event_id AS post_id, user_id AS author_id, user_id // 2 AS member, ts AS created, CAST(ts AS DATE) AS day,
         CASE event_type WHEN 'view' THEN 'retweet' WHEN 'purchase' THEN 'quote' WHEN 'error' THEN 'reply' ELSE 'tweet' END AS type,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS engagement, CAST(props->>'k' AS INT) AS k
  FROM events
), posts AS (
  SELECT *, 'm' || (k // 10) AS macro, CASE WHEN k % 10 <> 0 THEN 's' || k END AS sub,
         CASE WHEN type <> 'tweet' AND post_id - 1 - k >= 0 THEN post_id - 1 - k END AS ref_id FROM p0
), roster AS (
  SELECT c_custkey AS author_id, c_name AS name, [r_name, 'seg-' || c_mktsegment] AS groups, CASE c_nationkey % 5 WHEN 0 THEN 'senate' ELSE 'house' END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), topics AS (
  SELECT post_id, macro, sub FROM posts UNION SELECT post_id, 'm' || ((k * 7) % 10), NULL FROM posts WHERE k % 3 = 0
), metrics AS (
  SELECT l_orderkey AS post_id, CAST(sum(l_quantity) AS BIGINT) AS refreshed, min(l_linenumber) > 3 AS unavailable FROM lineitem GROUP BY 1
)"""
