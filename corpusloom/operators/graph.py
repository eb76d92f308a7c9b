"""Connected components and pointer chains."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only in local mode, where none is set."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        where = f"file://{tempfile.gettempdir()}/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """End the lineage: written to the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.loom_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete what cut() wrote."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.loom_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of an edge, root the least node it reaches.

    Each round hangs every node's neighbours on the least of them; rounds grow with the logarithm of the
    longest path, and a round's result is written, so plans stay short and lost executors redo one round.
    """
    links = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    nodes = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b).alias("node"))).distinct()
    seen = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = cut(both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        after = cut(down.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        drop(links)
        drop(up)
        links = after
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = links.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select("node", F.coalesce("root", "node").alias("root"))


def follow(pointers: DataFrame, source: str, target: str, hops: int = 8) -> DataFrame:
    """Where each pointer ends after at most so many hops; doubled each round, so three joins make eight hops."""
    out = pointers.select(source, target)
    done = 1
    while done < hops:
        step = out.select(F.col(source).alias("_s"), F.col(target).alias("_t"))
        out = out.join(step, out[target] == step["_s"], "left").select(source, F.coalesce("_t", target).alias(target))
        done *= 2
    return out
