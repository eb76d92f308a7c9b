"""What the operators of this subpackage share on the DataFrame side."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as K

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one of fewer files than there are cores is dealt out to all of them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def small_batches(spark: SparkSession) -> None:
    """Whole texts make heavy rows: bound the rows that one Arrow batch holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", K.BATCH_ROWS)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only in local mode, where it names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        found = f"file://{tempfile.gettempdir()}/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: lineage ends, columns stay prunable."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/loom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.loom_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Delete what cut() wrote, as soon as nothing reads it any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.loom_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A side is broadcast only after its rows were counted and found to be no more than this.
BROADCAST_ROWS = 20_000


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast small if a count proves it small; else an ordinary join, whose skew AQE splits."""
    if small.limit(limit + 1).count() <= limit:
        small = F.broadcast(small)
    cond = functools.reduce(lambda a, b: a & b, [big[c].eqNullSafe(small[c]) for c in on])
    joined = big.join(small, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[small[c] for c in on])


def crc_mod(column: str, m: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(m)


def bounded_sample(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """Up to n rows per group, those of least hash of key.

    Group sizes give a threshold that about 4 n rows of a group pass; only these are ordered, so the
    rows that meet in a task don't grow with the input.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    near = join_small(df, sizes, [group], "inner").withColumn("_p", place).filter(F.col("_p") < 4.0 * n / F.col("_n"))
    own = Window.partitionBy(group).orderBy("_p", key)
    return near.withColumn("_r", F.row_number().over(own)).filter(F.col("_r") <= n).drop("_r", "_p", "_n")
