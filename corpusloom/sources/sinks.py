"""Sinks: idempotent day-partitioned appends, upserts, swaps, sharded documents, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich
from ..operators.windows import fitting_prefix


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def append_new(batch: DataFrame, path: str, key: str = "id", day: str = "et_date") -> None:
    """Append the rows whose key the touched days lack; a replayed batch adds nothing.

    Only the partitions of the batch's days are read for the anti-join.
    """
    spark = batch.sparkSession
    fs, p = _fs(spark, path)
    fresh = batch.dropDuplicates([key])
    if fs.exists(p):
        days = batch.select(day).distinct()
        known = spark.read.schema(batch.schema).parquet(path).join(days, day, "left_semi").select(key)
        fresh = fresh.join(known, key, "left_anti")
    fresh.repartition(day).sortWithinPartitions(day, key).write.mode("append").partitionBy(day).parquet(path)


def overwrite_days(df: DataFrame, path: str, day: str = "et_date") -> None:
    """Replace the partitions of the days that df holds, and no others."""
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def swap(df: DataFrame, path: str) -> None:
    """Write aside, then take the old version's place.

    The old version is deleted last, and put back if the new one can't take its place.  A reader that comes
    between the two renames finds no table and has to try again; none ever sees a part of one.
    """
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    aside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    at = spark._jvm.org.apache.hadoop.fs.Path
    old, new, had = at(f"{aside}-old"), at(aside), fs.exists(p)
    if had and not fs.rename(p, old):
        fs.delete(new, True)
        raise OSError(f"{path} can't be moved; it stays as it was")
    if not fs.rename(new, p):
        if had and not fs.rename(old, p):
            raise OSError(f"{path} can't be replaced; the old version is in {aside}-old, the new one in {aside}")
        fs.delete(new, True)
        raise OSError(f"{path} can't be replaced; it stays as it was")
    if had:
        fs.delete(old, True)


def upsert_metrics(new: DataFrame, path: str) -> None:
    """Metrics after another pass, as a whole new version."""
    spark = new.sparkSession
    fs, p = _fs(spark, path)
    old = spark.read.parquet(path) if fs.exists(p) else new.limit(0)
    swap(enrich.upsert_metrics(old, new), path)


def upsert_phrases(uses: DataFrame, path: str) -> None:
    """K07, ST12: the ledger of first uses after another day: the least day of each author and phrase, as a whole new version."""
    from ..operators.phrases import member_first

    spark = uses.sparkSession
    fs, p = _fs(spark, path)
    swap(member_first(uses, spark.read.parquet(path) if fs.exists(p) else None), path)


def seed_metrics(posts: DataFrame, metrics: DataFrame, as_of: Column) -> DataFrame:
    """Rows for originals older than a day that have none yet, from what was captured."""
    old = posts.filter((F.col("type") != "retweet") & (F.col("created") <= as_of - F.expr("INTERVAL 24 HOURS")))
    return old.join(metrics.select("post_id"), "post_id", "left_anti").select("post_id", F.col("engagement").alias("refreshed"), F.lit(False).alias("unavailable"), F.lit(True).alias("from_capture"))


def embed_new(posts: DataFrame, index: DataFrame, embed, model: str) -> DataFrame:
    """The index with vectors for posts that lack one; another model's vectors are made anew.

    embed: a scalar pandas UDF from text to array<float>.
    """
    kept = index.filter(F.col("model") == model)
    fresh = posts.select("post_id", "text").join(kept.select("post_id"), "post_id", "left_anti")
    return kept.unionByName(fresh.select("post_id", F.lit(model).alias("model"), embed("text").alias("embedding")).select(*kept.columns))


def sharded_feed(rows: DataFrame, cap: int, per_shard: int = 400) -> tuple[DataFrame, DataFrame]:
    """The newest rows whose JSON fits a cap, and the others with a shard key of their content.

    rows: id, created, doc (JSON).  Days are the buckets in which the cap is looked for.
    """
    size = F.octet_length("doc") + 1
    fit = fitting_prefix(rows, size, cap, F.desc("created"), F.desc("id"), bucket=-F.unix_date(F.to_date("created")))
    rest = rows.join(fit.select("id"), "id", "left_anti")
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(F.to_date("created")).orderBy(F.desc("created"), F.desc("id")))
    numbered = rest.withColumn("_day", F.to_date("created")).withColumn("_n", F.floor((place - 1) / per_shard))
    named = numbered.groupBy("_day", "_n").agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list("id").cast("array<string>")), ","), 256), 1, 16).alias("shard"))
    return fit, numbered.join(named, ["_day", "_n"]).drop("_day", "_n")


def report(title: str, sections: list[tuple[str, DataFrame, int]]) -> str:
    """Markdown of a few small results: heading, rows to show; each section takes its first rows only."""
    out = [f"# {title}"]
    for heading, df, most in sections:
        out += ["", f"## {heading}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(most).collect()]
    return "\n".join(out) + "\n"


def render_taxonomy(taxonomy: DataFrame) -> DataFrame:
    """one text per macro: its subs in order with their aliases; retired ones are left out."""
    live = taxonomy.filter(~F.coalesce("retired", F.lit(False)) & F.col("sub").isNotNull())
    line = F.concat(F.lit("  "), F.col("sub"), F.when(F.size("aliases") > 0, F.concat(F.lit(": "), F.array_join(F.sort_array("aliases"), ", "))).otherwise(""))
    return live.groupBy("macro").agg(F.concat(F.col("macro"), F.lit("\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("text"))


def taxonomy_changes(taxonomy: DataFrame, changes: DataFrame) -> DataFrame:
    """The taxonomy after changes (macro, sub, op, value): add, retire, rename, alias, merge; replaying is no change."""
    one = lambda op: changes.filter(F.col("op") == op).select("macro", "sub", F.col("value").alias(f"_{op}"))
    fresh = changes.filter("op = 'add'").select("macro", "sub", F.col("value").alias("sub_label")).join(taxonomy.select("macro", "sub"), ["macro", "sub"], "left_anti").dropDuplicates(["macro", "sub"])
    out = taxonomy.unionByName(fresh, allowMissingColumns=True)
    alias = changes.filter("op = 'alias'").groupBy("macro", "sub").agg(F.collect_set("value").alias("_alias"))
    for extra in (one("retire"), one("rename"), one("merge"), alias):
        out = out.join(extra.dropDuplicates(["macro", "sub"]), ["macro", "sub"], "left")
    nothing = F.array().cast("array<string>")
    return out.select(
        "macro", "sub", F.coalesce("_rename", "sub_label").alias("sub_label"), F.sort_array(F.array_union(F.coalesce("aliases", nothing), F.coalesce("_alias", nothing))).alias("aliases"),
        (F.coalesce("retired", F.lit(False)) | F.col("_retire").isNotNull() | F.col("_merge").isNotNull()).alias("retired"), F.coalesce("_merge", "merged_into").alias("merged_into"),
    )
