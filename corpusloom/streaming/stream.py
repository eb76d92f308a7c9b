"""Structured Streaming: idempotent ingest, rolling windows, sessions, lifecycles, stream-static joins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import shared_folder
from ..sources import sinks

LATE = "48 hours"


def read_posts(spark: SparkSession, path: str, schema, fmt: str = "parquet", files: int = 100) -> DataFrame:
    """ST01, ST19: posts as files arrive; the number per batch bounds a batch's size."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def ingest(stream: DataFrame, archive: str, checkpoint: str, key: str = "id", day: str = "et_date") -> StreamingQuery:
    """ST02, ST03, ST04: append unseen posts to the archive, each to the partition of its own day however late it comes.

    A batch that is run again after a failure finds its rows in the archive and adds nothing; the offsets
    in the checkpoint move on only after the batch is done.
    """

    def write(batch: DataFrame, _: int) -> None:
        sinks.append_new(batch, archive, key, day)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe(stream: DataFrame, key: str = "id", ts: str = "created", late: str = LATE) -> DataFrame:
    """ST03: each id once, as long as its repeats come within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def rolling(stream: DataFrame, keys: list[str], ts: str = "created", size: str = "7 days", slide: str = "1 day", late: str = LATE) -> DataFrame:
    """ST06: counts and sums per key in sliding windows."""
    out = stream.withWatermark(ts, late).groupBy(F.window(ts, size, slide), *keys).agg(F.count("*").alias("posts"), F.sum("engagement").cast("bigint").alias("engagement"), F.approx_count_distinct("author_id").alias("authors"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("stop"), *keys, "posts", "engagement", "authors")


def daily(stream: DataFrame, keys: list[str], ts: str = "created", late: str = LATE) -> DataFrame:
    """ST06: counts per key and day."""
    out = stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day"), *keys).agg(F.count("*").alias("posts"))
    return out.select(F.to_date("window.start").alias("day"), *keys, "posts")


def sessions(stream: DataFrame, keys: list[str], ts: str = "created", gap: str = "48 hours", late: str = LATE) -> DataFrame:
    """ST07: runs of a key without a pause of the gap."""
    out = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("posts"), F.max(ts).alias("last"))
    return out.select(F.col("session_window.start").alias("start"), "last", *keys, "posts")


def with_metrics(stream: DataFrame, metrics: DataFrame) -> DataFrame:
    """ST05: posts with the metrics of a static table, which each batch reads anew."""
    return stream.join(metrics, "post_id", "left")


def inherit(reposts: DataFrame, originals: DataFrame, days: int = 2) -> DataFrame:
    """ST10: reposts joined to originals of the same day or so many before; state is dropped behind the watermark."""
    a = reposts.withWatermark("created", LATE).alias("a")
    b = originals.select(F.col("post_id").alias("ref"), F.col("created").alias("ref_created"), "macro").withWatermark("ref_created", LATE).alias("b")
    near = (F.col("a.ref_id") == F.col("b.ref")) & (F.col("b.ref_created") <= F.col("a.created")) & (F.col("b.ref_created") >= F.col("a.created") - F.expr(f"INTERVAL {days + 1} DAYS"))
    return a.join(b, near, "inner").select("a.post_id", "b.macro")


def lifecycles(stream: DataFrame, key: str = "incident", ts: str = "created", late: str = "1 hour") -> DataFrame:
    """ST08: active on each new post, monitoring after 12 quiet hours of event time, resolved after 36."""
    steps = [("monitoring", 12), ("resolved", 36)]

    def run(k, frames, state):
        last, stage = state.get if state.exists else (0, -1)
        if state.hasTimedOut:
            now, names = state.getCurrentWatermarkMs(), []
            # the watermark may have passed several steps at once
            while stage + 1 < len(steps) and (not names or last + steps[stage + 1][1] * 3_600_000 <= now):
                stage += 1
                names.append(steps[stage][0])
            if stage + 1 < len(steps):
                state.update((last, stage))
                state.setTimeoutTimestamp(max(last + steps[stage + 1][1] * 3_600_000, now + 1))
            else:
                state.remove()
            yield pd.DataFrame({key: [k[0]] * len(names), "phase": names, "last": [pd.Timestamp(last, unit="ms")] * len(names)})
            return
        last = max([last, *(int(f[ts].max().timestamp() * 1000) for f in frames)])
        state.update((last, -1))
        state.setTimeoutTimestamp(max(last + steps[0][1] * 3_600_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [k[0]], "phase": ["active"], "last": [pd.Timestamp(last, unit="ms")]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.withWatermark(ts, late).groupBy(key).applyInPandasWithState(run, f"{key} {kind}, phase string, last timestamp", "last bigint, stage int", "append", "EventTimeTimeout")


def reevaluate(rows: DataFrame, version: Column) -> DataFrame:
    """ST11: rows whose context is older than the version that now holds; corrected ones stay."""
    return rows.filter((F.coalesce("context_version", F.lit(-1)) < version) & ~F.coalesce("corrected", F.lit(False)))


def run_to_end(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drive a stream over what there is and return its rows.

    Appended rows go to files in the shared folder, so they never meet in the driver.  In complete mode,
    which files can't follow, the memory table keeps the last state of the groups: for small results.
    """
    spark = df.sparkSession
    if mode == "append":
        path = f"{shared_folder(spark)}/stream-{name}"
        q = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(df.schema).parquet(path)
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
