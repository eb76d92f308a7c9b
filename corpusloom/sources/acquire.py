"""Acquisition without a network: a paged stream source around an injected client, lookups, queues and journals."""

from __future__ import annotations

import importlib
import json
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..operators.windows import ranked

MAX_XML, MAX_NODES, MAX_DEPTH = 1_000_000, 10_000, 12


def client(name: str):
    """A function named "module:function"; it takes the options and a cursor and returns (rows, next cursor)."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class PagedSource(DataSource):
    """S18, S19, S20, ST01, ST02, ST13: pages of an API as a stream; the offset is the cursor after the last complete batch.

    Options: client ("module:function"), schema, pages (most per batch); all are handed to the client.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["schema"]

    def simpleStreamReader(self, schema):  # noqa: N802
        return _PagedReader(self.options)


class _PagedReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)

    def initialOffset(self):  # noqa: N802
        return {"cursor": self.options.get("since", "")}

    def read(self, start):
        fetch, cursor, rows = client(self.options["client"]), start["cursor"], []
        for _ in range(int(self.options.get("pages", 10))):
            page, following = fetch(self.options, cursor)
            rows += page
            if following is None or following == cursor:
                break
            cursor = following
        return iter(rows), {"cursor": cursor}

    def readBetweenOffsets(self, start, end):  # noqa: N802
        fetch, cursor = client(self.options["client"]), start["cursor"]
        while cursor != end["cursor"]:
            page, following = fetch(self.options, cursor)
            yield from page
            if following is None or following == cursor:
                break
            cursor = following


def lookup(ids: DataFrame, function: str, schema: str, batch: int = 100) -> DataFrame:
    """Records of ids in batches through a client; ids that it doesn't return are unavailable."""

    def run(frames):
        fetch = client(function)
        for pdf in frames:
            keys = pdf["post_id"].tolist()
            for i in range(0, len(keys), batch):
                part = keys[i : i + batch]
                found = {r["post_id"]: r for r in fetch(part)}
                yield pd.DataFrame([{"post_id": k, "unavailable": k not in found, "record": json.dumps(found[k]) if k in found else None} for k in part])

    kind = ids.schema["post_id"].dataType.simpleString()
    out = ids.select("post_id").distinct().mapInPandas(run, f"post_id {kind}, unavailable boolean, record string")
    return out.withColumn("record", F.from_json("record", schema))


def included(pages: DataFrame) -> DataFrame:
    """The original that a page includes for each reference, with five counts; pages: post_id, ref_id, includes (array of id, text, metrics)."""
    own = F.get(F.filter("includes", lambda x: x["id"] == F.col("ref_id")), F.lit(0))
    return pages.withColumn("original", own)


def _xml_fault(text: str | None) -> str | None:
    if not text or not text.strip():
        return "empty"
    if len(text) > MAX_XML:
        return "too large"
    head = text.lower()
    if "<!doctype" in head or "<!entity" in head:
        return "declares types or entities"
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return "malformed"
    nodes, todo = 0, [(root, 1)]
    while todo:
        node, depth = todo.pop()
        nodes += 1
        if "}" in node.tag or ":" in node.tag:
            return "namespace"
        if nodes > MAX_NODES:
            return "too many nodes"
        if depth > MAX_DEPTH:
            return "too deep"
        todo += [(child, depth + 1) for child in node]
    return None


def check_xml(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Df with fault, why a document isn't of the strict subset of XML, or null."""
    names = df.columns

    def run(frames):
        for pdf in frames:
            yield pdf.assign(fault=[_xml_fault(x) for x in pdf[xml]])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", fault string"
    return df.select(*names).mapInPandas(run, shape)


def pending_queue(pending: DataFrame, fresh: DataFrame, done: DataFrame, cap: int = 120) -> tuple[DataFrame, DataFrame]:
    """ST09: the queue after a poll (what waits and what is new, less what is done) and the first so many to take, the oldest first."""
    queue = pending.unionByName(fresh).dropDuplicates(["post_id"]).join(done.select("post_id"), "post_id", "left_anti")
    return queue, queue.orderBy("created", "post_id").limit(cap)


def backfill_plan(users: DataFrame, progress: DataFrame, start: Column) -> DataFrame:
    """ST13, V14, V40, V41: where each user's backfill goes on; a token without a page, or progress of no user, is an error."""
    joined = users.join(progress.withColumnRenamed("user_id", "_u"), F.col("user_id") == F.col("_u"), "full_outer")
    bad = F.col("user_id").isNull() | (F.col("token").isNotNull() & (F.coalesce("pages", F.lit(0)) < 1))
    state = F.when(bad, F.raise_error(F.lit("progress that fits no user")).cast("string")).when(F.coalesce("done", F.lit(False)), "done").when(F.col("token").isNotNull(), "continue").otherwise("start")
    return joined.select("user_id", state.alias("state"), "token", start.alias("start"))


def embedded_to_cache(posts: DataFrame, cache: DataFrame) -> DataFrame:
    """Embedded originals that the shared cache lacks, each once."""
    own = posts.filter("embedded_id is not null and embedded is not null").select(F.col("embedded_id").alias("post_id"), F.col("embedded").alias("text"))
    return own.dropDuplicates(["post_id"]).join(cache.select("post_id"), "post_id", "left_anti")


JOB_STEPS = {"prepared": ("submitted", "cancelled"), "submitted": ("processing", "unknown"), "processing": ("finished", "failed", "unknown"), "unknown": ("processing", "finished", "failed")}


def job_states(journal: DataFrame) -> DataFrame:
    """ST14, ST15, V13: the state of each job from its journal (job_id, position, state); a step that isn't allowed is an error.

    An unknown outcome is asked for again, never sent again.
    """
    w = Window.partitionBy("job_id").orderBy("position")
    allowed = F.create_map(*[x for k, v in JOB_STEPS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    before = F.lag("state").over(w)
    ok = F.when(before.isNull(), F.col("state") == "prepared").otherwise(F.coalesce(F.array_contains(F.try_element_at(allowed, before), F.col("state")), F.lit(False)))
    checked = journal.withColumn("_ok", ok).withColumn("state", F.when(F.col("_ok"), F.col("state")).otherwise(F.raise_error(F.concat(F.lit("step not allowed in "), F.col("job_id").cast("string"))).cast("string")))
    return ranked(checked, "job_id", F.desc("position"), 1).select("job_id", "state", F.col("state").isin("prepared").alias("may_submit"))


def superseded(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """ST15: runs whose source has changed since; their results don't count."""
    return runs.join(sources.select("case_id", F.col("hash").alias("_h")), "case_id", "left").withColumn("state", F.when(F.col("hash").eqNullSafe(F.col("_h")), F.col("state")).otherwise("superseded")).drop("_h")


def plan_key(*parts: Column) -> Column:
    """SHA-256 over the parts as JSON, in their order."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


RANK = {"prepared": 0, "submitted": 1, "unknown": 2, "failed": 3, "finished": 4}


def merge_journals(base: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Three journals of requests (request_id, state, value): the furthest state wins; two ends that differ are an error."""
    order = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])
    every = base.unionByName(ours).unionByName(theirs).withColumn("_r", F.element_at(order, F.col("state")))
    top = every.groupBy("request_id").agg(F.max("_r").alias("_t"))
    last = every.join(top, "request_id").filter("_r = _t").groupBy("request_id").agg(F.min("state").alias("state"), F.min("value").alias("value"), F.countDistinct("value").alias("_n"))
    return last.select("request_id", "state", F.when(F.col("_n") <= 1, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("two outcomes of "), F.col("request_id").cast("string"))).cast("string")).alias("value"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def pinned(spark: SparkSession, path: str, version: str, schema: str) -> DataFrame:
    """A table as of a version, each of which has a folder of its own."""
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def bounded_json(text: Column, most: int = 100_000) -> Column:
    """JSON as a variant; null if it is malformed or larger than so many values."""
    return F.when(F.size(F.split(text, "[,\\[{]")) <= most, F.try_parse_json(text))


def receipt_fault(status: Column, asked: Column, got: Column) -> Column:
    """Why a receipt contradicts itself, or null."""
    return F.when(~status.isin("ok", "partial", "failed"), "status").when((status == "ok") & (asked != got), "ok but incomplete").when((status == "failed") & (got > 0), "failed but with results").when((status == "partial") & ((got == 0) | (got >= asked)), "partial but not in part")


def without_later(context: Column, cutoff: Column) -> Column:
    """Context fields known at a cutoff; if the time of acquisition is unknown it is incomplete."""
    return F.when(context["captured"].isNull(), F.struct(F.lit(None).cast("string").alias("text"), F.lit(True).alias("incomplete"))).when(context["captured"] > cutoff, F.struct(F.lit(None).cast("string").alias("text"), F.lit(False).alias("incomplete"))).otherwise(F.struct(context["text"].alias("text"), F.lit(False).alias("incomplete")))
