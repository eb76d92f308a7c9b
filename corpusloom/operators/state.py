"""State of jobs: contracts with error codes, budgets, journals, merges, queues."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reply_errors(replies: DataFrame, expected: DataFrame, taxonomy: DataFrame, most_topics: int = 4) -> DataFrame:
    """Error codes per expected id: missing, duplicate, unexpected, too many topics, unknown topic, foreign evidence.

    replies: post_id, topics (array of macro/sub), evidence (array); expected: post_id, supplied (array); taxonomy: macro, sub.
    """
    n = Window.partitionBy("post_id")
    known = taxonomy.select(F.col("macro").alias("_m")).distinct()
    bad = replies.select("post_id", F.explode("topics").alias("t")).join(known, F.col("t.macro") == F.col("_m"), "left_anti").select("post_id").distinct().withColumn("_bad", F.lit(True))
    rows = replies.withColumn("_n", F.count("*").over(n)).join(bad, "post_id", "left")
    both = expected.withColumn("_e", F.lit(True)).join(rows, "post_id", "full_outer")
    code = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    codes = F.array(
        code(F.col("_n").isNull(), "missing"), code(F.col("_e").isNull(), "unexpected"), code(F.col("_n") > 1, "duplicate"),
        code(F.size("topics") > most_topics, "too-many-topics"), code(F.col("_bad"), "unknown-topic"),
        code(F.size(F.array_except("evidence", F.coalesce("supplied", F.array().cast("array<string>")))) > 0, "foreign-evidence"),
    )
    return both.select("post_id", F.filter(codes, lambda c: c.isNotNull()).alias("errors")).distinct()


def input_errors(events: DataFrame, cutoff: Column) -> DataFrame:
    """Error codes of event input: id, times, type, acquisition."""
    code = lambda test, name: F.when(F.coalesce(test, F.lit(True)), F.lit(name))
    codes = F.array(
        code(~F.col("id").rlike("^[0-9]{1,30}$"), "id"), code(F.col("created") > cutoff, "created-after-cutoff"),
        code(~F.col("type").isin("tweet", "quote", "reply", "retweet"), "type"), F.when(F.col("captured").isNull(), F.lit("acquisition-unknown")).when(F.col("captured") > cutoff, F.lit("acquired-after-cutoff")),
    )
    return events.withColumn("errors", F.filter(codes, lambda c: c.isNotNull()))


def output_errors(supports: DataFrame, posts: DataFrame) -> DataFrame:
    """Per event whether all supports name an input post and quote it literally; one bad support rejects the event."""
    joined = supports.join(posts.select(F.col("id"), "text"), "id", "left")
    ok = F.col("text").isNotNull() & F.coalesce(F.col("text").contains(F.col("quote")), F.lit(False))
    return joined.groupBy("event").agg(F.bool_and(ok).alias("accepted"), F.count_if(F.col("text").isNull()).alias("unknown_ids"), F.count_if(F.col("text").isNotNull() & ~F.coalesce(F.col("text").contains(F.col("quote")), F.lit(False))).alias("loose_quotes"))


def event_counts(members: DataFrame, as_of: Column, least: int = 3) -> DataFrame:
    """Posts, accounts and people of events, in all and in 24 hours, and whether enough people are in."""
    from ..functions import timefn as T

    young = T.within_hours(F.col("created"), as_of, 24)
    when = lambda c: F.countDistinct(F.when(young, F.col(c)))
    out = members.groupBy("event").agg(F.countDistinct("post_id").alias("posts"), F.countDistinct("author_id").alias("accounts"), F.countDistinct("member").alias("people"), when("post_id").alias("posts24"), when("author_id").alias("accounts24"), when("member").alias("people24"))
    return out.withColumn("shown", F.col("people") >= least)


def collect_results(replies: DataFrame, manifest: DataFrame) -> DataFrame:
    """State of each chunk: done for exactly one reply, else missing or duplicate; replies without a chunk are passed over."""
    n = replies.groupBy("custom_id").agg(F.count("*").alias("n"), F.min("body").alias("body"))
    return manifest.join(n, "custom_id", "left").select("custom_id", F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise("done").alias("state"), F.when(F.col("n") == 1, F.col("body")).alias("body"))


def manifest(lines: DataFrame) -> DataFrame:
    """Per chunk its ids and a hash of its lines; lines: chunk, position, post_id, line."""
    own = lines.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("position", "post_id", "line"))).alias("x"))
    return own.select("chunk", F.transform("x", lambda r: r["post_id"]).alias("ids"), F.sha2(F.array_join(F.transform("x", lambda r: r["line"]), "\n"), 256).alias("hash"))


def pack(sizes: DataFrame, group: str, order: str, weight: str, most_rows: int = 40, most_weight: int = 120_000) -> DataFrame:
    """Chunks in order, a new one when rows or weight would exceed their bounds.

    A group's rows run through one task in order, of which only the present chunk's rows and weight are kept,
    so time is linear in the rows and memory doesn't grow with them; groups are days.
    """
    rows = sizes.select(group, order, F.col(weight).cast("bigint").alias(weight)).repartition(group).sortWithinPartitions(group, order, weight)
    kinds = dict(rows.dtypes)

    def run(batches):
        chunk, n, total, present, begun = 0, 0, 0, None, False
        for batch in batches:
            out = []
            for g, w in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not begun or g != present:
                    chunk, n, total, present, begun = 0, 0, 0, g, True
                over = total is not None and w is not None and total + w > most_weight
                if n >= most_rows or (n > 0 and over):
                    chunk, n, total = chunk + 1, 1, w
                else:
                    n, total = n + 1, None if total is None or w is None else total + w
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "chunk"])

    return rows.mapInArrow(run, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, `{weight}` bigint, chunk int")


def blocked(lines: DataFrame, most: int = 120_000) -> DataFrame:
    """Lines too long to send, with their hash."""
    return lines.filter(F.length("line") > most).select("post_id", F.length("line").alias("chars"), F.sha2("line", 256).alias("hash"))


def reserve(requests: DataFrame, budget: Column, order: str = "requested") -> DataFrame:
    """Whether each request still fits the day's budget after those before it."""
    before = F.coalesce(F.sum("bound").over(Window.partitionBy("day").orderBy(order, "request_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return requests.withColumn("reserved_before", before).withColumn("accepted", F.col("reserved_before") + F.col("bound") <= budget)


def record_usage(journal: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts to add; equal ones are known already, one that contradicts the journal is an error."""
    old = journal.select("receipt_id", F.col("posts").alias("_p"))
    joined = receipts.dropDuplicates(["receipt_id", "posts"]).join(old, "receipt_id", "left")
    clash = F.col("_p").isNotNull() & (F.col("_p") != F.col("posts"))
    checked = joined.withColumn("posts", F.when(clash, F.raise_error(F.concat(F.lit("receipt changed: "), F.col("receipt_id"))).cast("bigint")).otherwise(F.col("posts")))
    return checked.filter(F.col("_p").isNull() | (F.col("posts") < 0)).drop("_p")


def lookup_response(wanted: DataFrame, found: DataFrame, errors: DataFrame) -> DataFrame:
    """State of each wanted id: resolved for one distinct body, conflicting for several, unavailable for a terminal error alone."""
    n = found.groupBy("post_id").agg(F.countDistinct("text").alias("bodies"), F.min("text").alias("text"))
    e = errors.groupBy("post_id").agg(F.bool_and("terminal").alias("terminal"))
    state = F.when(F.col("bodies") == 1, "resolved").when(F.col("bodies") > 1, "conflicting").when(F.coalesce("terminal", F.lit(False)), "unavailable").otherwise("unresolved")
    return wanted.join(n, "post_id", "left").join(e, "post_id", "left").select("post_id", state.alias("state"), F.when(F.col("bodies") == 1, F.col("text")).alias("text"))


def remaining_plan(pending: DataFrame, reconsider: DataFrame, corrected: DataFrame) -> DataFrame:
    """Posts to classify: pending or to reconsider, less those corrected by hand."""
    return pending.select("post_id").union(reconsider.select("post_id")).distinct().join(corrected.select("post_id"), "post_id", "left_anti")


def source_status(posts: DataFrame, originals: DataFrame) -> DataFrame:
    """Completeness of reposts: invalid reference, mismatch, empty, unavailable or complete, and a fingerprint."""
    o = originals.select(F.col("post_id").alias("ref_id"), F.col("text").alias("_t"), F.col("claimed_id").alias("_c"))
    state = (
        F.when(~F.coalesce(F.col("ref_id").cast("string").rlike("^[0-9]+$"), F.lit(False)), "repost-reference-invalid").when(F.col("_c").isNull(), "repost-original-unavailable")
        .when(F.col("_c") != F.col("ref_id"), "repost-original-mismatch").when(F.trim(F.coalesce("_t", F.lit(""))) == "", "repost-original-empty").otherwise("complete")
    )
    return posts.filter("type = 'retweet'").join(o, "ref_id", "left").select("post_id", state.alias("state"), F.sha2(F.to_json(F.struct("ref_id", "_t")), 256).alias("fingerprint"))


def merge_state(base: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Three-way merge of single-valued groups of fields (name, value as JSON): the side that changed wins; both changed differently: an error."""
    b, x, y = (d.select("name", F.col("value").alias(p)) for p, d in (("b", base), ("x", ours), ("y", theirs)))
    every = b.join(x, "name", "full_outer").join(y, "name", "full_outer")
    same = F.col("x").eqNullSafe(F.col("y"))
    merged = F.when(same | F.col("y").eqNullSafe(F.col("b")), F.col("x")).when(F.col("x").eqNullSafe(F.col("b")), F.col("y")).otherwise(F.raise_error(F.concat(F.lit("conflict in "), F.col("name"))).cast("string"))
    return every.select("name", merged.alias("value"))


def pilot_exclusion(cases: DataFrame) -> DataFrame:
    """The first reason that keeps a case out of a pilot; cases: corrected, source_incomplete, pending, n_posts."""
    reason = F.when(F.col("corrected"), "corrected").when(F.col("source_incomplete"), "source incomplete").when(F.col("pending"), "pending").when(F.col("n_posts") < 2, "single post")
    return cases.withColumn("excluded", reason)
