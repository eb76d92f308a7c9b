"""Line dedup: repeated runs of lines from a suffix array over line ids, built by prefix doubling.

The texts are sequences of line ids (128-bit hashes of lines with a word), one after another in
order of doc_id and ended by the end of the document.  Ranks at level k order the suffixes by their
first 2**k lines: level 0 ranks the lines, level k + 1 the pairs of ranks 2**k lines apart, sorted by
range partitions, with order-preserving ids as names.  Suffixes whose prefix occurs once anywhere are
discarded at each level, so only repeated lines travel.  All suffixes with one rank form an interval
of the suffix array whose longest common prefix has 2**k lines or more; a run of l lines is the
interval named by (l, rank of its first 2**k lines, rank of its last 2**k lines), 2**k <= l.

What goes.  A run of at least ``MIN_WORDS`` words that also occurs earlier is deleted; the earliest
copy stays.  Every line of such a run lies in the shortest run of MIN_WORDS words that begins at the
run's first line, or in the shortest one that ends at the line itself; both are inside the run, so
testing these two per line finds the lines of all maximal repeated runs, and since each line has a
word they have MIN_WORDS lines at most: six levels suffice, however long a repeated run is.

Scale.  One pass hashes lines; of the lines, only ids, positions and word counts are shuffled.  Groups
are partially aggregated and joined back, so a line that a third of all documents share is split by
AQE; no group meets in one task.  Each level is written, so lost executors repeat one level at most.

Defined results: null or empty text has no lines.  Rows that agree in doc_id and text are one document
and get one verdict.  A null doc_id comes last, ordered by a hash of the text.  Blank lines are no
part of the sequences; those between two deleted lines go with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import cut, drop, small_batches, table

MIN_WORDS = 50
SALTS = 16
#: Documents with deletions, and deletions, up to which these are broadcast.
BROADCAST_DOCS, BROADCAST_RUNS = 100_000, 500_000


def line_table(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, doc (hash of the text), line (among lines with a word), words, and the line's id (h1, h2)."""
    small_batches(df.sparkSession)

    def run(batches):
        K.own("linededup")
        for batch in batches:
            ids, docs = batch.column(0), batch.column(1)
            for b in K.blocks(batch.column(2)):
                s, e, owner = K.lines(b)
                ws, _, _ = K.words(b)
                words = np.searchsorted(ws, e) - np.searchsorted(ws, s)
                full = words > 0
                s, e, owner, words = s[full], e[full], owner[full], words[full]
                count = K.per_doc(owner, len(b.off) - 1)
                line = np.arange(len(s)) - np.repeat(np.cumsum(count) - count, count)
                at = pa.array(owner + b.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), docs.take(at), pa.array(line), pa.array(words), pa.array(K.signed(K.Hasher(b.data)(s, e))), pa.array(K.signed(K.Hasher(b.data, 1)(s, e)))],
                    names=["doc_id", "doc", "line", "words", "h1", "h2"],
                )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", F.xxhash64(text).alias("doc"), F.col(text).alias("_text")).mapInArrow(run, f"doc_id {kind}, doc bigint, line bigint, words bigint, h1 bigint, h2 bigint")


def _rank(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """The keys that occur twice or more, with names in the order of the keys."""
    again = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    return cut(again.repartitionByRange(*key).sortWithinPartitions(*key).withColumn(name, F.monotonically_increasing_id()))


def suffix_ranks(lines: DataFrame, levels: int) -> DataFrame:
    """pos, line, words and r0, r1, ... of each repeated line; rk is null if no other suffix has the same 2**k lines.

    pos grows with (doc_id, doc, line); lines of one document have consecutive blocks of it.
    """
    lines = cut(lines)
    named = _rank(lines, ["h1", "h2"], "r0")
    rows = lines.join(named, ["h1", "h2"]).select("doc_id", "doc", "line", "words", "r0").dropDuplicates(["doc_id", "doc", "line"])
    order = [F.asc_nulls_last("doc_id"), F.asc("doc"), F.asc("line")]
    rows = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()))
    drop(lines, named)
    for k in range(levels):
        beyond = Window.partitionBy("doc_id", "doc").orderBy("line").rangeBetween(2**k, 2**k)
        a, b, name = f"r{k}", f"r{k}_", f"r{k + 1}"
        paired = cut(rows.withColumn(b, F.max(a).over(beyond)))
        named = _rank(paired.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), [a, b], name)
        after = cut(paired.join(named, [a, b], "left").drop(b))
        drop(rows, paired, named)
        rows = after
        if not rows.filter(F.col(name).isNotNull()).limit(1).count():
            break
    return rows


def _shortest_runs(ranks: DataFrame, min_words: int) -> DataFrame:
    """doc_id, doc, pos, line, n, a, b: shortest runs of min_words words that may occur elsewhere too."""
    levels = sorted((c for c in ranks.columns if c[0] == "r"), key=lambda c: int(c[1:]))

    def runs(pos, line, key, words, rank):
        """key numbers documents; rank: -1 for none."""
        n = len(pos)
        new = np.ones(n, bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1] + 1)
        part = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)  # end of each unbroken run
        total = np.concatenate([[0], np.cumsum(words)])
        here = np.arange(n)
        end = np.searchsorted(total, total[:-1] + min_words)  # first end with enough words
        ahead = end <= last[part]
        start = np.searchsorted(total, total[1:] - min_words, "right") - 1  # last start with enough words
        back = start >= first[part]
        s = np.concatenate([here[ahead], start[back]])
        e = np.concatenate([end[ahead], here[back] + 1])
        size = e - s
        level = np.minimum(np.log2(np.maximum(size, 1)).astype(int), 62)
        fits = level < len(levels)
        s, e, size, level = s[fits], e[fits], size[fits], level[fits]
        a, b = rank[level, s], rank[level, e - (1 << level)]
        both = (a >= 0) & (b >= 0)
        return np.unique(np.stack([s[both], size[both], a[both], b[both]], 1), axis=0)

    def run(batches):
        K.own("linededup")
        held = None

        def made(t):
            key = np.concatenate([[0], np.cumsum([x != y for x, y in zip(t["k"][1:], t["k"][:-1], strict=True)])]) if len(t["k"]) else np.zeros(0)
            rank = np.stack([t[c] for c in levels])
            found = runs(t["pos"], t["line"], key, t["words"], rank)
            i = pa.array(found[:, 0])
            return pa.RecordBatch.from_arrays([t["doc_id"].take(i), t["doc"].take(i), pa.array(t["pos"][found[:, 0]]), pa.array(t["line"][found[:, 0]]), pa.array(found[:, 1]), pa.array(found[:, 2]), pa.array(found[:, 3])], names=["doc_id", "doc", "pos", "line", "n", "a", "b"])

        def columns(batch):
            ids, docs = batch.column("doc_id"), batch.column("doc")
            t = {"doc_id": ids, "doc": docs, "k": list(zip(ids.to_pylist(), docs.to_pylist(), strict=True))}
            return t | {c: batch.column(c).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pos", "line", "words", *levels)}

        for batch in batches:  # the last document may go on in the next batch
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch] if held else [batch]).combine_chunks().to_batches()[0]
            d, i = whole.column("doc").to_numpy(), whole.column("doc_id").to_pylist()
            cutoff = whole.num_rows
            while cutoff and d[cutoff - 1] == d[-1] and i[cutoff - 1] == i[-1]:
                cutoff -= 1
            if cutoff:
                yield made(columns(whole.slice(0, cutoff)))
            held = [whole.slice(cutoff)]
        if held:
            yield made(columns(held[0]))

    kind = ranks.schema["doc_id"].dataType.simpleString()
    ordered = ranks.repartition("doc_id", "doc").sortWithinPartitions("doc_id", "doc", "line")
    return ordered.mapInArrow(run, f"doc_id {kind}, doc bigint, pos bigint, line bigint, n bigint, a bigint, b bigint")


def deletions(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, doc, runs): per document with deletions, the runs (line, n) to delete, overlaps included."""
    ranks = suffix_ranks(line_table(df, text), max(1, int(min_words).bit_length() - 1))
    runs = cut(_shortest_runs(ranks, min_words))
    # a run that very many documents share is dealt over SALTS keys; its first copy is told to those that have rows
    dealt = runs.withColumn("salt", F.pmod(F.xxhash64("pos"), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy("n", "a", "b", "salt").agg(F.min("pos").alias("least"), F.max("pos").alias("most"))
    first = parts.groupBy("n", "a", "b").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.collect_set("salt").alias("salts")).filter("least < most")
    later = dealt.join(first.select("n", "a", "b", "least", F.explode("salts").alias("salt")), ["n", "a", "b", "salt"]).filter("pos > least")
    out = cut(later.groupBy("doc_id", "doc").agg(F.sort_array(F.collect_list(F.struct("line", "n"))).alias("runs")))
    drop(ranks, runs)
    return out


def delete_lines(df: DataFrame, gone: DataFrame, text: str = "text") -> DataFrame:
    """df with its texts shortened, and columns _lines, _deleted (counts of lines with a word) and _runs ("line:n", merged)."""
    named = gone.withColumnsRenamed({"doc_id": "_id", "doc": "_doc", "runs": "_gone"})
    size = gone.agg(F.count("*"), F.sum(F.size("runs"))).first()
    if size[0] <= BROADCAST_DOCS and (size[1] or 0) <= BROADCAST_RUNS:
        named = F.broadcast(named)
    joined = df.join(named, df["doc_id"].eqNullSafe(named["_id"]) & (F.xxhash64(df[text]) == named["_doc"]), "left")
    keep = [c for c in df.columns if c != text]
    order = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    small_batches(df.sparkSession)

    def run(batches):
        K.own("linededup")
        for batch in batches:
            texts = batch.column(batch.num_columns - 2)
            counts, dropped, merged, out = [], [], [], []
            for b in K.blocks(texts):
                s, e, owner = K.lines(b)
                ink = np.concatenate([[0], np.cumsum(~K.DELIM[b.data])])
                full = ink[e] > ink[s]
                counts.append(np.bincount(owner[full], minlength=len(b.off) - 1))
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            runs = batch.column(batch.num_columns - 1)
            changed = {}
            for i in np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False)):
                x = texts[i].as_py()
                pieces = x.split("\n")
                full = np.array([bool(p.strip(" \t\n\x0b\x0c\r")) for p in pieces])
                at = np.flatnonzero(full)
                mark = np.zeros(len(at) + 1, int)
                for r in runs[i].as_py():
                    mark[r["line"]] += 1
                    mark[r["line"] + r["n"]] -= 1
                bad = np.cumsum(mark)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], bad.astype(int), [0]])))
                away = np.zeros(len(pieces), bool)
                for a, z in zip(edge[::2], edge[1::2], strict=True):
                    away[at[a] : at[z - 1] + 1] = True
                changed[i] = ("\n".join(p for p, w in zip(pieces, away, strict=True) if not w), int(bad.sum()), ",".join(f"{a}:{z - a}" for a, z in zip(edge[::2], edge[1::2], strict=True)))
            if changed:
                listed = texts.to_pylist()
                for i, (new, _, _) in changed.items():
                    listed[i] = new
                texts = pa.array(listed, pa.string())
            n = batch.num_rows
            made = [pa.array(counts.astype(np.int64)), pa.array([changed[i][1] if i in changed else 0 for i in range(n)], pa.int64()), pa.array([changed[i][2] if i in changed else "" for i in range(n)], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], texts, *made], names=[*keep, text, "_lines", "_deleted", "_runs"])

    shape = ", ".join([*order, f"`{text}` string", "_lines bigint", "_deleted bigint", "_runs string"])
    return joined.select(*keep, text, "_gone").mapInArrow(run, shape)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = delete_lines(docs, deletions(docs))
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_deleted").alias("n_deleted"), F.col("_runs").alias("runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs; those of which nothing is left go."""
    gone = deletions(docs)
    inner = docs.toDF(*["doc_id" if c == "doc_id" else f"d{i}" for i, c in enumerate(docs.columns)])
    at = {c: inner.columns[i] for i, c in enumerate(docs.columns)}
    out = delete_lines(inner, gone, at["text"]).filter("_deleted = 0 or _deleted < _lines")
    fresh = {"n_chars": F.when(F.col("_deleted") > 0, F.length(at["text"])).otherwise(F.col(at["n_chars"])).cast(docs.schema["n_chars"].dataType)} if "n_chars" in at else {}
    return out.select(*[fresh.get(c, F.col(at[c])).alias(c) for c in docs.columns])
