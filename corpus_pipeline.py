"""A training-data pipeline: five stages over documents, each written as Parquet and read again.

Quality rules reject outliers; line dedup deletes later copies of repeated runs of lines, and the
documents of which nothing is left; near-dedup keeps one document of each group; mixing repeats or
drops documents to meet the sources' quotas; encoding gives the token ids' digests of what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.bpe import bpe_stage
from corpusloom.llm.common import cut, drop, table
from corpusloom.llm.linededup import line_stage
from corpusloom.llm.mixing import mixing_stage
from corpusloom.llm.neardup import neardup_stage
from corpusloom.llm.quality import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", neardup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: SQL can't express the robust estimates or the registers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        kept = cut(stage(spark, docs, sf_dir))
        if n:
            drop(docs)  # written by the stage before, read by this one only
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
