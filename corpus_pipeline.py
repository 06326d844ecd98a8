"""A corpus pipeline of five stages over the table documents.

Quality rules (rejected documents go, failing lines too), toxicity (rejected
documents go), near duplicates (the smallest id of each group of linked
documents stays), benchmark decontamination (documents that leak an item go),
packing into training sequences. Each stage reads all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontamination, ngram_join, packing, quality_rules, toxicity
from weftline.llm.common import scratch, table


#: Arcs of a generation of the token machine: executors still hold what earlier stages took, so fewer than in a job of its own.
ARCS_HELD = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.clean(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, arcs_held=ARCS_HELD)


STAGES = [
    ("quality rules", quality),
    ("toxicity", harmless),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed),
]

#: Trained scores and token ids can't be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder and read back by the next. Only the last one's stay there."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as keep_last:
        for _, stage in STAGES[:-1]:
            with scratch(spark) as keep:
                docs = keep(stage(spark, docs, sf_dir), "stage")
        return keep_last(STAGES[-1][1](spark, docs, sf_dir), "stage")
