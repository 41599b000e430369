"""The corpus pipeline, over the table ``documents``.

1. quality rules: documents that fail the adaptive thresholds go;
2. exact dedup: one document of each text stays;
3. SimHash near-dedup: one document of each component stays;
4. mixing: documents are sampled to raked source, language and topic weights;
5. packing: what is left becomes sequences of at most 2048 tokens.

Each stage reads what the one before wrote as Parquet and calls one operator of
``tickfold.llm``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickfold.llm.common import stored, table
from tickfold.llm.exact_dedup import deduplicate
from tickfold.llm.mixing import sample
from tickfold.llm.packing import pack
from tickfold.llm.quality_rules import keep_good
from tickfold.llm.simhash import near_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality", quality), ("exact-dedup", exact), ("near-dedup", near), ("mixing", mix),
          ("packing", packed)]

#: SimHash, raking and tokenising are not SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
