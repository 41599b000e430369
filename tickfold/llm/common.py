"""Helpers shared by the operators: tables, shared storage, column names."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word separator of every contract: blank, tab, LF, VT, FF, CR.
BLANKS = "[\\x20\\x09-\\x0D]+"
#: A class with more than one in HOT_SHARE of all rows is looked up in a
#: broadcast table, which by arithmetic has fewer than HOT_SHARE rows.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a local session find this package wherever it was started;
    # on a cluster it comes with --py-files.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local session that names none (tests) gets a temporary one; any other
    session without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:16]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage without a machine-local copy, so a lost executor costs a
    re-read, and gives the optimizer the true size of what follows.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names starting like ``names`` that ``df`` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def join_classes(rows: DataFrame, classes: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``lookup``, which has one row per class ``key``.

    ``classes`` and ``lookup`` have the rows of a class as ``group_size``.
    Large classes are looked up by broadcast, so their rows never meet in one
    task; the others go through a sort-merge join.
    """
    total = classes.agg(F.coalesce(F.sum("group_size"), F.lit(0))).head()[0]
    values = [c for c in lookup.columns if c != key]
    packed = lookup.select(F.col(key).cast("string").alias("at"), F.struct(*values).alias("found"))
    hot = packed.filter(F.col("found.group_size") * HOT_SHARE > total)
    hot = hot.select(F.col("at").alias("hot_at"), F.col("found").alias("hot"))
    marked = rows.join(F.broadcast(hot), F.col(key).cast("string") == F.col("hot_at"), "left")
    # A hot row has its answer: give it a key that no class has, each another.
    marked = marked.withColumn("at", F.when(F.col("hot").isNull(), F.col(key).cast("string"))
                               .otherwise(F.concat(F.lit("~"), F.monotonically_increasing_id())))
    joined = marked.hint("merge").join(packed, "at", "left")
    return joined.select(*rows.columns, *[
        F.coalesce(F.col(f"hot.{c}"), F.col(f"found.{c}")).alias(c) for c in values])
