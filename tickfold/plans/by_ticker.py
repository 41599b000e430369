"""Tables of a run laid out by ticker: bucketed, and sorted within the buckets.

The silver core written this way is shuffled once.  The day state, the coarser
states and a company join that is too large for a broadcast then find their rows
where they are: no exchange of the silver or state side.  A ticker has one row
per hour, however many trades it has, so no bucket grows with a hot ticker.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class TickerTables:
    """Writes tables under ``folder``; leaving the block drops their catalog entries
    (not the files, which belong to the run)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []

    def __enter__(self) -> TickerTables:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.clear()

    def write(self, df: DataFrame, label: str, by: str, placed: bool = False) -> DataFrame:
        """``df`` as a table bucketed by ticker and sorted by (ticker, ``by``).

        ``placed``: ``df`` is made from such a table without an exchange, so its
        tasks are the buckets already; any other is shuffled once, so that a task
        writes one file.  Null tickers share a bucket; an empty ``df`` gives an
        empty table.
        """
        name = f"tickfold_{label}_{uuid.uuid4().hex}"
        laid = df if placed else df.repartition(self.buckets, "ticker")
        self.names.append(name)
        (laid.write.format("parquet").bucketBy(self.buckets, "ticker").sortBy("ticker", by)
         .option("path", f"{self.folder}/{label}").saveAsTable(name))
        return self.spark.table(name)
