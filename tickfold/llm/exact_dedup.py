"""Exact dedup over a persistent digest index (operator 5).

The index is a table of one row per distinct normalised text, bucketed and
sorted by its SHA-256.  A batch of documents is reduced to one row per digest
before anything is compared; those rows are laid out like the buckets, so the
sort-merge anti-join against the index moves only them, and the digests that
are new are appended.  Everything runs as DataFrame operations.

A batch has an id of the caller's and a partition of the index.  Adding it again,
after a failure or by a retry, takes its partition away first, so the decisions
are the same as the first time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickfold.llm.common import BLANKS, join_classes, new_path, stored, text_or_empty, unused


def text_digest(text: str = "text"):
    """Lower-case hex SHA-256 of the text with each run of blanks made one space."""
    return F.sha2(F.regexp_replace(text_or_empty(text), BLANKS, " "), 256)


class DigestIndex:
    """Digest -> id of the document that stays, in ``buckets`` sorted buckets.

    ``path`` keeps the index across sessions (its files are the index; the
    catalog entry is made again when it is opened); the number of buckets
    belongs to the index and must be the same each time.  ``close`` (or leaving a
    ``with`` block) drops the catalog entry; the decisions of ``add`` stay readable.
    """

    COLUMNS = "digest STRING, keep_id BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")
        if path and self._exists(path):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def compacted(self, path: str) -> DigestIndex:
        """A new index at ``path`` with one sorted file a bucket, which a scan reads in
        order: each batch that is added makes one more.  It knows all batches so
        far as one; don't add one of them to it again."""
        made = DigestIndex(self.spark, path, self.buckets)
        rows = self.rows().select("digest", "keep_id", F.lit("compacted").alias("batch"))
        rows.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(made.name)
        self.spark.catalog.refreshTable(made.name)
        return made

    def _exists(self, path: str, delete: bool = False) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(where) and (not delete or files.delete(where, True))

    def _take_back(self, batch: str) -> None:
        if self._exists(f"{self.path}/batch={batch}"):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch = '{batch}')")
            self._exists(f"{self.path}/batch={batch}", delete=True)
            self.spark.catalog.refreshTable(self.name)

    def add(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Decide a batch and append its new digests; one row per document.

        ``batch`` (letters, digits, dashes) names it: adding a batch that is known
        replaces what it brought before and gives the same answer.

        Columns: doc_id, text_sha256, keep_id (of this or an earlier batch),
        group_size (rows of this batch with that text), id_rows (rows of the
        batch that share the smallest id of that text), kept.

        A null text counts as empty.  Rows that repeat a doc_id with the same
        text get the same decision (``deduplicate`` leaves one of them).  A
        null doc_id stays only where no row of that text has an id.  An empty
        table gives an empty one.
        """
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        self._take_back(batch)
        digests = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                     text_digest().alias("digest")), "digests")
        ids = digests.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
        groups = stored(ids.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"),
            F.min_by("n", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("id_rows"),
            F.sum("n").alias("group_size")), "digest-groups")
        laid_out = groups.repartition(self.buckets, "digest")
        fresh = laid_out.hint("merge").join(self.rows(), "digest", "left_anti")
        (fresh.select("digest", F.col("first_id").alias("keep_id"), F.lit(batch).alias("batch"))
         .sortWithinPartitions("digest").write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)
        lookup = laid_out.hint("merge").join(self.rows(), "digest").select(
            "digest", "group_size", "id_rows", "keep_id", (F.col("batch") == batch).alias("new"))
        lookup = stored(lookup, "digest-decisions")
        return join_classes(digests, groups, lookup, "digest").select(
            "doc_id", F.col("digest").alias("text_sha256"), "keep_id", "group_size", "id_rows",
            (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The documents whose text is new, one row of each text, with their columns.

    Of rows that repeat both text and doc_id, the one whose columns hash lowest
    stays.  An empty table gives an empty one.  Without an ``index`` the texts are
    new to an empty one.
    """
    own = index or DigestIndex(docs.sparkSession)
    decided = stored(own.add(docs, batch), "dedup")
    if index is None:
        own.close()
    key, number, digest, ident = unused(docs, "digest", "number", "text_sha256", "kept_id")
    keep = decided.filter("kept").select(F.col("text_sha256").alias(digest),
                                         F.col("doc_id").alias(ident), "id_rows")
    again = not keep.filter("id_rows > 1").isEmpty()
    keep = (keep.distinct() if again else keep).drop("id_rows")
    kept = docs.withColumn(key, text_digest()).join(
        keep, (F.col(key) == F.col(digest))
        & F.col("doc_id").cast("bigint").eqNullSafe(F.col(ident)), "left_semi")
    if again:
        order = Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns))
        kept = kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1)
    return kept.select(*docs.columns)
