"""Contiguous shards of near-equal bytes (operator 11).

Rows stand in one global order.  Each partition of that order reports its bytes
and rows; prefix sums of these totals (one entry per partition, not per row)
tell every partition where it begins, so with its own running sums each row
knows the bytes before it in the whole table.  Cuts at equal byte targets then
give contiguous shards: a row belongs to the shard in whose stretch its middle
byte lies, so a shard is off its target by less than one row at either end.

No row is grouped with others by a key, so a hot source or a group of equal
texts is cut like any other stretch of the order.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import stored, text_or_empty, unused

#: Shards of the registered query.
SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def document_size(text: str = "text"):
    """UTF-8 bytes of a text (null: none) and of the row around it."""
    return (F.octet_length(text_or_empty(text)) + ROW_BYTES).cast("bigint")


def assign(rows: DataFrame, shards: int = SHARDS, size: str = "size",
           order: tuple[str, ...] | None = ("doc_id",)) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (place in it, from 0).

    ``size`` names a column of positive whole numbers.  The global order is that
    of ``order`` (null first; rows alike there by a hash of all columns), for
    which the rows are sorted once across the cluster; with ``order=None`` it is
    the order in which they are partitioned, and nothing is shuffled.  Only what
    ``rows`` carries moves: keep texts out where the assignment alone is wanted.

    Repeated rows get a slot each; an empty table gives an empty one.  There may
    be fewer rows than shards: the shards between them stay empty.
    """
    part, before, place, tie, number, start, first, low = unused(
        rows, "part", "before", "place", "tie", "number", "start", "first_row", "low")
    laid = rows
    if order:
        keys = [F.col(c).asc_nulls_first() for c in order]
        laid = rows.withColumn(tie, F.xxhash64(*rows.columns))
        # Equal rows may be dealt to several partitions: a number of their own parts them.
        laid = laid.withColumn(number, F.monotonically_increasing_id())
        laid = laid.repartitionByRange(*keys, F.col(tie), F.col(number)).sortWithinPartitions(
            *keys, F.col(tie), F.col(number)).select(*rows.columns)

    def running(batches):
        at, total, upto = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = pc.cast(batch.column(batch.schema.get_field_index(size)), pa.int64())
            if not len(sizes):
                continue
            ends = pc.add(pc.cumulative_sum(sizes), total)
            columns = [pa.array([at] * len(sizes), pa.int32()), pc.subtract(ends, sizes),
                       pa.array(range(upto, upto + len(sizes)), pa.int64())]
            total, upto = ends[-1].as_py(), upto + len(sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns],
                                             names=[*batch.schema.names, part, before, place])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = stored(laid.mapInArrow(running, f"{kinds}, `{part}` int, `{before}` bigint, `{place}` bigint"),
                    "shard-rows")

    # One entry per partition: as few as the stage had tasks.
    totals = placed.groupBy(part).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n"))
    found = sorted(tuple(x) for x in totals.collect())
    upto_bytes = [0, *accumulate(x[1] for x in found)]
    upto_rows = [0, *accumulate(x[2] for x in found)]
    begins = rows.sparkSession.createDataFrame(
        [(x[0], b, r) for x, b, r in zip(found, upto_bytes, upto_rows, strict=False)],
        f"`{part}` int, `{start}` bigint, `{first}` bigint")
    # Twice the middle byte, so that halves stay whole numbers.
    middle = (F.col(start) + F.col(before)) * 2 + F.col(size)
    shard = F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (2 * max(upto_bytes[-1], 1))))
    dealt = placed.join(F.broadcast(begins), part).select(
        *rows.columns, (F.col(first) + F.col(place)).alias(place), shard.cast("int").alias("shard"))
    lows = dealt.groupBy("shard").agg(F.min(place).alias(low))  # at most `shards` rows
    return dealt.join(F.broadcast(lows), "shard").select(
        *rows.columns, "shard", (F.col(place) - F.col(low)).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, order: tuple[str, ...] | None = ("doc_id",)) -> str:
    """The documents as Parquet, a folder ``shard=N`` per shard, in slot order in each file.

    Shards are contiguous, so a task holds rows of a few neighbouring ones and
    writes as few files.
    """
    (size,) = unused(docs, "size")
    assign(docs.withColumn(size, document_size()), shards, size, order).drop(size).write.partitionBy("shard").parquet(path)
    return path
