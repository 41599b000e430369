"""Files that hold one JSON array, read by many tasks each (S3).

A parser has to start at the first byte, so ``multiLine`` gives a whole file to
one task.  Here a file is cut anywhere: the text source deals it out in splits
of lines that end at ``}``.  What a split needs to know of the bytes before it is
whether it starts inside a string and how many brackets are open:

1. each split counts its quotes, and its brackets for either case;
2. running sums over the splits of a file (one row each) give every split its
   start;
3. each split then emits the elements that lie in it, and the head and tail of
   those that go beyond it, which are put together by order.

A ``}`` ends an element where it leaves just the array open.  It never follows an
odd backslash in JSON, so no escape is cut in two.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickfold.session import scratch_path

#: Blanks and what stands between the elements.
_BETWEEN = "\ufeff \t\r\n,["
#: What each byte adds to the open brackets; ``}`` ends the lines and is in none.
_BRACKETS = np.zeros(256, np.int8)
_BRACKETS[[ord("{"), ord("[")]], _BRACKETS[ord("]")] = 1, -1
#: More splits than these are larger ones: each costs two tasks of their own Python.
MAX_SPLITS = 200
MAX_SPLIT_BYTES = 1 << 27


@contextmanager
def _splits(spark: SparkSession, split_bytes: int | None) -> Iterator[None]:
    """Splits that don't depend on how many executors there are at the time."""
    wanted = {"spark.sql.files.minPartitionNum": "1"}
    if split_bytes:
        wanted["spark.sql.files.maxPartitionBytes"] = str(split_bytes)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _runs(batch):
    """Of each split in ``batch``: its first row (without the text), and the text of its
    lines as bytes with the offsets of the lines."""
    *first, value = batch.columns
    changed = np.flatnonzero(np.diff(first[1].to_numpy())) + 1
    ends = pc.run_end_encode(first[0]).run_ends.to_numpy()
    bounds = np.unique(np.concatenate([[0], changed, ends]))
    value = value.cast(pa.large_string())
    _, places, data = value.buffers()
    offsets = np.frombuffer(places, np.int64)[value.offset:value.offset + len(value) + 1]
    text = np.frombuffer(data or b"", np.uint8)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield [c[a].as_py() for c in first], text[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _quotes(text: np.ndarray, offsets: np.ndarray, before: int) -> np.ndarray:
    """Quotes up to each byte, and ``before`` in front of the first; escaped ones don't count."""
    quote = text == ord('"')
    slash = text == ord("\\")
    if slash.any():
        at = np.flatnonzero(quote)
        # The last byte before a quote that is no backslash, or the end of the line before.
        other = np.maximum.accumulate(np.where(slash, -1, np.arange(len(text))))
        line = offsets[np.searchsorted(offsets, at, "right") - 1] - 1
        quote[at[(at - 1 - np.maximum(np.where(at > 0, other[at - 1], -1), line)) % 2 == 1]] = False
    return np.concatenate([[before], before + np.cumsum(quote)])


def _count(batches):
    """(file, start, quotes, outside, inside) of each split: its quotes, and how many more
    brackets are open at its end if it starts outside or inside a string."""
    key, quotes, outside, inside = None, 0, 0, 0

    def batch():
        return pa.RecordBatch.from_pydict({
            "file": [key[0]], "start": [key[1]], "quotes": [quotes], "outside": [outside], "inside": [inside]})

    for b in batches:
        for first, text, offsets in _runs(b):
            if first != key:
                if key:
                    yield batch()
                key, quotes, outside, inside = first, 0, 0, 0
            seen = _quotes(text, offsets, quotes)
            more = _BRACKETS[text]
            odd = int(more[seen[1:] % 2 == 1].sum())
            ends = seen[offsets[1:]] % 2  # where the bracket is that ended the line
            outside += int(more.sum()) - odd - int((ends == 0).sum())
            inside += odd - int(ends.sum())
            quotes = int(seen[-1])
    if key:
        yield batch()


def _cut(batches):
    """(file, start, part, value): whole elements (part "whole"), and of those beyond the
    split the "tail" that begins one, the "middle" and the "head" that ends one."""
    key, quoted, depth, held, inner = None, 0, 0, [], False

    def batch(part, data, offsets):
        n = len(offsets) - 1
        values = pa.StringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        parts = [part, *["whole"] * (n - 1)]
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(key[0], pa.string()), n), pa.repeat(
            pa.scalar(key[1], pa.int64()), n), pa.array(parts, pa.string()), values], names=["file", "start", "part", "value"])

    def rest():
        data = b"".join(held)
        return batch("middle" if inner else "tail", data, np.array([0, len(data)]))

    for b in batches:
        for (file, start, q, d), text, offsets in _runs(b):
            if (file, start) != key:
                if held:
                    yield rest()
                key, quoted, depth, held = (file, start), q, d, []
                inner = quoted == 1 or depth > 1  # it starts within an element
            n = len(offsets) - 1
            seen = _quotes(text, offsets, quoted) % 2
            more = np.where(seen[1:] == 0, _BRACKETS[text], 0)
            open_ = np.concatenate([[depth], depth + np.cumsum(more, dtype=np.int64)])
            ends = seen[offsets[1:]]
            levels = open_[offsets[1:]] - np.cumsum(ends == 0)
            quoted, depth = int(ends[-1]), int(levels[-1])
            # The text with the bracket that ended each line.
            offsets = offsets + np.arange(n + 1)
            whole = np.full(offsets[-1], ord("}"), np.uint8)
            kept = np.ones(offsets[-1], bool)
            kept[offsets[1:] - 1] = False
            whole[kept] = text
            cuts = offsets[1:][(levels == 1) & (ends == 0)]
            if len(cuts):
                before = b"".join(held)
                yield batch("head" if inner else "whole", before + whole[:cuts[-1]].tobytes(),
                            np.concatenate([[0], cuts + len(before)]))
                held, inner, whole = [], False, whole[cuts[-1]:]
            if len(whole):
                held.append(whole.tobytes())
    if held:
        yield rest()


def _split_size(spark: SparkSession, path: str, split_bytes: int) -> int:
    """``split_bytes``, or more (up to MAX_SPLIT_BYTES) where there would be more than MAX_SPLITS splits."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(split_bytes, min(size // MAX_SPLITS, MAX_SPLIT_BYTES))


def array_elements(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``value``: the text of each object of the JSON arrays in the files at ``path``.

    The files are cut at ``split_bytes`` (default: the session's), or more where there
    would be more than MAX_SPLITS.  Elements are
    written once, under the checkpoint folder, and read from there, so the splits
    of both passes are alike.  What can't be an element (an object cut off at the
    end of a file) is a value too, which no parser will take; values between the
    objects stay in front of the next one.
    """
    out = scratch_path(spark, "array-elements")
    with _splits(spark, split_bytes and _split_size(spark, path, split_bytes)):
        lines = spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
        counts = lines.mapInArrow(_count, "file string, start bigint, quotes bigint, outside bigint, inside bigint")
        before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        quoted = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
        starts = counts.withColumn("quoted", quoted).withColumn(
            "more", F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))).select(
            F.col("file").alias("f"), F.col("start").alias("s"), "quoted",
            F.coalesce(F.sum("more").over(before), F.lit(0)).alias("depth"))
        where = scratch_path(spark, "array-splits")
        starts.write.parquet(where)
        starts = spark.read.schema(starts.schema).parquet(where)
        # One row per split, hundreds of bytes for many megabytes of text.
        known = lines.join(F.broadcast(starts), (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")
        at = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit("the splits of a file have changed"))).alias(c)
        pieces = known.select("file", "start", at("quoted"), at("depth"), "value").mapInArrow(
            _cut, "file string, start bigint, part string, value string")
        pieces.write.parquet(out)
    pieces = spark.read.schema(pieces.schema).parquet(out)
    whole = pieces.where("part = 'whole'").select("value")
    # At most two pieces a split: a tail begins an element, in its split after the head of another.
    order = Window.partitionBy("file").orderBy("start", (F.col("part") == "tail").cast("int"))
    cut = pieces.where("part <> 'whole'").withColumn(
        "element", F.sum((F.col("part") == "tail").cast("int")).over(order)).groupBy("file", "element").agg(
        F.max((F.col("part") == "head").cast("int")).alias("ended"),
        F.sort_array(F.collect_list(F.struct("start", "value"))).alias("found"))
    text = F.array_join(F.transform("found", lambda x: x["value"]), "")
    # The last line of a file has a bracket too many.
    text = F.when(F.col("ended") == 1, text).otherwise(F.regexp_replace(text, r"\}$", ""))
    cut = cut.select(text.alias("value"))
    trimmed = whole.unionByName(cut).select(F.ltrim(F.col("value"), F.lit(_BETWEEN)).alias("value"))
    return trimmed.where(~F.trim("value").rlike(r"^[\]\s]*$"))


def write_array(df: DataFrame, path: str) -> str:
    """The rows as JSON, one array in each file (one file per task)."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"}).alias("value"))

    def bracketed(batches):
        lead = "["
        for b in batches:
            if len(b):
                leads = pa.concat_arrays([pa.array([lead]), pa.repeat(pa.scalar(","), len(b) - 1)])
                lead = ","
                values = pc.binary_join_element_wise(leads, b.column(0), "")
                yield pa.RecordBatch.from_arrays([values], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if lead == "," else "[]"])], names=["value"])

    lines.mapInArrow(bracketed, "value string").write.option("lineSep", "\n").text(path)
    return path
