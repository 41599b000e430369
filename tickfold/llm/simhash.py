"""SimHash near-duplicates by pivot distance tables (operator 9).

Fingerprints within MAX_BITS differing bits are linked; a component is what
links reach.  Distances to PIVOTS reference fingerprints are computed once per
distinct fingerprint.  Two fingerprints within MAX_BITS differ by no more than
that in every such coordinate (triangle inequality), so a pair with a larger
difference is discarded before its bits are compared.

Comparing all pairs of coordinate rows would be quadratic, so the tables also
hold the distances band by band (5 bands of 13, 13, 13, 13 and 12 bits): 3
differing bits leave at least two bands alike, whose coordinates are then equal
to every pivot.  An equi-join on the coordinates of each of the ten pairs of
bands thus meets every linked pair.  Crowded cells of that join are dealt out
as pairs of bounded blocks, which return a spanning forest of their links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.llm.common import join_classes, stored, text_or_empty, unused
from tickfold.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 16
BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a cell that are joined with each other as rows.
CROWDED = 64
#: Fingerprints of one of the two blocks that a task compares at a time.
BLOCK = 1024


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the lower-cased word shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, the contract's blanks
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b"%b %b %b" % t, SEED)
                  for t in zip(words, words[1:], words[2:], strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at:at + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


@F.arrow_udf(T.LongType())
def fingerprint_udf(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(x.as_py()) for x in texts], pa.int64())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def reference(j: int) -> int:
    """The j-th reference fingerprint: a fixed hash of its number."""
    return _signed(xxhash.xxh64_intdigest(b"pivot %d" % j, SEED))


def pivot_table(prints: DataFrame) -> DataFrame:
    """fp with its coordinates: ``bands`` (one number per band that packs its
    distances to all pivots) and ``near``, ``far`` (the whole distances, a byte each)."""
    def distance(j: int, start: int, width: int):
        mask = _signed(((1 << width) - 1) << start)
        return F.bit_count(F.col("fp").bitwiseXOR(F.lit(reference(j))).bitwiseAND(F.lit(mask)))

    def total(terms):
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out.cast("bigint")

    bands = [total([distance(j, *band).cast("bigint") * F.lit(14 ** j) for j in range(PIVOTS)])
             for band in BANDS]
    whole = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(reference(j)))).cast("bigint")
             * F.lit(1 << 8 * (j % 8)) for j in range(PIVOTS)]
    return prints.select("fp", F.array(*bands).alias("bands"),
                         total(whole[:8]).alias("near"), total(whole[8:]).alias("far"))


def _close(a: str, b: str):
    """No coordinate differs by more than MAX_BITS, and neither do the fingerprints."""
    ok = F.lit(True)
    for part in ("near", "far"):
        for j in range(8):
            x, y = (F.shiftright(F.col(f"{s}.{part}"), 8 * j).bitwiseAND(F.lit(255)) for s in (a, b))
            ok = ok & (F.abs(x - y) <= MAX_BITS)
    return ok & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= MAX_BITS)


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join the same components as all links between ``prints``.

    ``prints`` has distinct fingerprints in column fp.
    """
    cells = pivot_table(prints).select("fp", "near", "far", F.explode(F.array(*[
        F.xxhash64(F.lit(n), F.col("bands")[i], F.col("bands")[j])
        for n, (i, j) in enumerate(combinations(range(len(BANDS)), 2))])).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(cells.join(sizes, "cell"), "simhash-cells")
    few = shared.filter(F.col("size") <= CROWDED)
    pairs = few.alias("a").join(few.alias("b"), "cell").filter("a.fp < b.fp").filter(_close("a", "b"))
    pairs = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    many = shared.filter(F.col("size") > CROWDED).withColumn(
        "blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    many = many.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = many.select("cell", "fp", "near", "far", "block",
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("cell", "fp", "near", "far", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"), "block")
    forest = met.groupBy("cell", "low", "high").applyInArrow(_forest, "a bigint, b bigint")
    return pairs.union(forest)


def _forest(rows: pa.Table) -> pa.Table:
    """A spanning forest of the links between the (at most two) blocks of ``rows``."""
    prints = np.sort(rows["fp"].to_numpy()).view(np.uint64)
    pivots = np.array([reference(j) for j in range(PIVOTS)], np.int64).view(np.uint64)
    table = np.bitwise_count(prints[:, None] ^ pivots[None, :]).astype(np.int8)
    root = np.arange(len(prints))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found: list[tuple[int, int]] = []
    for i in range(len(prints) - 1):
        rest = np.flatnonzero(np.abs(table[i + 1:] - table[i]).max(axis=1) <= MAX_BITS) + i + 1
        for j in rest[np.bitwise_count(prints[rest] ^ prints[i]) <= MAX_BITS].tolist():
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((i, j))
    signed = prints.view(np.int64)
    left, right = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
    return pa.table({"a": signed[left], "b": signed[right]})


def classes(prints: DataFrame) -> DataFrame:
    """One row per distinct fingerprint of ``prints`` (doc_id, fp): fp, root (the
    fingerprint that names its component), component_id, first_id (its smallest
    doc_id), id_rows (rows with that id and fp) and group_size."""
    ids = prints.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    distinct = stored(ids.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"),
        F.min_by("n", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("id_rows"),
        F.sum("n").alias("group_size")), "simhash-classes")
    hung = components(links(distinct.select("fp")), "simhash-components")
    rooted = distinct.join(hung.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root")


def label(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp (signed 64 bits), component_id.

    A null text counts as empty and gets fingerprint zero, linked like any
    other; a null doc_id is linked but names a component only if all its ids
    are null; rows that repeat are labelled each.
    """
    prints = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                fingerprint_udf(text_or_empty()).alias("fp")), "simhash-prints")
    found = classes(prints).select("fp", "component_id", "group_size")
    return join_classes(prints, found, found, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id, with its columns.

    Of rows that repeat that doc_id, the smallest fingerprint stays, then the
    row whose columns hash lowest.
    """
    fp, number, ident, value = unused(docs, "fp", "number", "kept_id", "kept_fp")
    marked = stored(docs.withColumn(fp, fingerprint_udf(text_or_empty())), "simhash-docs")
    prints = marked.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(fp).alias("fp"))
    keep = classes(prints).groupBy("root").agg(F.min(F.struct(
        F.col("first_id").isNull().alias("none"), "first_id", "fp", "id_rows")).alias("first"))
    keep = stored(keep.select(F.col("first.first_id").alias(ident), F.col("first.fp").alias(value),
                              F.col("first.id_rows").alias("id_rows")), "simhash-keep")
    kept = marked.join(keep, (F.col(fp) == F.col(value))
                       & F.col("doc_id").cast("bigint").eqNullSafe(F.col(ident)), "left_semi")
    if not keep.filter("id_rows > 1").isEmpty():
        order = Window.partitionBy(fp).orderBy(F.xxhash64(*docs.columns))
        kept = kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1)
    return kept.select(*docs.columns)
