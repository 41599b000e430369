"""How the sources of a language differ in their terms (operator 12).

Every (lang, source) group has a smoothed share of each kept term, in whole
billionths.  All ordered pairs of the groups of a language are compared over all
its kept terms, by partitioning the cube (group, group, term): groups are cut
into blocks and terms into blocks by hash, and one task owns each cell (group
block, group block, term block).  A slice (group block, term block) is sent to
every cell that needs it; the cell computes the part of each divergence that its
terms make up, and the parts are added along the term axis.

A cell holds at most two slices of GROUP_BLOCK groups and about TERM_BLOCK
terms, whatever the size of a language, a source or the corpus.  All values are
whole numbers, so no order of additions matters.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickfold.llm.common import stored

#: Documents of a language that a kept term is in.
MIN_DOCS = 3
#: Terms listed of each group.
TOP_TERMS = 200
#: Groups and terms of a slice, at most and about.
GROUP_BLOCK = 16
TERM_BLOCK = 4096
#: Terms that a task counts before it hands its counts on.
HELD_TERMS = 750_000

#: What separates terms becomes a blank, A-Z lower case; bytes of other letters stay.
FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x > 127 else 32 for x in range(256))


def _count(batches):
    """(lang, source, term, n, docs) of parts of a task's documents; term null: the documents themselves."""
    held: dict[tuple[str, str], dict[bytes | None, list[int]]] = {}
    size = 0
    names = ["lang", "source", "term", "n", "docs"]

    def batch():
        rows = [(lang, source, None if term is None else term.decode(), *n)
                for (lang, source), found in held.items() for term, n in found.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.string()] * 3 + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for b in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            found = held.setdefault((lang, source), {None: [0, 0]})
            size -= len(found)
            found[None][1] += 1
            for term, n in Counter(text.encode().translate(FOLD).split()).items():
                at = found.get(term)
                if at is None:
                    found[term] = [n, 1]
                else:
                    at[0] += n
                    at[1] += 1
            size += len(found)
            if size > HELD_TERMS:
                yield batch()
                held.clear()
                size = 0
    yield batch()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each
    group, and one row with a null term per group (docs: its documents).

    A null lang, source or text counts as empty.  Repeated rows count each.
    """
    clean = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = clean.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count, total, terms):
    """1 + floor(10^9 * (count + 1) / (total + terms)), in whole numbers below 2^63.

    A long division, three decimal digits at a time, as 10^9 times a count of a
    large corpus is beyond a long.
    """
    whole, rest, over = F.lit(0).cast("bigint"), count + 1, F.greatest(total + terms, F.lit(1))
    for _ in range(3):
        whole = whole * 1000 + F.call_function("div", rest * 1000, over)
        rest = (rest * 1000) % over
    return whole + 1


def _cell(key, table):
    """Parts of the divergences of all pairs (a group of one block, one of the other)."""
    groups, side, place, p, terms = (table.column(c).to_numpy() for c in ("g", "side", "place", "p", "terms"))
    head = place < 0
    n_terms = int(terms[head][0])
    where = np.unique(place[~head], return_inverse=True)  # terms that no group here has are alike for all

    def matrix(of: int):
        own = np.unique(groups[head & (side == of)])
        base = np.empty(len(own), np.int64)
        at = head & (side == of)
        base[np.searchsorted(own, groups[at])] = p[at]
        m = np.repeat(base[:, None], len(where[0]), axis=1)
        at = side[~head] == of
        m[np.searchsorted(own, groups[~head][at]), where[1][at]] = p[~head][at]
        return own, base, m

    left = matrix(0)
    right = matrix(1) if (side == 1).any() else left
    rest = n_terms - len(where[0])
    out: list[tuple[np.ndarray, ...]] = []
    for i, g in enumerate(left[0]):
        square = (left[2][i][None, :] - right[2]) ** 2
        square0 = (left[1][i] - right[1]) ** 2
        forth = (square // right[2]).sum(axis=1) + rest * (square0 // right[1])
        out.append((np.full(len(right[0]), g), right[0], forth))
        if right is not left:
            back = (square // left[2][i][None, :]).sum(axis=1) + rest * (square0 // left[1][i])
            out.append((right[0], np.full(len(right[0]), g), back))
    g, h, value = (np.concatenate(x) for x in zip(*out, strict=True))
    keep = g != h
    return pa.table({"lang": pa.array([key[0].as_py()] * int(keep.sum()), pa.string()),
                     "g": g[keep].astype(np.int32), "h": h[keep].astype(np.int32), "value": value[keep]})


def audit(docs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: how far the group is from each other source (item) of its
    language; part ``term``: the ``top`` terms (item) that set it apart from its
    language.  Value: sum, or single summand, of floor((p - q)^2 / q), p the
    group's share and q the other's.  Ranks from 1 by value (highest first), then
    item in byte order.

    A language without kept terms gives its pairs the value 0 and no terms; a
    language of one source has no pairs; an empty table gives no rows.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    spoken = counts.filter("term is not null")
    kept = spoken.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(
        F.col("docs") >= MIN_DOCS).select("lang", "term", "n_lang")
    kept = stored(kept, "divergence-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))

    # Groups are numbered within their language: one row each, not one per document.
    groups = counts.filter("term is null").select("lang", "source")
    groups = groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups")), "lang")
    groups = groups.join(langs, "lang", "left").fillna(0, ["terms", "lang_total"])

    # Each kept term has a term block and a place in it; a block is about TERM_BLOCK terms.
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / TERM_BLOCK)).cast("int").alias("term_blocks")
    placed = kept.join(langs.select("lang", "terms", "lang_total", blocks), "lang").withColumn(
        "tb", F.expr("pmod(xxhash64(term), term_blocks)").cast("int"))
    order = Window.partitionBy("lang", "tb").orderBy("term")
    # Dealt out by block: the join before it leaves each language in one piece.
    placed = placed.repartition("lang", "tb")
    placed = stored(placed.withColumn("place", F.row_number().over(order) - 1), "divergence-places")
    in_block = placed.groupBy("lang", "tb").agg(F.count(F.lit(1)).alias("in_block"))

    held = stored(spoken.join(placed, ["lang", "term"]).select(
        "lang", "source", "term", "n", "n_lang", "terms", "lang_total", "tb", "place"), "divergence-held")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"]), "divergence-groups")

    known = groups.select("lang", "source", "g", "n_groups", "total")
    shares = held.join(known, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    own = shares.withColumn("q", share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))).filter("p > q")
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    # The limit on the rank also holds before the shuffle, so a group sends `top` rows a task.
    terms = own.select("lang", "source", F.col("term").alias("item"),
                       F.expr("(p - q) * (p - q) div q").alias("value")).withColumn(
        "rank", F.row_number().over(ranks)).filter(F.col("rank") <= top)

    # Slices: the rows of the groups' terms, and for each group and term block its share of a term it lacks.
    base = share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))
    heads = groups.withColumn("tb", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("terms") / TERM_BLOCK)).cast("int") - 1)))
    heads = heads.join(in_block, ["lang", "tb"], "left").select(
        "lang", "g", "n_groups", "tb", F.lit(-1).alias("place"), base.alias("p"),
        F.coalesce("in_block", F.lit(0)).cast("bigint").alias("terms"))
    slices = heads.unionByName(shares.select("lang", "g", "n_groups", "tb", "place", "p",
                                             F.lit(0).cast("bigint").alias("terms")))
    block = F.expr(f"g div {GROUP_BLOCK}")
    every = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_groups - 1) div {GROUP_BLOCK}"))
    cells = slices.withColumn("b", block).withColumn("other", F.explode(every)).select(
        "lang", "tb", F.least("b", "other").alias("gi"), F.greatest("b", "other").alias("gj"),
        "g", "place", "p", "terms", (F.col("b") > F.col("other")).cast("int").alias("side"))
    parts = cells.groupBy("lang", "gi", "gj", "tb").applyInArrow(_cell, "lang string, g int, h int, value bigint")
    summed = parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    number = groups.select("lang", "g", "source")
    pairs = summed.join(number, ["lang", "g"]).join(
        number.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"]).select(
        "lang", "source", "item", "value").withColumn("rank", F.row_number().over(ranks))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))
