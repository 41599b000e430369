"""Quality rules with adaptive thresholds (operator 10).

Each document gets a few whole-text counts.  Every rate built from them is
summarised per (lang, source) by a mergeable quantile sketch.  The sketch's quartiles
give that group its own cut-offs: how far beyond them a document may be depends on
how far apart they are there.  Documents are then joined with the cut-offs of their
group and filtered.

The sketch is a histogram whose cells keep the five leading binary digits of an
integer (rates are in millionths), so a quantile is off by at most 1/16 of its
value.  Sketches merge by adding counts, which is an ordinary ``groupBy`` with
map-side combine: no group's rows ever meet in one task, and a group too small
for quantiles of its own uses the merged sketch of its language, or of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.llm.common import stored, unused

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_marks")
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

#: Fixed rules, the same for every group.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A group with fewer sketched documents takes the cut-offs of its language, then of all.
MIN_GROUP = 100
#: Cut-off: quartile + FENCE * the distance between the quartiles.
FENCE = 12.0
#: The quantiles taken from a sketch, as fractions.
QUANTILES = {"low": (1, 4), "high": (3, 4)}
#: Rates in millionths, as (numerator, denominator, distance taken where a group's
#: quartiles are the same, which side is cut).
RATES = {
    "symbols": ("n_symbols", "word_chars", 5_000, "high"),
    "dup_lines": ("n_dup_lines", "n_lines", 50_000, "high"),
    "upper": ("n_upper", "word_chars", 25_000, "high"),
    "marks": ("n_marks", "n_words", 25_000, "high"),
    "word_length": ("word_chars", "n_words", 350_000, "both"),
}
MILLION = 1_000_000


def text_counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one whole text; a null text has none of anything."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the blanks of the contract
    blanks = len(raw) - len(raw.translate(None, b" \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (len(words), len(text) - blanks,
            len(raw) - len(raw.translate(None, b"#*$%&|<>")),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(raw) - len(raw.translate(None, bytes(range(65, 91)))), raw.count(b"!"))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by WINDOW-word windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    found = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    seen: dict[tuple, int] = {}
    for i in found:  # by the words themselves: equal hashes don't decide
        window = tuple(words[i:i + WINDOW])
        seen[window] = seen.get(window, 0) + 1
    covered = np.zeros(len(words) + 1, np.int64)
    for i in found:
        if seen[tuple(words[i:i + WINDOW])] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


@F.arrow_udf(COUNTS_TYPE)
def counts_udf(texts: pa.Array) -> pa.Array:
    rows = np.array([text_counts(x.as_py()) for x in texts], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(rows[:, i].copy()) for i in range(len(COUNTS))],
                                      names=list(COUNTS))


def rate(name: str, m: str):
    """The rate in millionths, null where its denominator is zero."""
    top, bottom, _, _ = RATES[name]
    return F.when(F.col(f"{m}.{bottom}") > 0,
                  F.expr(f"{m}.{top} * {MILLION} div {m}.{bottom}"))


def cell(value):
    """The value with all but its five leading binary digits cleared."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - 5).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def base_failed(m: str):
    return F.expr(f"{m}.n_words < {MIN_WORDS} OR "
                  f"100 * {m}.n_repeat_words > {MAX_REPEAT_PERCENT} * {m}.n_words")


def sketches(counted: DataFrame, m: str = "counts") -> DataFrame:
    """(lang, source, rate, cell, n): the sketch of each group and rate.

    Documents that fail the fixed rules stay out, as do undefined rates.
    """
    rates = F.array(*[F.struct(F.lit(r).alias("rate"), cell(rate(r, m)).alias("cell"))
                      for r in RATES])
    return (counted.filter(~base_failed(m)).select("lang", "source", F.inline(rates))
            .filter(F.col("cell").isNotNull())
            .groupBy("lang", "source", "rate", "cell").agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, *group: str) -> DataFrame:
    """Documents and the QUANTILES cells of each group, from merged sketches."""
    keys = [*group, "rate"]
    merged = sketch.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys)
    ranked = merged.withColumn("docs", F.sum("n").over(by)).withColumn(
        "upto", F.sum("n").over(by.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
    return ranked.groupBy(*keys, "docs").agg(
        *[F.min(F.when(F.col("upto") * b >= F.col("docs") * a, F.col("cell"))).alias(q)
          for q, (a, b) in QUANTILES.items()])


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source) with a map rate -> (low, high) in millionths."""
    own = quantiles(sketch, "lang", "source")
    lang = quantiles(sketch, "lang").select(
        F.col("lang").alias("l"), F.col("rate").alias("lr"), F.col("docs").alias("ld"),
        *[F.col(q).alias(f"l_{q}") for q in QUANTILES])
    every = quantiles(sketch).select(F.col("rate").alias("ar"), *[F.col(q).alias(f"a_{q}") for q in QUANTILES])
    best = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("lr")))
    best = best.join(F.broadcast(every), F.col("rate") == F.col("ar"))  # one row per rate
    pick = lambda q: (F.when(F.col("docs") >= MIN_GROUP, F.col(q))
                      .when(F.col("ld") >= MIN_GROUP, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}")))
    low, high = map(pick, QUANTILES)
    least = F.create_map(*[F.lit(x) for r, v in RATES.items() for x in (r, v[2])])[F.col("rate")]
    apart = FENCE * F.when(high > low, high - low).otherwise(least)
    low_cut = F.col("rate").isin([r for r, v in RATES.items() if v[3] == "both"])
    return best.select(
        "lang", "source", "rate",
        F.when(low_cut, low - apart).otherwise(F.lit(-1.0)).alias("low"),
        (high + apart).alias("high")).groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("rate", F.struct("low", "high")))).alias("cuts"))


def judged(counted: DataFrame, cuts: DataFrame, m: str, kept: str) -> DataFrame:
    """``counted`` joined with the cut-offs of its group, and the verdict ``kept``."""
    lang, source, limits = unused(counted, "cut_lang", "cut_source", "cuts")
    cuts = cuts.select(F.col("lang").alias(lang), F.col("source").alias(source),
                       F.col("cuts").alias(limits))
    ok = F.lit(True)
    for r in RATES:
        cut = F.col(limits)[r]
        inside = (rate(r, m) >= cut["low"]) & (rate(r, m) <= cut["high"])
        ok = ok & F.coalesce(inside, F.lit(True))
    joined = counted.join(cuts, F.col("lang").eqNullSafe(F.col(lang))
                          & F.col("source").eqNullSafe(F.col(source)), "left")
    return joined.withColumn(kept, ~base_failed(m) & ok).drop(lang, source, limits)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept.

    A null text counts as empty, so it fails the fixed rules; null lang or
    source is a group like any other; repeated rows are judged each; an empty
    table gives no rows.
    """
    counted = stored(docs.select("doc_id", "lang", "source", counts_udf("text").alias("counts")),
                     "quality-counts")
    cuts = stored(cutoffs(sketches(counted)), "quality-cutoffs")
    return judged(counted, cuts, "counts", "kept").select(
        "doc_id", *[f"counts.{c}" for c in COUNTS], base_failed("counts").alias("base_failed"),
        "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    m, kept = unused(docs, "counts", "kept")
    counted = stored(docs.withColumn(m, counts_udf("text")), "quality-docs")
    cuts = stored(cutoffs(sketches(counted, m)), "quality-cutoffs")
    return judged(counted, cuts, m, kept).filter(F.col(kept)).select(*docs.columns)
