"""Mixing sources to target weights by iterative proportional fitting (operator 2).

Documents fall into cells of (source, lang, topic).  The token weights of the
cells are raked to the target share of each source, then each language, then
each topic, until all three margins hold; documents are then sampled with a
probability that is proportional to their cell's weight, so the margins hold in
the sample too.

Raking runs on the table of cells, by ordinary aggregates and joins, one
written table a round; the documents are read once for the cells and once to
sample them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.llm.common import stored, text_or_empty, unused

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 8
#: A category's default target is its token share to this power: 1 leaves the
#: mix as it is, 0 makes all categories alike.
TEMPER = 0.7
#: Share of all tokens that the sample keeps in expectation, if the targets allow it.
KEEP = 0.9
#: A cell with a smaller share of all tokens doesn't set the scale of the sample.
LEAST_SHARE = 1e-4
#: Raking ends when no margin is off by more than this share of all tokens.
TOLERANCE = 1e-4
ROUNDS = 50
SEED = 7

FEATURES = T.StructType([T.StructField("topic", T.IntegerType()), T.StructField("tokens", T.LongType())])


def topic_of(text: str) -> tuple[int, int]:
    """The lexicon that most distinct words of the whole text belong to, and its words.

    Lexicons are TOPICS hash classes of words.  Texts that share vocabulary get
    the same topic; a column of labels can be given in its place (``topic``).
    """
    words = text.encode().lower().split()
    if not words:
        return 0, 0
    found = np.fromiter(map(zlib.crc32, set(words)), np.int64) % TOPICS
    return int(np.bincount(found, minlength=TOPICS).argmax()), len(words)


@F.arrow_udf(FEATURES)
def features_udf(texts: pa.Array) -> pa.Array:
    rows = np.array([topic_of(x.as_py()) for x in texts], np.int64).reshape(-1, 2)
    return pa.StructArray.from_arrays([pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1].copy())],
                                      names=["topic", "tokens"])


def with_features(docs: DataFrame, name: str, topic: str | None = None) -> DataFrame:
    """``docs`` and a struct column of source, lang, topic, tokens.

    The topic is the value of column ``topic`` as a string, if one is named.
    """
    (raw,) = unused(docs, "features")
    marked = docs.withColumn(raw, features_udf(text_or_empty()))
    return marked.withColumn(name, F.struct(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.col(f"`{topic}`").cast("string").alias("topic") if topic else F.col(f"{raw}.topic").alias("topic"),
        F.col(f"{raw}.tokens").alias("tokens"))).drop(raw)


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """Default targets (value, share): token shares to a power, which need not add up to 1."""
    own = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens"))
    return own.select("value", F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (the dimensions, tokens) with the fitted ``weight`` of each cell.

    Shares are taken relative to those of the values that have tokens; a value
    without a target gets weight 0.  Null is a value like any other.
    """
    current = stored(cells.withColumn("weight", F.lit(1.0)), "mixing-cells")
    total = current.agg(F.sum("tokens")).head()[0]
    if not total:
        return current
    goals = {}
    for d, target in targets.items():
        present = current.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("n")).filter("n > 0")
        goal = present.join(target.withColumnRenamed("value", "v"),
                            F.col("value").eqNullSafe(F.col("v")), "left")
        goal = goal.select("value", F.coalesce("share", F.lit(0.0)).alias("share"))
        whole = goal.agg(F.sum("share").alias("whole"))  # one row
        goals[d] = stored(goal.crossJoin(F.broadcast(whole)).select(
            F.col("value").alias("goal_of"), (F.col("share") / F.col("whole")).alias("goal")), "mixing-goals")

    def margin(frame: DataFrame, d: str) -> DataFrame:
        have = frame.groupBy(F.col(d).alias("value")).agg(F.sum(F.col("tokens") * F.col("weight")).alias("have"))
        return have.join(goals[d], F.col("value").eqNullSafe(F.col("goal_of"))).drop("goal_of")

    for _ in range(ROUNDS):
        for d in targets:
            factor = margin(current, d).select("value", F.when(
                F.col("have") > 0, F.col("goal") * total / F.col("have")).otherwise(0.0).alias("factor"))
            current = current.join(factor, F.col(d).eqNullSafe(F.col("value")), "left").select(
                *cells.columns, (F.col("weight") * F.coalesce("factor", F.lit(1.0))).alias("weight"))
        current = stored(current, "mixing-cells")
        off = [margin(current, d).agg(F.max(F.abs(F.col("have") / total - F.col("goal")))) for d in targets]
        whole = off[0]
        for x in off[1:]:
            whole = whole.union(x)
        if max(r[0] or 0.0 for r in whole.collect()) <= TOLERANCE:  # one number for each dimension
            break
    return current


def faithful(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """``raked`` with ``probability``: scale * weight, with one scale for all cells.

    The margins of the sample are those of the weights.  It keeps the given
    share of all tokens in expectation, or as much as the most wanted cell of at
    least LEAST_SHARE of the tokens allows, which then stays whole.  Smaller cells
    that are wanted more stay whole too, and are short by less than that share each.
    """
    whole = raked.agg(F.coalesce(F.sum("tokens"), F.lit(0))).head()[0]
    if not whole:
        return raked.withColumn("probability", F.lit(1.0))
    high, wanted = raked.filter("weight > 0 AND tokens > 0").agg(
        F.max(F.when(F.col("tokens") >= LEAST_SHARE * whole, F.col("weight"))),
        F.sum(F.col("tokens") * F.col("weight"))).head()
    if not wanted:
        return raked.withColumn("probability", F.lit(1.0))
    scale = min(keep * whole / wanted, 1 / high if high else 1.0)
    return raked.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * scale))


def _sampled(marked: DataFrame, f: str, targets, keep: float) -> DataFrame:
    cells = marked.groupBy(*[F.col(f"{f}.{d}").alias(d) for d in DIMENSIONS]).agg(
        F.sum(f"{f}.tokens").alias("tokens"))
    cells = stored(cells, "mixing-cells")
    targets = targets or {d: tempered(cells, d) for d in DIMENSIONS}
    return stored(faithful(rake(cells, targets), keep), "mixing-probabilities")


def _chance():
    """A number in [0, 1) that a document always gets."""
    return F.pmod(F.shiftright(F.xxhash64(F.lit(SEED), "doc_id", "text"), 11), F.lit(1 << 53)) / float(1 << 53)


def _joined(marked: DataFrame, f: str, cells: DataFrame, names: dict[str, str]) -> DataFrame:
    keys = dict(zip(DIMENSIONS, unused(marked, *[f"cell_{d}" for d in DIMENSIONS]), strict=True))
    cells = cells.select(*[F.col(d).alias(k) for d, k in keys.items()],
                         *[F.col(c).alias(n) for c, n in names.items()])
    same = [F.col(f"{f}.{d}").eqNullSafe(F.col(k)) for d, k in keys.items()]
    return marked.join(cells, same, "left").drop(*keys.values())


def score(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP,
          topic: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, weight, probability, kept.

    ``topic`` names a column of ``docs`` with labels (a classifier's, a cluster's; null is
    a label like any other); without it the topic is the stand-in of ``topic_of``.
    A null text has no tokens and topic 0; null source or lang is a category.
    Rows that repeat are alike in all columns; an empty table gives no rows.
    """
    columns = ["doc_id", "text", "source", "lang"]
    if topic and topic.lower() not in columns:
        columns.append(f"`{topic}`")
    marked = with_features(docs.select(*columns), "cell", topic)
    marked = stored(marked.select("doc_id", "cell", _chance().alias("chance")), "mixing-docs")
    cells = _sampled(marked, "cell", targets, keep)
    joined = _joined(marked, "cell", cells, {"weight": "weight", "probability": "probability"})
    return joined.select("doc_id", "cell.*", "weight", "probability",
                         (F.col("chance") < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP,
           topic: str | None = None) -> DataFrame:
    """The sampled documents, with their columns; the arguments are those of ``score``."""
    f, p = unused(docs, "cell", "probability")
    marked = stored(with_features(docs, f, topic), "mixing-docs")
    cells = _sampled(marked, f, targets, keep)
    return _joined(marked, f, cells, {"probability": p}).filter(_chance() < F.col(p)).select(*docs.columns)
