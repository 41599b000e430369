"""Incremental run (M10, A5-A9): batches of trades and index rows, added one by one.

A batch is known by an id of the caller's.  What it adds is kept as additive
sums per (hour, ticker), in folders by day, beside its index rows.  Days are the
unit of recomputation: the days that a batch touches are rolled up again from
the sums of all batches that have them, so trades of one hour may come in
several batches, and an index row later than its trades.  Months and quarters
come from the day state, which is additive.

Nothing is changed in place.  Each call writes folders of its own and then
publishes one manifest (``sinks.published``) that says which attempt of each
batch counts and which folder holds each day.  A batch that is added again,
after a failure or with corrected rows, replaces what its id brought before; the
same rows change nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.functions.time import as_timestamp, bucket
from tickfold.operators.hourly import trade_sums, vwap_columns
from tickfold.operators.index import index_hourly
from tickfold.operators.joins import join_index
from tickfold.operators.rollup import period_state
from tickfold.plans import gold
from tickfold.plans.silver import TRADE_COLUMNS
from tickfold.schemas import require
from tickfold.session import settings
from tickfold.sinks.published import current, folders, publish, remove_folder

KINDS = ("hours", "index", "days")


def _day(stamp: str):
    return F.date_format(stamp, "yyyy-MM-dd").alias("day")


def _write(df: DataFrame, root: str, kind: str, attempt: str, *spread: str) -> list[str]:
    """Write by day and return the days.  A day with very many rows is cut by ``spread``."""
    path = f"{root}/{kind}/attempt={attempt}"
    df.repartitionByRange("day", *spread).write.partitionBy("day").parquet(path)
    names = folders(df.sparkSession, path)
    return [x.removeprefix("day=") for x in names if x.startswith("day=")]


def _read(spark: SparkSession, root: str, kind: str, held: list[tuple[str, str]], schema: str) -> DataFrame:
    """Rows of (attempt, day) folders, which are named one by one: no other is listed."""
    schema = T.StructType.fromJson(json.loads(schema))
    if not held:
        return spark.createDataFrame([], schema)
    parts = T.StructType([T.StructField("attempt", T.StringType()), T.StructField("day", T.StringType())])
    paths = [f"{root}/{kind}/attempt={a}/day={d}" for a, d in held]
    return spark.read.schema(T.StructType([*schema, *parts])).option(
        "basePath", f"{root}/{kind}").parquet(*paths).drop("attempt", "day")


def _same_types(known: dict, kind: str, df: DataFrame) -> None:
    new = df.drop("day").schema.json()
    if known.setdefault(kind, new) != new:
        raise ValueError(f"{kind}: columns {new} differ from those of earlier batches, {known[kind]}")


def add_batch(spark: SparkSession, root: str, batch_id: str, trades: DataFrame,
              market_index: DataFrame | None = None) -> dict:
    """Add a batch and return the new manifest.

    ``trades`` as for ``silver.core``, of the same types in each batch; trades
    and index rows without a stamp count for nothing.  Raises
    ``PublishedMeanwhile`` if another batch was added while this one ran: add it
    again.  The days of a batch (a calendar, not its rows) pass the driver.
    """
    require(trades, TRADE_COLUMNS, "trades")
    root, attempt = root.rstrip("/"), uuid.uuid4().hex
    before = current(spark, root)
    state = before or {"batches": {}, "days": {}, "schemas": {}}
    batches, days, schemas = dict(state["batches"]), dict(state["days"]), dict(state["schemas"])
    with settings(spark):
        stamp = as_timestamp("timestamp", trades.schema["timestamp"].dataType)
        sums = trades.groupBy(bucket(stamp, "hour").alias("datetime"), "ticker").agg(*trade_sums(trades)).where(
            F.col("datetime").isNotNull()).withColumn("day", _day("datetime"))
        _same_types(schemas, "hours", sums)
        own = {"attempt": attempt, "hours": _write(sums, root, "hours", attempt, "ticker"), "index": []}
        if market_index is not None:
            by_hour = index_hourly(market_index).where(F.col("datetime").isNotNull()).withColumn(
                "day", _day("datetime"))
            _same_types(schemas, "index", by_hour)
            own["index"] = _write(by_hour, root, "index", attempt, "datetime")
        replaced = batches.get(batch_id, {"hours": [], "index": []})
        batches[batch_id] = own
        touched = {*own["hours"], *own["index"], *replaced["hours"], *replaced["index"]}

        def held(kind: str) -> list[tuple[str, str]]:
            return [(b["attempt"], d) for b in batches.values() for d in b[kind] if d in touched]

        redone: list[str] = []
        if "index" in schemas:
            kept = _read(spark, root, "hours", held("hours"), schemas["hours"])
            kinds = {c: kept.schema[c].dataType for c in ("volume", "notional")}
            hours = kept.groupBy("datetime", "ticker").agg(
                *[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()])
            core = join_index(hours.select("datetime", "ticker", *vwap_columns(hours)),
                              _read(spark, root, "index", held("index"), schemas["index"]))
            rolled = period_state(core, "day").withColumn("day", _day("period"))
            _same_types(schemas, "days", rolled)
            redone = _write(rolled, root, "days", attempt, "ticker")
    days = {d: a for d, a in days.items() if d not in touched} | dict.fromkeys(redone, attempt)
    return publish(spark, root, {"batches": batches, "days": days, "schemas": schemas}, before)


def day_state(spark: SparkSession, root: str) -> DataFrame:
    """The additive state per (day, ticker) of all batches (``operators.rollup``)."""
    root, state = root.rstrip("/"), current(spark, root)
    if state is None or "days" not in state["schemas"]:
        raise ValueError(f"{root} holds no batch with index rows yet")
    return _read(spark, root, "days", [(a, d) for d, a in state["days"].items()], state["schemas"]["days"])


def report(spark: SparkSession, root: str, companies: DataFrame, grain: str, sort: bool = True) -> DataFrame:
    """The gold report at ``grain`` over all batches added so far."""
    with settings(spark):
        return gold.rollup_from_state(day_state(spark, root), "day", companies, grain, sort)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Remove the folders that the last manifest doesn't name, and return them.

    Not while a batch is being added or a report of an earlier manifest is read.
    """
    root, state = root.rstrip("/"), current(spark, root)
    if state is None:
        return []
    attempts = {b["attempt"] for b in state["batches"].values()}
    named = {"hours": attempts, "index": attempts, "days": set(state["days"].values())}
    gone = [f"{root}/{kind}/{x}" for kind in KINDS for x in folders(spark, f"{root}/{kind}")
            if x.removeprefix("attempt=") not in named[kind]]
    for path in gone:
        remove_folder(spark, path)
    return gone
