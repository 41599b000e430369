"""The whole run (M10): bronze -> silver -> gold, written as CSV.

Compared with recomputing every output from the sources, the run

* writes the index by hour first, so the join with it is planned on its true
  size, then the silver core, as parquet in a folder of this run under the
  shared checkpoint folder; every later output reads that table, so a lost
  executor costs a re-read, not a replay from the sources;
* rolls the finest gold grain once into an additive state (also written),
  and derives the coarser grains from that state;
* writes every report in parallel, and submits the report writes together
  (they only read the materialised tables, so they are independent jobs the
  scheduler can interleave);
* writes them into a folder of this run and then publishes the whole set by one
  manifest (``sinks.published``): a run that stops leaves the set before it.
"""

from __future__ import annotations

import dataclasses
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.functions.numeric import REPORT_DECIMALS
from tickfold.functions.time import GRAINS, LABEL_COLUMNS, as_timestamp
from tickfold.operators.index import duplicate_hours, index_hourly
from tickfold.operators.rollup import period_state, period_state_by_quarter
from tickfold.plans import gold, silver
from tickfold.plans.by_ticker import TickerTables
from tickfold.session import checkpoint_root, settings
from tickfold.sinks.csv import OUTPUT_NAMES, drop_periods, write_csv, write_partitioned_csv
from tickfold.sinks.published import current, folders, publish, remove_folder
from tickfold.sources.adapters import Inputs
from tickfold.sources.documents import document_quality, quality_counts

#: Sets of reports that are kept: the published one and, for its readers, the one before.
KEPT_SETS = 2
OUTPUT_NAMES_SET = frozenset(OUTPUT_NAMES.values())


def materialise(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet to ``path`` (under the shared checkpoint folder)
    and read it back: the lineage stops here and the data survives executor
    loss."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def within(df: DataFrame, time_range: tuple[str, str]) -> DataFrame:
    """Rows with a stamp from the first time on and before the second."""
    kind = df.schema["timestamp"].dataType
    stamp = as_timestamp("timestamp", kind) if isinstance(kind, T.StringType) else F.col("timestamp")
    first, end = (F.lit(x).cast(T.TimestampNTZType()) for x in time_range)
    return df.where((stamp >= first) & (stamp < end))


def whole_periods(time_range: tuple[str, str], grains: tuple[str, ...]) -> list[tuple[int, int]]:
    """The (year, month) of a range that holds whole folders of partitioned reports:
    whole months, and whole years where the quarterly report is among them."""
    first, end = (datetime.fromisoformat(x) for x in time_range)
    for x in (first, end):
        if x != x.replace(day=1, hour=0, minute=0, second=0, microsecond=0) or ("quarter" in grains and x.month != 1):
            raise ValueError(f"{time_range}: reports are replaced by whole "
                             f"{'years' if 'quarter' in grains else 'months'}, each in full")
    return [(m // 12, m % 12 + 1) for m in range(first.year * 12 + first.month - 1, end.year * 12 + end.month - 1)]


def run(
    spark: SparkSession,
    inputs: Inputs,
    output_path: str,
    hourly_round: int | None = 2,
    grains: tuple[str, ...] = gold.GOLD_GRAINS,
    partitioned: bool = False,
    time_range: tuple[str, str] | None = None,
    keep_work: bool = False,
    by_ticker: bool = False,
) -> dict[str, str]:
    """Run the pipeline and return ``{grain: output folder}`` (``"hour"`` is
    the silver report).

    The reports lie under ``sets/<run id>`` and are published together:
    ``sinks.csv.read_csv`` finds them at ``<output_path>/<name>``, whichever run
    was the last to end.  Beside them, ``_quality`` counts what the documents
    hold that cannot be used (null or unparsed stamps, null shares and prices,
    corrupt lines; counted while the run reads them) and ``_duplicate_hours``
    lists hours with several index rows; both are copied to ``output_path``, where
    ``_complete`` lists the reports, for readers of folders.  Intermediates go when the run ends,
    unless ``keep_work``.

    ``time_range`` (from, before) limits the run to the trades and index rows
    of these stamps, a filter that reaches the scan.  Where a set is published
    already, the range must be whole months (whole years with the quarterly
    report) of a partitioned set: these folders of its reports are replaced, one
    report after the other, and all others stay.

    ``by_ticker`` lays the silver core and the state out by ticker (``TickerTables``):
    one shuffle of the hourly rows, none after it.  It pays where companies are
    too many to broadcast; else shuffling the day state is less.
    """
    root = output_path.rstrip("/")
    before = current(spark, root)
    periods = None
    if time_range and before:
        if not (partitioned and before.get("partitioned")):
            raise ValueError(f"{root} has reports already: a time range would replace them by a part; "
                             "only partitioned reports can be replaced in part")
        periods = whole_periods(time_range, grains)
        missing = {OUTPUT_NAMES[g] for g in ("hour", *grains)} ^ (before["tables"].keys() & OUTPUT_NAMES_SET)
        if missing:
            raise ValueError(f"{root} and this run don't both have {sorted(missing)}")
    run_id = uuid.uuid4().hex
    work = f"{checkpoint_root(spark)}/tickfold/run-{run_id}"
    folder, published = f"{root}/sets/{run_id}", False
    try:
        with ExitStack() as open_tables, settings(spark):
            tables_by_ticker = open_tables.enter_context(TickerTables(spark, work)) if by_ticker else None
            seen = None
            if inputs.documents is not None and inputs.trades is None and not time_range:
                seen = Observation()
                inputs = dataclasses.replace(inputs, documents=inputs.documents.observe(
                    seen, *quality_counts(inputs.documents)))
            trades, index = silver.trades_of(inputs), inputs.index
            if time_range:
                trades, index = within(trades, time_range), within(index, time_range)
            by_hour = materialise(spark, index_hourly(index), f"{work}/index")
            core = silver.joined_core(trades, by_hour, check=True)
            if hourly_round is not None:
                core = core.drop("notional")  # only the unrounded report divides it again
            core = tables_by_ticker.write(core, "silver_core", "datetime") if by_ticker \
                else materialise(spark, core, f"{work}/silver-core")
            reports = {"hour": silver.report(core, inputs.companies, round_decimals=hourly_round)}
            decimals = {"hour": hourly_round}
            if grains:
                finest = min(grains, key=GRAINS.index)
                state = period_state(core, finest) if by_ticker else period_state_by_quarter(core, finest)
                state = tables_by_ticker.write(state, f"state_{finest}", "period", placed=True) if by_ticker \
                    else materialise(spark, state, f"{work}/state-{finest}")
                for grain in grains:
                    reports[grain] = gold.rollup_from_state(state, finest, inputs.companies, grain)
                    decimals[grain] = REPORT_DECIMALS

            def write(grain: str) -> str:
                path = f"{folder}/{OUTPUT_NAMES[grain]}"
                if periods is not None:
                    path = write_partitioned_csv(reports[grain], before["tables"][OUTPUT_NAMES[grain]], LABEL_COLUMNS[grain],
                                                 cluster=False, decimals=decimals[grain], replace=True)
                    drop_periods(reports[grain], path, LABEL_COLUMNS[grain], periods)
                    return path
                if partitioned:
                    # reports are sorted by period: already range-partitioned by it
                    return write_partitioned_csv(reports[grain], path, LABEL_COLUMNS[grain],
                                                 cluster=False, decimals=decimals[grain])
                return write_csv(reports[grain], path, decimals[grain])

            checks = {"_duplicate_hours": duplicate_hours(by_hour, "datetime", "market_index")}
            if seen is not None:
                checks["_quality"] = spark.range(1).select(
                    *[F.lit(n).cast("bigint").alias(c) for c, n in seen.get.items()])
            elif inputs.documents is not None:
                checks["_quality"] = document_quality(inputs.documents)
            for name, found in checks.items():
                found.write.json(f"{folder}/{name}")
            with ThreadPoolExecutor(max_workers=len(reports)) as pool:
                paths = dict(zip(reports, pool.map(write, reports)))
            tables = {OUTPUT_NAMES[g]: p for g, p in paths.items()} | {n: f"{folder}/{n}" for n in checks}
            publish(spark, root, {"run_id": run_id, "tables": tables, "partitioned": partitioned,
                                  "sets": [*(before or {}).get("sets", []), run_id]}, before)
            published = True
            for name, found in checks.items():
                spark.read.schema(found.schema).json(f"{folder}/{name}").write.mode("overwrite").json(f"{root}/{name}")
            done = F.inline(F.array(*[F.struct(F.lit(run_id).alias("run_id"), F.lit(g).alias("grain"),
                                               F.lit(p).alias("path")) for g, p in paths.items()]))
            spark.range(1).select(done).write.mode("overwrite").json(f"{root}/_complete")
            named = {p.removeprefix(f"{root}/sets/").split("/")[0] for p in tables.values()}
            for old in (before or {}).get("sets", [])[:-KEPT_SETS + 1]:
                if old not in named and old in folders(spark, f"{root}/sets"):
                    remove_folder(spark, f"{root}/sets/{old}")
    finally:
        if not published:
            remove_folder(spark, folder)
        if not keep_work:
            remove_folder(spark, work)
    return paths
