"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole test tables.  ``tickfold.oracle`` holds the SQL each one must
equal."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold import schemas
from tickfold.api import TradeProcessor
from tickfold.functions.time import LABEL_COLUMNS, as_timestamp, bucket
from tickfold.operators.explode import explode_transactions
from tickfold.operators.hourly import hourly_vwap
from tickfold.operators.index import duplicate_hours, index_hourly
from tickfold.operators.joins import join_company
from tickfold.operators.preview import preview
from tickfold.plans import gold, incremental, medallion, silver
from tickfold.session import scratch_path, settings
from tickfold.sinks.csv import (OUTPUT_NAMES, read_csv, report_schema, write_csv,
                                write_partitioned_csv)
from tickfold.sinks.published import resolve
from tickfold.sources import adapters
from tickfold.sources.documents import document_quality, read_documents, write_documents

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str, adapter: str) -> adapters.Inputs:
    return adapters.inputs(spark, sf_dir, adapter)


def _text(col: str):
    return F.col(col).cast("string").alias(col)


def _flat_trades(trades: DataFrame) -> DataFrame:
    return trades.select("timestamp", "ticker", "action", "shares",
                         F.col("price").cast(T.DoubleType()).alias("price"))


def _core(spark, sf_dir, adapter):
    inp = _inputs(spark, sf_dir, adapter)
    return inp, silver.core(silver.trades_of(inp), inp.index)


# -- bronze ------------------------------------------------------------------

def q_explode_documents(spark, sf_dir):
    """Documents built from orders/lineitem, exploded."""
    inp = _inputs(spark, sf_dir, "documents")
    return _flat_trades(explode_transactions(inp.documents))


def q_explode_element_stamps(spark, sf_dir):
    """Each trade takes its own element stamp (ship date), not the
    document's (order date)."""
    docs = adapters.order_documents(spark, sf_dir, element_stamps=True)
    return _flat_trades(explode_transactions(docs, timestamp_from="element"))


def _documents_roundtrip(spark, sf_dir, fmt):
    inp = _inputs(spark, sf_dir, "documents")
    path = write_documents(inp.documents.select("timestamp", "transactions"),
                           scratch_path(spark, f"documents-{fmt}"), fmt=fmt)
    docs = read_documents(spark, path, fmt=fmt, schema=schemas.DOCUMENT)
    return _flat_trades(explode_transactions(docs))


def q_documents_json(spark, sf_dir):
    """S3: documents written as JSON lines, read back with an explicit schema."""
    return _documents_roundtrip(spark, sf_dir, "json")


def q_documents_json_array(spark, sf_dir):
    """S3: documents as files of one JSON array each, every file read by several tasks."""
    docs = _inputs(spark, sf_dir, "documents").documents.select("timestamp", "transactions")
    path = write_documents(docs, scratch_path(spark, "documents-array"), fmt="json_array")
    # The files of these tables are of a few megabytes.
    back = read_documents(spark, path, json_array=True, split_bytes=1 << 18, schema=schemas.DOCUMENT)
    return _flat_trades(explode_transactions(back))


def q_documents_variant(spark, sf_dir):
    """S3: JSON lines taken in as VARIANT, without a pass that infers types."""
    docs = _inputs(spark, sf_dir, "documents").documents.select("timestamp", "transactions")
    path = write_documents(docs, scratch_path(spark, "documents-variant"))
    trades = explode_transactions(read_documents(spark, path, variant=True))
    stamp = as_timestamp("timestamp", trades.schema["timestamp"].dataType)
    return _flat_trades(trades.withColumns({"timestamp": stamp, "shares": F.col("shares").cast("int")}))


def q_documents_parquet(spark, sf_dir):
    """S3: documents written as parquet, read back."""
    return _documents_roundtrip(spark, sf_dir, "parquet")


# -- silver pieces -------------------------------------------------------------

def _hourly_vwap(adapter):
    def q(spark, sf_dir):
        inp = _inputs(spark, sf_dir, adapter)
        h = hourly_vwap(inp.trades)
        return h.select("datetime", _text("ticker"), "volume",
                        F.col("avg_price").cast(T.DoubleType()).alias("avg_stock_price"))
    q.__doc__ = f"A1-A4: hourly volume and VWAP ({adapter})."
    return q


def _index_hourly(adapter):
    def q(spark, sf_dir):
        inp = _inputs(spark, sf_dir, adapter)
        h = index_hourly(inp.index)
        return h.select("datetime", F.col("market_index").cast(T.DoubleType()).alias("market_index"))
    q.__doc__ = f"J3, P4: index moved to hour starts ({adapter})."
    return q


def q_join_company_events(spark, sf_dir):
    """Hourly aggregate joined to the company dimension."""
    inp = _inputs(spark, sf_dir, "events")
    h = join_company(hourly_vwap(inp.trades), inp.companies)
    return h.select("datetime", _text("ticker"), "company_name", "volume",
                    F.col("avg_price").cast(T.DoubleType()).alias("avg_stock_price"))


def q_join_index_events(spark, sf_dir):
    """Hourly aggregate joined to the hourly index."""
    _, core = _core(spark, sf_dir, "events")
    return core.select("datetime", _text("ticker"), "volume",
                       F.col("avg_price").cast(T.DoubleType()).alias("avg_price"),
                       F.col("market_index").cast(T.DoubleType()).alias("market_index"))


def q_join_index_fanout_events(spark, sf_dir):
    """J2 with two index rows in every hour - the hour's highest error value
    stamped at the hour, its lowest at half past: each traded hour is
    repeated once per index row of its hour, so twice (bounded duplication,
    not all pairs of a group)."""
    inp = _inputs(spark, sf_dir, "events")
    errors = adapters.table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    per_hour = errors.groupBy(bucket("ts", "hour").alias("hour")).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"))
    two_rows = per_hour.select(F.explode(F.array(
        F.struct(F.col("hour").alias("timestamp"), F.col("hi").alias("value")),
        F.struct((F.col("hour") + F.expr("INTERVAL 30 MINUTES")).alias("timestamp"),
                 F.col("lo").alias("value")))).alias("r"))
    index = two_rows.select(F.col("r.timestamp").alias("timestamp"),
                            F.col("r.value").cast(adapters.INDEX).alias("index_value"))
    core = silver.core(inp.trades, index)
    return core.select("datetime", _text("ticker"), "volume",
                       F.col("avg_price").cast(T.DoubleType()).alias("avg_price"),
                       F.col("market_index").cast(T.DoubleType()).alias("market_index"))


def q_index_duplicate_hours_events(spark, sf_dir):
    """Check: hours with more than one index row, over the raw error events."""
    raw = adapters.table(spark, sf_dir, "events").where(F.col("event_type") == "error").select(
        F.col("ts").alias("timestamp"), F.col("value").alias("index_value"))
    return duplicate_hours(raw)


def _silver(adapter, round_decimals):
    def q(spark, sf_dir):
        inp, core = _core(spark, sf_dir, adapter)
        return silver.report(core, inp.companies, round_decimals=round_decimals)
    kind = "unrounded" if round_decimals is None else f"rounded to {round_decimals}"
    q.__doc__ = f"M4, P6: silver hourly report, {kind} ({adapter})."
    return q


def _gold(adapter, grain):
    def q(spark, sf_dir):
        inp, core = _core(spark, sf_dir, adapter)
        return gold.rollup(core, inp.companies, grain)
    q.__doc__ = f"M5-M7, A5-A9: {grain} rollup ({adapter})."
    return q


def q_preview_hourly_events(spark, sf_dir):
    """O3: first five rows of the rounded hourly report."""
    inp, core = _core(spark, sf_dir, "events")
    return preview(silver.report(core, inp.companies, round_decimals=2, sort=False), 5,
                   ("datetime", "ticker"))


def q_preview_monthly_lineitem(spark, sf_dir):
    """O3: first five rows of the monthly report."""
    inp, core = _core(spark, sf_dir, "lineitem")
    return preview(gold.rollup(core, inp.companies, "month", sort=False), 5, ("month", "ticker"))


# -- sinks ---------------------------------------------------------------------

def q_csv_roundtrip_quarterly(spark, sf_dir):
    """K1-K3: quarterly report written as CSV with header, read back.  AQE
    coalesces the sorted output, so a small report is one file and a large
    one is written by many tasks, in order."""
    inp, core = _core(spark, sf_dir, "lineitem")
    path = write_csv(gold.rollup(core, inp.companies, "quarter"),
                     scratch_path(spark, OUTPUT_NAMES["quarter"]))
    return read_csv(spark, path, report_schema("quarter"))


def q_csv_partitioned_daily(spark, sf_dir):
    """K4: daily report written into year=/month= folders, read back."""
    inp, core = _core(spark, sf_dir, "events")
    path = write_partitioned_csv(gold.rollup(core, inp.companies, "day", sort=False),
                                 scratch_path(spark, OUTPUT_NAMES["day"]), "date")
    return read_csv(spark, path, report_schema("date", partitioned=True))


def q_facade_quarterly_lineitem(spark, sf_dir):
    """M1, M4, M7 through the reference-shaped API: unrounded hourly report,
    then the quarterly rollup of that report."""
    inp = _inputs(spark, sf_dir, "lineitem")
    p = TradeProcessor(spark)
    hourly = p.process_hourly_data(inp.trades, inp.companies, inp.index)
    return p.process_quarterly_data(hourly)


def q_full_run_quarterly(spark, sf_dir):
    """The whole run (silver once, gold from its state, CSV outputs);
    returns the quarterly output as read back from its folder."""
    inp = _inputs(spark, sf_dir, "lineitem")
    written = medallion.run(spark, inp, scratch_path(spark, "run"))
    return read_csv(spark, written["quarter"], report_schema(LABEL_COLUMNS["quarter"]))


def q_full_run_by_ticker(spark, sf_dir):
    """The whole run over silver and state tables laid out by ticker."""
    out = scratch_path(spark, "run-by-ticker")
    medallion.run(spark, _inputs(spark, sf_dir, "lineitem"), out, by_ticker=True)
    return read_csv(spark, f"{out}/{OUTPUT_NAMES['quarter']}", report_schema("quarter"))


def q_full_run_documents(spark, sf_dir):
    """M10 over nested documents, counted for quality in the pass that reads them;
    the quarterly report is found through the published set."""
    out = scratch_path(spark, "run-documents")
    medallion.run(spark, _inputs(spark, sf_dir, "documents"), out)
    return read_csv(spark, f"{out}/{OUTPUT_NAMES['quarter']}", report_schema("quarter"))


def q_full_run_quality(spark, sf_dir):
    """The counts that the run observes while it reads the documents."""
    out = scratch_path(spark, "run-quality")
    inp = _inputs(spark, sf_dir, "documents")
    medallion.run(spark, dataclasses.replace(inp, documents=_mixed_documents(spark, sf_dir)), out, grains=())
    names = ("documents", "corrupt", "null_stamps", "unparsed_stamps", "trades", "null_shares", "null_prices")
    return spark.read.schema(", ".join(f"{n} bigint" for n in names)).json(resolve(spark, f"{out}/_quality"))


def q_incremental_quarterly(spark, sf_dir):
    """M10, A5-A9 in batches: trades and index rows of the same hours come in three
    batches, one of them twice, the index partly after its trades."""
    inp, root = _inputs(spark, sf_dir, "events"), scratch_path(spark, "incremental")
    batch = F.pmod(F.xxhash64("ticker", "shares", "price"), F.lit(3))
    for k in (0, 1, 2, 1):
        index = inp.index.where(F.pmod(F.xxhash64("timestamp"), F.lit(3)) == (k + 1) % 3)
        incremental.add_batch(spark, root, f"batch-{k}", inp.trades.where(batch == k), index)
    return incremental.report(spark, root, inp.companies, "quarter")


def q_replace_month_daily(spark, sf_dir):
    """K4: a set of partitioned reports whose last month was made from doubled volumes
    is put right by a run over that month alone."""
    inp, out = _inputs(spark, sf_dir, "events"), scratch_path(spark, "replace")
    last = inp.trades.agg(F.date_trunc("month", F.max("timestamp"))).first()[0]
    end = (last.replace(day=1) + timedelta(days=32)).replace(day=1)
    wrong = inp.trades.withColumn("shares", F.when(F.col("timestamp") >= F.lit(last), F.col("shares") * 2)
                                  .otherwise(F.col("shares")))
    grains = ("day", "month")
    medallion.run(spark, dataclasses.replace(inp, trades=wrong), out, grains=grains, partitioned=True)
    medallion.run(spark, inp, out, grains=grains, partitioned=True, time_range=(last.isoformat(), end.isoformat()))
    return read_csv(spark, f"{out}/{OUTPUT_NAMES['day']}", report_schema("date", partitioned=True))


# -- inputs in the types the reference takes them ----------------------------------

def _mixed_documents(spark, sf_dir):
    """Raw events as JSON documents of one trade, read back without a schema:
    double prices, three forms of text stamps, and some that are none."""
    e = adapters.table(spark, sf_dir, "events")
    form = F.pmod("event_id", F.lit(5))
    stamp = (F.when(form == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
             .when(form == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(form == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
             .when(form == 3, F.lit("no stamp")))
    trade = F.struct(F.col("user_id").cast("string").alias("ticker"), F.col("event_type").alias("action"),
                     F.get_json_object("props", "$.k").try_cast("bigint").alias("shares"),
                     F.col("value").alias("price"))
    docs = e.select(stamp.alias("timestamp"), F.array(trade).alias("transactions"))
    return read_documents(spark, write_documents(docs, scratch_path(spark, "documents-mixed")))


def q_documents_json_mixed(spark, sf_dir):
    """Prices and shares keep their types, every form of stamp parses,
    what is no stamp is null."""
    trades = explode_transactions(_mixed_documents(spark, sf_dir))
    stamp = as_timestamp("timestamp", trades.schema["timestamp"].dataType)
    return trades.select(stamp.alias("timestamp"), "ticker", "action", "shares", "price")


def q_documents_quality_mixed(spark, sf_dir):
    """S3: what cannot be used of the same documents, counted."""
    return document_quality(_mixed_documents(spark, sf_dir))


def _raw_events(spark, sf_dir, shares="bigint"):
    """Events as trades with undivided double prices, customers, and the undivided
    double index."""
    e = adapters.table(spark, sf_dir, "events")
    trades = e.select(F.col("ts").alias("timestamp"), F.col("user_id").alias("ticker"),
                      F.get_json_object("props", "$.k").try_cast(shares).alias("shares"),
                      F.col("value").alias("price"))
    index = e.where(F.col("event_type") == "error").groupBy(bucket("ts", "hour").alias("timestamp")).agg(
        (F.max("value") / 7).alias("index_value"))
    return trades, adapters.customer_companies(spark, sf_dir), index


def q_silver_unrounded_events_double(spark, sf_dir):
    """The unrounded report over double prices; doubles are compared at 6 decimals."""
    trades, companies, index = _raw_events(spark, sf_dir)
    report = silver.hourly(trades, companies, index)
    return report.withColumns({c: F.round(c, 6) for c in ("avg_price", "market_index")})


def q_gold_daily_events_wide_index(spark, sf_dir):
    """A double index with all its digits is averaged before it is rounded."""
    _, companies, index = _raw_events(spark, sf_dir)
    core = silver.core(adapters.events_trades(spark, sf_dir), index)
    return gold.rollup(core, companies, "day")


def q_hourly_vwap_fractional_shares(spark, sf_dir):
    """A2-A4: fractional shares make a fractional volume; compared at 6 decimals."""
    trades, _, _ = _raw_events(spark, sf_dir)
    halves = trades.withColumn("shares", F.col("shares").cast("double") / 4)
    return hourly_vwap(halves).select("datetime", _text("ticker"), F.round("volume", 6).alias("volume"),
                                      F.round("avg_price", 6).alias("avg_stock_price"))


def _facade(grain):
    def q(spark, sf_dir):
        inp = _inputs(spark, sf_dir, "events")
        p = TradeProcessor(spark)
        hourly = p.process_hourly_data(inp.trades, inp.companies, inp.index)
        return getattr(p, f"process_{_GRAIN_NAMES[grain]}_data")(hourly)
    q.__doc__ = f"M4, M5-M7 through the reference-shaped API: {grain} report (events)."
    return q


def q_join_company_duplicates(spark, sf_dir):
    """J1 with every company listed twice: a day has one row of doubled volume."""
    inp, core = _core(spark, sf_dir, "events")
    return gold.rollup(core, inp.companies.union(inp.companies), "day")


def q_order_documents_sizes(spark, sf_dir):
    """G1: trades and documents of each order."""
    docs = adapters.order_documents(spark, sf_dir)
    order = F.substring_index("doc_id", "-", 1).cast("bigint")
    return docs.groupBy(order.alias("order_id")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.size("transactions")).cast("bigint").alias("trades"))


def q_csv_roundtrip_unrounded(spark, sf_dir):
    """K1: an unrounded report is written with all the digits it has."""
    trades, companies, index = _raw_events(spark, sf_dir)
    report = silver.hourly(trades, companies, index)
    back = read_csv(spark, write_csv(report, scratch_path(spark, "unrounded")), report_schema("datetime"))
    return back.withColumns({c: F.round(c, 6) for c in ("avg_price", "market_index")})


def _pinned(query: Query) -> Query:
    """``query`` with its plan built under the settings that results depend on."""
    @functools.wraps(query)
    def q(spark, sf_dir):
        with settings(spark):
            return query(spark, sf_dir)
    return q


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "q_explode_documents": q_explode_documents,
        "q_explode_element_stamps": q_explode_element_stamps,
        "q_documents_json": q_documents_json,
        "q_documents_parquet": q_documents_parquet,
        "q_hourly_vwap_events": _hourly_vwap("events"),
        "q_hourly_vwap_lineitem": _hourly_vwap("lineitem"),
        "q_index_hourly_events": _index_hourly("events"),
        "q_index_hourly_lineitem": _index_hourly("lineitem"),
        "q_index_duplicate_hours_events": q_index_duplicate_hours_events,
        "q_join_company_events": q_join_company_events,
        "q_join_index_events": q_join_index_events,
        "q_join_index_fanout_events": q_join_index_fanout_events,
        "q_silver_unrounded_events": _silver("events", None),
        "q_silver_rounded_events": _silver("events", 2),
        "q_silver_rounded_lineitem": _silver("lineitem", 2),
    }
    for adapter in ("events", "lineitem"):
        for grain in gold.GOLD_GRAINS:
            out[f"q_gold_{_GRAIN_NAMES[grain]}_{adapter}"] = _gold(adapter, grain)
    out["q_gold_quarterly_documents"] = _gold("documents", "quarter")
    out.update({
        "q_preview_hourly_events": q_preview_hourly_events,
        "q_preview_monthly_lineitem": q_preview_monthly_lineitem,
        "q_csv_roundtrip_quarterly": q_csv_roundtrip_quarterly,
        "q_csv_partitioned_daily": q_csv_partitioned_daily,
        "q_facade_quarterly_lineitem": q_facade_quarterly_lineitem,
        "q_full_run_quarterly": q_full_run_quarterly,
        "q_documents_json_mixed": q_documents_json_mixed,
        "q_documents_quality_mixed": q_documents_quality_mixed,
        "q_silver_unrounded_events_double": q_silver_unrounded_events_double,
        "q_gold_daily_events_wide_index": q_gold_daily_events_wide_index,
        "q_hourly_vwap_fractional_shares": q_hourly_vwap_fractional_shares,
        "q_facade_daily_events": _facade("day"),
        "q_facade_monthly_events": _facade("month"),
        "q_join_company_duplicates": q_join_company_duplicates,
        "q_order_documents_sizes": q_order_documents_sizes,
        "q_csv_roundtrip_unrounded": q_csv_roundtrip_unrounded,
        "q_documents_json_array": q_documents_json_array,
        "q_documents_variant": q_documents_variant,
        "q_full_run_documents": q_full_run_documents,
        "q_full_run_quality": q_full_run_quality,
        "q_full_run_by_ticker": q_full_run_by_ticker,
        "q_incremental_quarterly": q_incremental_quarterly,
        "q_replace_month_daily": q_replace_month_daily,
    })
    return {name: _pinned(q) for name, q in out.items()}


_GRAIN_NAMES = {"day": "daily", "month": "monthly", "quarter": "quarterly"}

__all__ = ["queries"]
