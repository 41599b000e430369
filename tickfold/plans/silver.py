"""Silver layer: hourly table of volume, VWAP, company name and index.

Split in two so the expensive part runs once:

* :func:`core` - trades -> hourly aggregate -> join with the hourly index.
  No company names, no formatting; this is what gold rolls up and what
  ``medallion.run`` materialises.
* :func:`report` - core -> company join -> label, optional rounding, sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold import schemas
from tickfold.functions.numeric import report_value
from tickfold.functions.time import period_label
from tickfold.operators.explode import explode_transactions
from tickfold.operators.hourly import hourly_vwap
from tickfold.operators.index import index_hourly
from tickfold.operators.joins import join_company, join_index
from tickfold.schemas import require
from tickfold.sources.adapters import Inputs

# Columns the hourly step reads (``action`` is carried but never used).
TRADE_COLUMNS = T.StructType([f for f in schemas.TRADES.fields if f.name != "action"])


def trades_of(inputs: Inputs) -> DataFrame:
    """Flat trades of a run: given directly, or exploded from documents."""
    if inputs.trades is not None:
        return inputs.trades
    return explode_transactions(inputs.documents)


def core(trades: DataFrame, market_index: DataFrame) -> DataFrame:
    """``(datetime, ticker, volume, notional, avg_price, market_index)`` per
    traded hour with an index row, in the types of the sources."""
    return joined_core(trades, index_hourly(market_index))


def joined_core(trades: DataFrame, by_hour: DataFrame, check: bool = False) -> DataFrame:
    """:func:`core` for an index that is by hour already; see ``join_index``."""
    require(trades, TRADE_COLUMNS, "trades")
    # A trade without a stamp joins no hour; the raw column's filter reaches the scan.
    return join_index(hourly_vwap(trades.where(F.col("timestamp").isNotNull())), by_hour, check)


def rounded(core_rows: DataFrame, companies: DataFrame, round_decimals: int | None = None) -> DataFrame:
    """Core rows with ``company_name``, price and index rounded if asked, as
    gold rolls them up: timestamps and numbers, nothing printed."""
    joined = join_company(core_rows, companies)
    if round_decimals is not None:
        for c in ("avg_price", "market_index"):
            joined = joined.withColumn(c, F.round(c, round_decimals))
    return joined.select("datetime", "ticker", "company_name", "volume", "avg_price", "market_index")


def report(core_rows: DataFrame, companies: DataFrame, round_decimals: int | None = None,
           sort: bool = True) -> DataFrame:
    """``(datetime, ticker, company_name, avg_price, volume, market_index)``
    with ``datetime`` as ``yyyy-MM-dd HH:mm:ss`` text.  Prices and index are
    doubles, half-up rounded to ``round_decimals``; unrounded, the price is the
    plain ratio of the two sums."""
    require(companies, schemas.COMPANIES, "companies")
    joined = join_company(core_rows, companies)
    price = report_value("avg_price", round_decimals)
    if round_decimals is None:
        price = F.try_divide(F.col("notional").cast(T.DoubleType()), F.col("volume").cast(T.DoubleType()))
    index = report_value("market_index", round_decimals)
    out = joined.select(
        F.col("datetime").alias("_hour"),
        F.col("ticker").cast("string").alias("ticker"), "company_name",
        price.alias("avg_price"),
        F.col("volume"),
        index.alias("market_index"),
    )
    if sort:
        out = out.orderBy("_hour", "ticker")
    # The label is printed after the sort, which then neither samples nor moves it.
    return out.select(period_label("_hour", "hour").alias("datetime"), *[c for c in out.columns if c != "_hour"])


def hourly(trades: DataFrame, companies: DataFrame, market_index: DataFrame,
           round_decimals: int | None = None, sort: bool = True) -> DataFrame:
    """The reference's hourly table in one call: :func:`core` then :func:`report`."""
    return report(core(trades, market_index), companies, round_decimals, sort)


