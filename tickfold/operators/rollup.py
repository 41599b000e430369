"""Coarser-grain rollups of the hourly table.

A rollup is carried as an additive *state* per (period, ticker):

    price_sum, price_n   sum and count of the hourly prices (nulls skipped)
    volume               sum of hourly volumes
    index_sum, index_n   sum and count of the hourly index values

Sums and counts add up, so a month is rolled from days and a quarter from
months without going back to the hourly rows, and every state is partial-
aggregated in the map tasks before its shuffle.  The prices and index of a
period are plain means over its hourly rows (not volume-weighted), and the
index is averaged only over the hours in which that ticker traded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.functions.numeric import REPORT_DECIMALS, mean
from tickfold.functions.time import LABEL_COLUMNS, bucket, check_grain, period_label
from tickfold.operators.joins import join_company

SUMS = ("price_sum", "price_n", "volume", "index_sum", "index_n")


def period_state(core: DataFrame, grain: str, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """State per (period, ``keys``) from silver core rows
    ``(datetime, ticker, volume, avg_price, market_index)``."""
    return core.groupBy(bucket("datetime", check_grain(grain)).alias("period"), *keys).agg(
        F.sum("avg_price").alias("price_sum"),
        F.count("avg_price").alias("price_n"),
        F.sum("volume").alias("volume"),
        F.sum("market_index").alias("index_sum"),
        F.count("market_index").alias("index_n"),
    )


def period_state_by_quarter(core: DataFrame, grain: str) -> DataFrame:
    """:func:`period_state` with the rows of a ticker's quarter in one task: written so,
    the coarser states are summed in the tasks that read it, and little is left to
    shuffle.  A ticker has one row per hour and index row, however many trades."""
    rows = core.select("datetime", "ticker", "volume", "avg_price", "market_index",
                       bucket("datetime", "quarter").alias("_quarter")).repartition("_quarter", "ticker")
    return period_state(rows, grain, ("_quarter", "ticker")).drop("_quarter")


def coarsen(state: DataFrame, grain: str) -> DataFrame:
    """Roll a finer state up to ``grain`` by adding its sums and counts."""
    keys = [c for c in state.columns if c != "period" and c not in SUMS]
    return state.groupBy(bucket("period", check_grain(grain)).alias("period"), *keys).agg(
        *[F.sum(c).alias(c) for c in SUMS])


def finish(state: DataFrame, companies: DataFrame | None, grain: str, sort: bool = True,
           decimals: int = REPORT_DECIMALS) -> DataFrame:
    """Report ``(<label>, ticker, company_name, avg_price, volume, market_index)``.

    The company join runs on the rolled-up rows, far fewer than the hourly
    ones.  Equal (ticker, company_name) rows of ``companies`` are counted first
    and their number multiplies the volume, as if each hourly row had been
    joined with each of them; it cancels out of the means.
    ``companies=None`` means the state already carries ``company_name`` as a
    key.  Means are half-up rounded to ``decimals`` and given as double;
    ``sort`` orders by period start, then ticker.
    """
    volume = F.col("volume")
    joined = state
    if companies is not None:
        names = companies.groupBy("ticker", "company_name").agg(F.count(F.lit(1)).alias("copies"))
        joined = join_company(state, names, extra=("copies",))
        volume = (volume * F.col("copies")).cast(state.schema["volume"].dataType)
    out = joined.select(
        "period",
        F.col("ticker").cast("string").alias("ticker"),
        "company_name",
        mean("price_sum", state.schema["price_sum"].dataType, "price_n", decimals).alias("avg_price"),
        volume.alias("volume"),
        mean("index_sum", state.schema["index_sum"].dataType, "index_n", decimals).alias("market_index"),
    )
    if sort:
        out = out.orderBy("period", "ticker")
    # The label is printed after the sort, which then neither samples nor moves it.
    label = period_label("period", grain).alias(LABEL_COLUMNS[check_grain(grain)])
    return out.select(label, *[c for c in out.columns if c != "period"])
