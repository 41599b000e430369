"""Hourly volume and volume-weighted average price per ticker (A1-A4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.functions.numeric import PRICE_SCALE, PRICE_TYPE, exact_product, mean_half_up
from tickfold.functions.time import as_timestamp, bucket


def trade_sums(trades: DataFrame) -> list[Column]:
    """The two sums of an hour, shares and notional, in the types of the source."""
    shares, price = (trades.schema[c].dataType for c in ("shares", "price"))
    value = F.col("price") if exact_product(shares, price) else F.col("price").cast(T.DoubleType())
    return [F.sum("shares").alias("volume"), F.sum(F.col("shares") * value).alias("notional")]


def vwap_columns(sums: DataFrame) -> list[Column]:
    """``volume``, ``notional`` and ``avg_price`` = notional / volume (null when
    the volume is 0): half-up to 10 decimals where both sums are exact, else double."""
    kind = sums.schema["notional"].dataType
    if isinstance(kind, T.DecimalType):
        price = mean_half_up("notional", kind.scale, "volume", PRICE_SCALE).cast(PRICE_TYPE)
    else:
        price = F.try_divide(F.col("notional"), F.col("volume").cast(T.DoubleType()))
    return [F.col("volume"), F.col("notional"), price.alias("avg_price")]


def hourly_vwap(trades: DataFrame, grain: str = "hour") -> DataFrame:
    """``(datetime, ticker, volume, notional, avg_price)``, one row per traded
    (hour, ticker).

    * ``volume`` = sum of shares (buys and sells alike; ``action`` is not
      read), whole, decimal or double like the shares;
    * ``notional`` = sum of shares * price, exact for whole shares and decimal
      prices; a trade without a price still adds its shares to ``volume``;
    * ``avg_price`` = notional / volume; null when the volume is 0 or no trade
      of the hour has a price.

    Both sums are partial-aggregated in the scan tasks, so a hot ticker is
    combined before the shuffle and only one row per (task, hour, ticker)
    crosses the network.
    """
    stamp = as_timestamp("timestamp", trades.schema["timestamp"].dataType)
    agg = trades.groupBy(bucket(stamp, grain).alias("datetime"), F.col("ticker")).agg(
        *trade_sums(trades))
    return agg.select("datetime", "ticker", *vwap_columns(agg))
