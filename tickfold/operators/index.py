"""Market index aligned to hour buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.functions.time import as_timestamp, bucket


def index_hourly(market_index: DataFrame, ts_col: str = "timestamp",
                 value_col: str = "index_value") -> DataFrame:
    """``(datetime, market_index)``: each index row moved to the start of its
    hour.  Rows are not de-duplicated: two stamps in one hour give two rows,
    and the join after it repeats the trade row for each (see
    :func:`duplicate_hours`).  Text stamps that do not parse become null and
    so never join.  The value keeps its type."""
    stamp = as_timestamp(ts_col, market_index.schema[ts_col].dataType)
    return market_index.select(bucket(stamp, "hour").alias("datetime"),
                               F.col(value_col).alias("market_index"))


def duplicate_hours(market_index: DataFrame, ts_col: str = "timestamp",
                    value_col: str = "index_value") -> DataFrame:
    """Hours holding more than one index row ``(datetime, rows)``: the hours
    whose trades the index join repeats."""
    h = index_hourly(market_index, ts_col, value_col)
    return h.groupBy("datetime").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def unparsed_stamps(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """One row ``(rows, unparsed)``: how many rows carry a stamp that is
    present but does not parse (and so never joins).  One aggregate job; only
    the two counts reach the caller."""
    raw = F.col(ts_col)
    parsed = as_timestamp(ts_col, df.schema[ts_col].dataType)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count(F.when(raw.isNotNull() & parsed.isNull(), 1)).alias("unparsed"))
