"""Explicit schemas of the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

# One trade inside a document.  Prices are decimals so that sums are exact.
TRADE_ELEMENT = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("shares", T.IntegerType()),
    T.StructField("price", T.DecimalType(18, 2)),
])

# A document: one stamp for the whole document, and its trades.
DOCUMENT = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("transactions", T.ArrayType(TRADE_ELEMENT)),
])

# The same document as a document store hands it over: stamp as text, floating
# prices and shares.
DOCUMENT_OPEN = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("transactions", T.ArrayType(T.StructType([
        T.StructField("ticker", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("shares", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]))),
])

# Bronze trade rows (after explode); numbers may have any numeric type, tickers
# may be numbers, stamps text.
TRADES = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("shares", T.IntegerType()),
    T.StructField("price", T.DecimalType(18, 2)),
])

COMPANIES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("company_name", T.StringType()),
])

MARKET_INDEX = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("index_value", T.DecimalType(10, 2)),
])

def missing_columns(schema: T.StructType, required: T.StructType) -> list[str]:
    have = {f.name for f in schema.fields}
    return [f.name for f in required.fields if f.name not in have]


def require(df, required: T.StructType, what: str):
    """Fail early, with the names, when a source lacks required columns."""
    missing = missing_columns(df.schema, required)
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
    return df
