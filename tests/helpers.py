"""Small frames for the hand-made cases."""

from datetime import datetime
from decimal import Decimal

from tickfold import schemas


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def d(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


def trades(spark, rows):
    """rows: (stamp, ticker, shares, price)."""
    return spark.createDataFrame(
        [(ts(t), k, "BUY", n, d(p)) for t, k, n, p in rows], schemas.TRADES)


def companies(spark, rows):
    return spark.createDataFrame(rows, schemas.COMPANIES)


def index(spark, rows):
    """rows: (stamp, value)."""
    return spark.createDataFrame([(ts(t), d(v)) for t, v in rows], schemas.MARKET_INDEX)
