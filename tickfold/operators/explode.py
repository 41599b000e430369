"""Generator: nested documents -> one row per trade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRADE_FIELDS = ("ticker", "action", "shares", "price")


def explode_transactions(
    documents: DataFrame,
    array_col: str = "transactions",
    timestamp_from: str = "document",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(timestamp, ticker, action, shares, price)`` per array element.

    A plain ``explode``: a document whose array is null or empty yields no row.
    ``timestamp_from="document"`` takes the document's stamp for every trade;
    ``"element"`` takes each element's own ``timestamp`` field.  ``keep`` names
    extra document columns to carry along.  No shuffle: the generator runs in
    the scan's tasks, and only the struct fields named here are read.
    """
    if timestamp_from not in ("document", "element"):
        raise ValueError("timestamp_from must be 'document' or 'element'")
    parent = [F.col("timestamp")] if timestamp_from == "document" else []
    rows = documents.select(*parent, *keep, F.explode(array_col).alias("transaction"))
    stamp = F.col("timestamp") if timestamp_from == "document" else F.col("transaction.timestamp")
    return rows.select(
        stamp.alias("timestamp"),
        *[F.col(f"transaction.{name}").alias(name) for name in TRADE_FIELDS],
        *keep,
    )
