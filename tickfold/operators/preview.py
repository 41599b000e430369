"""First rows of a sorted report (O3) - as a DataFrame, never printed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(report: DataFrame, n: int = 5, order: tuple[str, ...] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order`` (default: the label column, then
    ticker).  Spark plans sort + limit as a top-k: each task keeps its ``n``
    best rows and only those reach the final merge, so no global sort runs."""
    order = order or (report.columns[0], "ticker")
    return report.orderBy(*order).limit(n)
