"""Inner equi-joins of the silver layer (J1, J2) and the size-checked
broadcast they use.

Policy (see ``session.SESSION_CONF``): a side is broadcast only when its size
is *proven* small - either by :func:`bounded_size` below, which counts rows and
string bytes with one aggregate, or by AQE measuring a materialised shuffle stage.  Anything bigger is a shuffle join
on the key, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed limits of a broadcast dimension.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16  # bytes counted per non-string value


def bounded_size(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                 max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[int, int] | None:
    """``(rows, bytes)`` of ``df`` if it holds at most ``max_rows`` rows and
    about ``max_bytes`` bytes, else ``None``.

    One aggregate over the pruned columns, combined in the scan tasks; only a
    two-number row meets in one task and comes back to the driver.
    """
    widths = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            widths.append(F.lit(_FIXED_WIDTH))
    row_bytes = sum(widths[1:], widths[0]) if widths else F.lit(0)
    rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes.cast("long"))).first()
    size = size or 0
    if rows > max_rows or size > max_bytes:
        return None
    return rows, size


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str],
                   how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``fact`` joined to a dimension table, broadcasting the dimension only
    when :func:`bounded_size` proves it small; otherwise a shuffle join."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("the dimension must be the build side: use an inner or left join")
    if bounded_size(dim, max_rows, max_bytes) is not None:
        return fact.join(F.broadcast(dim), on, how)
    return fact.join(dim, on, how)


def join_company(hourly: DataFrame, companies: DataFrame, broadcast: str = "adaptive",
                 max_rows: int = BROADCAST_MAX_ROWS,
                 max_bytes: int = BROADCAST_MAX_BYTES, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keep rows whose ticker has a company row, adding ``company_name`` and ``extra`` columns.
    A ticker with two company rows appears twice.

    ``broadcast="adaptive"`` (default) plans a shuffle join and lets AQE
    measure the company stage: below the adaptive threshold it becomes a
    broadcast join before the fact side is shuffled for it; above, it stays a
    sort-merge join.  No extra job runs.  ``"check"`` proves the size first
    with :func:`bounded_size` and broadcasts by hint (a static plan);
    ``"never"`` always shuffles.
    """
    dim = companies.select("ticker", "company_name", *extra).where(F.col("ticker").isNotNull())
    if broadcast == "check":
        return join_dimension(hourly, dim, "ticker", max_rows=max_rows, max_bytes=max_bytes)
    if broadcast not in ("adaptive", "never"):
        raise ValueError("broadcast must be 'adaptive', 'check' or 'never'")
    joined = hourly.join(dim, "ticker")
    return joined.hint("shuffle_merge") if broadcast == "never" else joined


def join_index(hourly: DataFrame, index_by_hour: DataFrame, check: bool = False) -> DataFrame:
    """Keep rows whose hour has an index row, adding ``market_index``.

    The index side is an aggregate or a scan of unknown size, so the join is
    left to AQE: both sides are shuffled on ``datetime``; once the index stage
    has run and measures below the adaptive threshold, AQE turns the join into
    a broadcast join, else it stays sort-merge with skew splitting.
    ``check=True`` proves the size first, for an index that is already a
    written table (``medallion.run``): the fact is then not shuffled on the
    hour alone while the index stage is still running.
    """
    if check:
        return join_dimension(hourly, index_by_hour.where(F.col("datetime").isNotNull()), "datetime")
    return hourly.join(index_by_hour.where(F.col("datetime").isNotNull()), "datetime")
