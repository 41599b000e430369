"""Price arithmetic: exact where the input is, double where it is double.

Sums of decimals and whole numbers are exact, so a result does not
depend on how Spark splits rows into tasks or in which order partial sums
meet, as a double sum would.  A mean is one decimal division followed by a
half-up ``round``:

* the quotient of a sum with at most 18 integer digits by a count is typed
  ``decimal(38,20)`` (Spark's decimal rules, ``allowPrecisionLoss`` on, which
  ``session.settings`` pins), i.e. rounded half-up at 20 decimals;
* the exact quotient of a sum with ``s`` decimals by ``n`` lies at least
  ``1 / (2 * n * 10**(s + d))`` away from any tie at ``d`` decimals unless it
  is a tie, so rounding the 20-decimal quotient to ``d`` decimals equals
  rounding the exact quotient whenever ``n < 10**(20 - s - d)`` - for the
  hourly price (``s=2, d=10``) that is 10 billion shares in one hour and
  ticker, for a period mean (``s=10, d=2``) 100 million hourly rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Silver keeps an exact hourly price with 10 decimals; gold and
# the rounded silver report print 2 decimals.
PRICE_SCALE = 10
PRICE_TYPE = T.DecimalType(28, PRICE_SCALE)
REPORT_DECIMALS = 2
# Integer digits a summed numerator may have (see the module text).
SUM_INTEGER_DIGITS = 18


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def exact_product(shares: T.DataType, price: T.DataType) -> bool:
    """Whole shares times a decimal price whose product and sum keep all digits
    (a product beyond 38 digits keeps 6 decimals by Spark's rules)."""
    if not (is_whole(shares) and isinstance(price, T.DecimalType)):
        return False
    digits = 20 if isinstance(shares, T.LongType) else 10
    return price.scale <= 6 or price.precision + digits + 1 <= 38


def mean_half_up(total: Column | str, total_scale: int, count: Column | str,
                 decimals: int) -> Column:
    """``round_half_up(total / count, decimals)`` as a decimal; null when
    ``count`` is 0 or null.  ``total`` is a decimal sum with ``total_scale``
    decimals (a notional, a sum of prices), ``count`` a whole number."""
    num = _c(total).cast(T.DecimalType(SUM_INTEGER_DIGITS + total_scale, total_scale))
    return F.round(F.try_divide(num, _c(count).cast(T.LongType())), decimals)


def mean(total: Column | str, dtype: T.DataType, count: Column | str, decimals: int) -> Column:
    """Mean of a summed column as double, half-up at ``decimals``; a decimal
    sum is divided exactly, a double one as doubles are.  The last bits of a
    double sum depend on the order of its rows, so its mean is taken at 9
    decimals first: a tie is a tie in every order."""
    if isinstance(dtype, T.DecimalType):
        return mean_half_up(total, dtype.scale, count, decimals).cast(T.DoubleType())
    ratio = F.try_divide(_c(total).cast(T.DoubleType()), _c(count).cast(T.DoubleType()))
    return F.round(F.round(ratio, 9), decimals)


def report_value(col: Column | str, decimals: int | None = REPORT_DECIMALS) -> Column:
    """A number handed out as double, half-up rounded first unless
    ``decimals`` is None."""
    c = _c(col)
    return (c if decimals is None else F.round(c, decimals)).cast(T.DoubleType())
