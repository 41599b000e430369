"""Random small fixtures against a brute-force Decimal computation."""

from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickfold import schemas
from tickfold.plans import gold, silver

BASE = datetime(2024, 3, 30, 20)
TICKERS = ["A", "B", "C"]

trade = st.tuples(st.integers(0, 80), st.sampled_from(TICKERS + ["Z"]), st.integers(0, 50),
                  st.one_of(st.none(), st.integers(0, 10**7)))


def half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def label(hour: int, grain: str) -> str:
    t = BASE + timedelta(hours=hour)
    if grain == "day":
        return t.date().isoformat()
    if grain == "month":
        return f"{t.year:04d}-{t.month:02d}"
    return f"{t.year} Q{(t.month - 1) // 3 + 1}"


def brute(trades, index, grain="day"):
    # SQL sums: the notional of an hour whose prices are all null is null
    hourly = defaultdict(lambda: [0, None])
    for h, t, n, cents in trades:
        cell = hourly[(h, t)]
        cell[0] += n
        if cents is not None:
            cell[1] = (cell[1] or Decimal(0)) + n * Decimal(cents) / 100
    day = defaultdict(lambda: [[], 0, []])
    for (h, t), (vol, notional) in hourly.items():
        if t not in TICKERS or h not in index:
            continue
        price = half_up(notional / vol, 10) if vol and notional is not None else None
        d = label(h, grain)
        cell = day[(d, t)]
        if price is not None:
            cell[0].append(price)
        cell[1] += vol
        cell[2].append(index[h])
    out = set()
    for (d, t), (prices, vol, idx) in day.items():
        p = float(half_up(sum(prices) / len(prices), 2)) if prices else None
        i = float(half_up(sum(idx) / len(idx), 2))
        out.add((d, t, p, vol, i))
    return out


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trade, min_size=1, max_size=40),
       st.sets(st.integers(0, 80), min_size=1, max_size=60),
       st.integers(0, 10**6))
def test_rollups_match_brute_force(spark, trades, index_hours, seed):
    index = {h: Decimal(((seed + 37 * h) % 900000) + 1000) / 100 for h in index_hours}
    tdf = spark.createDataFrame(
        [(BASE + timedelta(hours=h, minutes=7), t, "BUY", n,
          None if c is None else Decimal(c) / 100) for h, t, n, c in trades], schemas.TRADES)
    idf = spark.createDataFrame([(BASE + timedelta(hours=h), v) for h, v in index.items()],
                                schemas.MARKET_INDEX)
    comp = spark.createDataFrame([(t, t.lower()) for t in TICKERS], schemas.COMPANIES)
    reports = gold.rollups(silver.core(tdf, idf), comp)
    for grain, report in reports.items():
        got = {(r[0], r.ticker, r.avg_price, r.volume, r.market_index)
               for r in report.collect()}
        assert got == brute(trades, index, grain), grain
