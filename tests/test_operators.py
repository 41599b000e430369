"""Hand-made cases of the hourly, join and rollup operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import companies, index, trades, ts
from tickfold.operators.hourly import hourly_vwap
from tickfold.operators.index import duplicate_hours, index_hourly, unparsed_stamps
from tickfold.plans import gold, silver

ACME = [("ACME", "Acme & Co.")]


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_vwap(spark):
    h = one(hourly_vwap(trades(spark, [("2024-10-01 09:05:00", "ACME", 10, 1.5),
                                       ("2024-10-01 09:55:00", "ACME", 30, 2.5)])))
    assert h.datetime == datetime(2024, 10, 1, 9)
    assert h.volume == 40
    assert float(h.avg_price) == 2.25


def test_buys_and_sells_both_count(spark):
    df = trades(spark, [("2024-10-01 09:05:00", "ACME", 10, 1.5)])
    df = df.unionByName(df.withColumn("action", F.lit("SELL")))
    assert one(hourly_vwap(df)).volume == 20


def test_zero_volume_gives_null_price(spark):
    h = one(hourly_vwap(trades(spark, [("2024-10-01 09:05:00", "ACME", 0, 3.0)])))
    assert h.volume == 0 and h.avg_price is None


def test_null_price_still_counts_shares(spark):
    h = one(hourly_vwap(trades(spark, [("2024-10-01 09:05:00", "ACME", 7, None),
                                       ("2024-10-01 09:10:00", "ACME", 3, 4.0)])))
    assert h.volume == 10
    assert float(h.avg_price) == 1.2


def test_vwap_half_up_at_ten_decimals(spark):
    # 2 @ 0.01 and 1 @ 0.00 -> 0.02 / 3 = 0.006666...67
    h = one(hourly_vwap(trades(spark, [("2024-10-01 09:05:00", "ACME", 2, 0.01),
                                       ("2024-10-01 09:10:00", "ACME", 1, 0.0)])))
    assert str(h.avg_price) == "0.0066666667"


def test_float_prices_stay_floats(spark):
    df = trades(spark, [("2024-10-01 09:05:00", "ACME", 1, 0.1),
                        ("2024-10-01 09:06:00", "ACME", 1, 0.2)])
    df = df.withColumn("price", F.col("price").cast("double"))
    assert abs(one(hourly_vwap(df)).avg_price - 0.15) < 1e-15


def _core(spark, trade_rows, index_rows):
    return silver.core(trades(spark, trade_rows), index(spark, index_rows))


def test_missing_company_is_dropped(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 1, 1.0),
                         ("2024-10-01 09:05:00", "NONE", 1, 1.0)],
                 [("2024-10-01 09:00:00", 100.0)])
    rows = silver.report(core, companies(spark, ACME)).collect()
    assert [r.ticker for r in rows] == ["ACME"]
    assert rows[0].company_name == "Acme & Co."


def test_missing_index_hour_is_dropped(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 1, 1.0),
                         ("2024-10-01 10:05:00", "ACME", 1, 1.0)],
                 [("2024-10-01 09:00:00", 100.0)])
    assert [r.datetime for r in core.collect()] == [datetime(2024, 10, 1, 9)]


def test_duplicate_index_hour_doubles_row_and_volume(spark):
    trade_rows = [("2024-10-01 09:05:00", "ACME", 5, 1.0)]
    idx = [("2024-10-01 09:00:00", 100.0), ("2024-10-01 09:30:00", 100.0)]
    core = _core(spark, trade_rows, idx)
    assert core.count() == 2
    day = one(gold.rollup(core, companies(spark, ACME), "day"))
    assert day.volume == 10
    assert one(duplicate_hours(index(spark, idx))).rows == 2


def test_index_is_moved_to_hour_start(spark):
    h = one(index_hourly(index(spark, [("2024-10-01 09:59:59", 1.5)])))
    assert h.datetime == datetime(2024, 10, 1, 9)


def test_text_stamps_parse_and_bad_ones_never_join(spark):
    raw = spark.createDataFrame([("2024-10-01 09:15:00", 1.0), ("not a time", 2.0)],
                                "timestamp string, index_value double")
    rows = index_hourly(raw).orderBy("market_index").collect()
    assert rows[0].datetime == datetime(2024, 10, 1, 9)
    assert rows[1].datetime is None
    assert tuple(unparsed_stamps(raw).first()) == (2, 1)


def test_gold_price_is_mean_of_hours_not_weighted(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 10, 1.5),
                         ("2024-10-01 09:10:00", "ACME", 30, 2.5),
                         ("2024-10-01 10:05:00", "ACME", 5, 9.0)],
                 [("2024-10-01 09:00:00", 100.10), ("2024-10-01 10:00:00", 101.15),
                  ("2024-10-01 11:00:00", 500.00)])
    day = one(gold.rollup(core, companies(spark, ACME), "day"))
    assert day.date == "2024-10-01"
    assert day.avg_price == 5.63          # (2.25 + 9.0) / 2 = 5.625, half-up
    assert day.volume == 45
    assert day.market_index == 100.63     # only hours ACME traded: 100.625, half-up


def test_zero_volume_hour_keeps_its_index_in_rollup(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 0, 1.0),
                         ("2024-10-01 10:05:00", "ACME", 2, 3.0)],
                 [("2024-10-01 09:00:00", 100.00), ("2024-10-01 10:00:00", 101.00)])
    day = one(gold.rollup(core, companies(spark, ACME), "day"))
    assert day.avg_price == 3.0 and day.market_index == 100.5 and day.volume == 2


def test_all_prices_null_gives_null_mean(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 0, 1.0)],
                 [("2024-10-01 09:00:00", 100.00)])
    day = one(gold.rollup(core, companies(spark, ACME), "day"))
    assert day.avg_price is None and day.market_index == 100.0


@pytest.mark.parametrize("grain,labels", [
    ("quarter", ["2024 Q1", "2024 Q2"]),
    ("month", ["2024-03", "2024-04"]),
    ("day", ["2024-03-31", "2024-04-01"]),
])
def test_period_edges(spark, grain, labels):
    core = _core(spark, [("2024-03-31 23:59:00", "ACME", 1, 1.0),
                         ("2024-04-01 00:00:00", "ACME", 1, 1.0)],
                 [("2024-03-31 23:00:00", 1.0), ("2024-04-01 00:00:00", 1.0)])
    rows = gold.rollup(core, companies(spark, ACME), grain).collect()
    assert [r[0] for r in rows] == labels


def test_hourly_report_rounding_and_label(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 2, 0.01),
                         ("2024-10-01 09:10:00", "ACME", 1, 0.0)],
                 [("2024-10-01 09:00:00", 2277.80)])
    exact = one(silver.report(core, companies(spark, ACME)))
    rounded = one(silver.report(core, companies(spark, ACME), round_decimals=2))
    assert exact.datetime == "2024-10-01 09:00:00"
    assert exact.avg_price == 0.02 / 3
    assert rounded.avg_price == 0.01 and rounded.market_index == 2277.8


def test_round_half_up_ties(spark):
    # 1.005 is a tie at two decimals: half-up gives 1.01
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 1, 1.00),
                         ("2024-10-01 10:05:00", "ACME", 1, 1.01)],
                 [("2024-10-01 09:00:00", 1.0), ("2024-10-01 10:00:00", 1.0)])
    assert one(gold.rollup(core, companies(spark, ACME), "day")).avg_price == 1.01


def test_reports_are_sorted(spark):
    core = _core(spark, [("2024-10-02 09:05:00", "B", 1, 1.0), ("2024-10-01 09:05:00", "B", 1, 1.0),
                         ("2024-10-01 09:05:00", "A", 1, 1.0)],
                 [("2024-10-01 09:00:00", 1.0), ("2024-10-02 09:00:00", 1.0)])
    comp = companies(spark, [("A", "a"), ("B", "b")])
    rows = silver.report(core, comp).collect()
    assert [(r.datetime[:10], r.ticker) for r in rows] == [
        ("2024-10-01", "A"), ("2024-10-01", "B"), ("2024-10-02", "B")]
    rows = gold.rollup(core, comp, "day").collect()
    assert [(r.date, r.ticker) for r in rows] == [
        ("2024-10-01", "A"), ("2024-10-01", "B"), ("2024-10-02", "B")]


def test_rollups_from_day_state_equal_direct_rollups(spark):
    core = _core(spark, [("2024-01-31 09:05:00", "A", 3, 1.25), ("2024-02-01 10:05:00", "A", 4, 2.5),
                         ("2024-04-01 10:05:00", "A", 5, 7.0)],
                 [("2024-01-31 09:00:00", 10.0), ("2024-02-01 10:00:00", 11.0),
                  ("2024-04-01 10:00:00", 12.0)])
    comp = companies(spark, [("A", "a")])
    chained = gold.rollups(core, comp)
    for grain in gold.GOLD_GRAINS:
        assert chained[grain].collect() == gold.rollup(core, comp, grain).collect()


def test_stamp_helper(spark):
    assert ts("2024-01-01 00:00:00") == datetime(2024, 1, 1)


def test_ticker_with_two_company_rows_gets_both_names_with_full_volume(spark):
    core = _core(spark, [("2024-10-01 09:05:00", "ACME", 4, 1.0),
                         ("2024-10-01 10:05:00", "ACME", 6, 3.0)],
                 [("2024-10-01 09:00:00", 10.0), ("2024-10-01 10:00:00", 20.0)])
    comp = companies(spark, [("ACME", "Acme"), ("ACME", "Acme Corp")])
    rows = sorted(gold.rollup(core, comp, "day").collect(), key=lambda r: r.company_name)
    assert [(r.company_name, r.volume, r.avg_price, r.market_index) for r in rows] == [
        ("Acme", 10, 2.0, 15.0), ("Acme Corp", 10, 2.0, 15.0)]
    assert silver.report(core, comp).count() == 4


def test_hour_with_only_null_prices_has_null_price(spark):
    h = one(hourly_vwap(trades(spark, [("2024-10-01 09:05:00", "ACME", 1, None)])))
    assert h.volume == 1 and h.avg_price is None
