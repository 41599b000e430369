"""Plan shape: pruning and pushdown reach the scan, joins broadcast only
measured or checked sides, rollups do not sort."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickfold.operators.joins import bounded_size, join_company, join_dimension
from tickfold.operators.rollup import coarsen, finish, period_state, period_state_by_quarter
from tickfold.plans import gold, silver
from tickfold.plans.by_ticker import TickerTables
from tickfold.sources import adapters

SF = "/root/testdata/sf0.001"


def plan_text(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["q_gold_daily_lineitem"](spark, SF)
    text = plan_text(df)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double," \
           "l_shipdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_index_filter_is_pushed_to_scan(spark):
    text = plan_text(adapters.events_index(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in text


def test_small_sides_end_up_broadcast(spark):
    df = entry.queries()["q_gold_quarterly_lineitem"](spark, SF)
    final = plan_text(df, executed=True).split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in final


def test_no_static_broadcast_without_check(spark):
    inp = adapters.inputs(spark, SF, "lineitem")
    core = silver.core(inp.trades, inp.index)
    assert "BroadcastExchange" not in plan_text(core)   # before execution: nothing measured
    never = join_company(core, inp.companies, broadcast="never")
    assert "SortMergeJoin" in never._jdf.queryExecution().executedPlan().toString()
    checked = join_company(core, inp.companies, broadcast="check")
    assert "BroadcastExchange" in checked._jdf.queryExecution().executedPlan().toString()


def test_bounded_size(spark):
    s = adapters.supplier_companies(spark, SF)
    rows, size = bounded_size(s)
    assert rows == s.count() and size > 0
    assert bounded_size(s, max_rows=rows - 1) is None
    assert bounded_size(s, max_bytes=1) is None
    joined = join_dimension(s, s.select("ticker"), "ticker", max_rows=1)
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_unsorted_rollup_has_no_range_shuffle(spark):
    inp = adapters.inputs(spark, SF, "events")
    core = silver.core(inp.trades, inp.index)
    assert "rangepartitioning" not in plan_text(gold.rollup(core, inp.companies, "day", sort=False))
    assert "rangepartitioning" in plan_text(gold.rollup(core, inp.companies, "day"))
    assert "rangepartitioning" not in plan_text(core)


def test_tables_by_ticker_need_no_exchange(spark, tmp_path):
    inp = adapters.inputs(spark, SF, "lineitem")
    with TickerTables(spark, str(tmp_path)) as tables:
        core = tables.write(silver.core(inp.trades, inp.index), "core", "datetime")
        day = period_state(core, "day")
        assert "Exchange" not in plan_text(day) and "HashAggregate" in plan_text(day)
        state = tables.write(day, "day", "period", placed=True)
        files = [x for x in (tmp_path / "day").iterdir() if x.suffix == ".parquet"]
        assert 0 < len(files) <= tables.buckets  # a file a bucket
        months = coarsen(state, "month")
        assert "Exchange" not in plan_text(months)
        assert plan_text(join_company(core, inp.companies, broadcast="never")).count("Exchange hashpartitioning(ticker") == 1
        want = gold.rollup(silver.core(inp.trades, inp.index), inp.companies, "month").collect()
        assert finish(months, inp.companies, "month").collect() == want and want
        none = tables.write(silver.core(inp.trades, inp.index).limit(0), "none", "datetime")
        assert none.count() == 0 and period_state(none, "day").collect() == []
        names = list(tables.names)
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_sorted_reports_move_no_labels(spark):
    inp = adapters.inputs(spark, SF, "lineitem")
    core = silver.core(inp.trades, inp.index)
    for report in (silver.report(core, inp.companies, 2), gold.rollup(core, inp.companies, "day")):
        text = plan_text(report)
        assert "date_format" in text.split("rangepartitioning")[0]
        assert "date_format" not in text.split("rangepartitioning")[1]


def test_a_tickers_quarter_is_in_one_task_and_its_states_add_up(spark):
    inp = adapters.inputs(spark, SF, "lineitem")
    core = silver.core(inp.trades, inp.index)
    for grain in gold.GOLD_GRAINS:
        laid, plain = period_state_by_quarter(core, grain), period_state(core, grain)
        assert laid.schema == plain.schema and laid.count() == plain.count() > 0
        assert laid.exceptAll(plain).isEmpty()
    tasks = period_state_by_quarter(core, "day").select(
        "ticker", F.date_trunc("quarter", "period").alias("quarter"), F.spark_partition_id().alias("task"))
    per = tasks.groupBy("ticker", "quarter").agg(F.countDistinct("task").alias("n"))
    assert per.where("n > 1").isEmpty()


def test_lines_are_dealt_before_they_are_grouped(spark, monkeypatch):
    lines = adapters.table(spark, SF, "lineitem").count()
    monkeypatch.setattr(adapters, "LINES_PER_TASK", lines // 20)
    text = plan_text(adapters.order_documents(spark, SF))
    dealt = re.findall(r"Exchange hashpartitioning\(l_orderkey#\w+, chunk#\w+, (\d+)\), (\w+)", text)
    assert dealt and set(dealt) <= {("20", "REPARTITION_BY_NUM"), ("21", "REPARTITION_BY_NUM")}


def test_hourly_aggregate_is_two_phase(spark):
    text = plan_text(silver.core(adapters.events_trades(spark, SF), adapters.events_index(spark, SF)))
    assert "partial_sum(shares" in text


def test_bad_join_mode(spark):
    s = adapters.supplier_companies(spark, SF)
    with pytest.raises(ValueError):
        join_company(s, s, broadcast="sometimes")
    with pytest.raises(ValueError):
        join_dimension(s, s, "ticker", how="right")
