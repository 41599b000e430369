"""The reference-shaped facade gives the same reports as the plans."""

from pyspark.sql import functions as F

from tickfold.api import TradeProcessor, core_from_report
from tickfold.plans import gold, silver
from tickfold.session import local_path, scratch_path
from tickfold.sources import adapters

SF = "/root/testdata/sf0.001"


def test_facade_chain_matches_plans(spark):
    inp = adapters.inputs(spark, SF, "lineitem")
    p = TradeProcessor(spark)
    hourly = p.process_hourly_data(inp.trades, inp.companies, inp.index)
    core = silver.core(inp.trades, inp.index)
    for grain, method in (("day", p.process_daily_data), ("month", p.process_monthly_data),
                          ("quarter", p.process_quarterly_data)):
        assert method(hourly).collect() == gold.rollup(core, inp.companies, grain).collect()


def test_report_reads_back(spark):
    inp = adapters.inputs(spark, SF, "events")
    core = silver.core(inp.trades, inp.index)
    report = silver.report(core, inp.companies)
    back = core_from_report(report).drop("company_name")
    price = F.round(F.col("avg_price").cast("double"), 7).alias("avg_price")
    index = F.col("market_index").cast("double").alias("market_index")
    want = core.select(F.col("ticker").cast("string").alias("ticker"), "datetime", "volume", price, index)
    back = back.select("ticker", "datetime", "volume", price, index)
    assert back.count() > 0 and back.subtract(want).count() == 0


def test_gold_from_the_report_and_from_csv_agree_with_plans(spark):
    """Wide double index, repeated company rows, a report read back from CSV."""
    from tickfold.sinks.csv import read_csv, report_schema, write_csv

    inp = adapters.inputs(spark, SF, "events")
    index = inp.index.withColumn("index_value", F.col("index_value").cast("double") / 7)
    twice = inp.companies.union(inp.companies)
    p = TradeProcessor(spark)
    hourly = p.process_hourly_data(inp.trades, twice, index)
    want = gold.rollup(silver.core(inp.trades, index), twice, "day").collect()
    assert p.process_daily_data(hourly).collect() == want
    back = read_csv(spark, write_csv(hourly, scratch_path(spark, "hourly")), report_schema("datetime"))
    got = p.process_daily_data(back).collect()
    assert [(r.date, r.ticker, r.volume) for r in got] == [(r.date, r.ticker, r.volume) for r in want]
    assert max(abs(a.market_index - b.market_index) for a, b in zip(got, want, strict=True)) < 0.011
    assert max(abs(a.avg_price - b.avg_price) for a, b in zip(got, want, strict=True)) < 0.011


def test_callers_session_keeps_its_settings_and_results_dont_depend_on_them(spark):
    inp = adapters.inputs(spark, SF, "events")
    want = gold.rollup(silver.core(inp.trades, inp.index), inp.companies, "day").collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        p = TradeProcessor(spark)
        hourly = p.process_hourly_data(inp.trades, inp.companies, inp.index)
        assert p.process_daily_data(hourly).collect() == want
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_aggregate_hourly_and_save(spark):
    inp = adapters.inputs(spark, SF, "events")
    p = TradeProcessor(spark)
    h = p.aggregate_hourly_transactions(inp.trades)
    assert h.columns == ["datetime", "ticker", "volume", "avg_stock_price"]
    out = scratch_path(spark, "api")
    hourly = p.process_hourly_data(inp.trades, inp.companies, inp.index, round_decimals=2,
                                   output_path=out)
    assert p.preview(hourly).count() == 5
    import os
    assert "hourly_stock_data.csv" in os.listdir(local_path(out))


def test_ingest_and_run_from_config(spark, monkeypatch):
    """The config-driven path; only the JDBC read is stubbed (no database here)."""
    import tickfold.api as api
    from tickfold.sinks.csv import read_csv, report_schema
    from tickfold.sources.documents import write_documents

    docs = adapters.order_documents(spark, SF).select("timestamp", "transactions")
    path = write_documents(docs, scratch_path(spark, "api-docs"))
    seen = {}

    def fake_tables(spark_, url, user, password, company_table, index_table, driver=None, **split):
        seen.update(url=url, company_table=company_table, index_table=index_table, **split)
        return (adapters.supplier_companies(spark, SF, "string"), adapters.orders_index(spark, SF))

    monkeypatch.setattr(api, "read_tables", fake_tables)
    config = {"mysql_url": "jdbc:mysql://db:3306/market", "mysql_user": "u",
              "mysql_password": "p", "company_info_table": "company_info",
              "market_index_table": "market_index", "documents_path": path,
              "index_partition_column": "timestamp", "index_partition_lower": "2024-01-01 00:00:00",
              "index_partition_upper": "2025-01-01 00:00:00", "index_partition_count": "4",
              "output_path": scratch_path(spark, "api-run")}
    p = TradeProcessor(spark)
    companies, index, trades = p.ingest_data(config)
    assert seen["company_table"] == "company_info" and trades.count() == 6000
    assert (seen["partition_column"], seen["num_partitions"]) == ("timestamp", 4)
    out = p.run(config)
    quality = spark.read.json(f"{config['output_path']}/_quality").first()
    assert (quality.trades, quality.null_stamps, quality.null_shares) == (6000, 0, 0)
    quarterly = read_csv(spark, out["quarter"], report_schema("quarter"))
    want = gold.rollup(silver.core(trades, index), companies, "quarter")
    assert quarterly.exceptAll(want).count() == 0 and want.exceptAll(quarterly).count() == 0


def test_config_substitution(tmp_path):
    from tickfold.__main__ import load_config, substitute
    env = {"HOST": "db", "PORT": "3306"}
    assert substitute("jdbc:mysql://${HOST}:${PORT}/m", env) == "jdbc:mysql://db:3306/m"
    assert substitute("${MISSING}", env) == "${MISSING}"
    assert substitute(5, env) == 5
    cfg = tmp_path / "config.yaml"
    cfg.write_text("mysql_url: jdbc:mysql://${HOST}/m\noutput_path: ${OUT}\n")
    assert load_config(str(cfg), env) == {"mysql_url": "jdbc:mysql://db/m",
                                          "output_path": "${OUT}"}
