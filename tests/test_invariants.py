"""Invariants over the test tables (sf0.001)."""

import re

import pytest
from pyspark.sql import functions as F

from tickfold.operators.hourly import hourly_vwap
from tickfold.plans import gold, silver
from tickfold.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["events", "lineitem", "documents"])
def run(request, spark):
    inp = adapters.inputs(spark, SF, request.param)
    core = silver.core(silver.trades_of(inp), inp.index).cache()
    yield inp, core
    core.unpersist()


def _total(df):
    return df.agg(F.sum("volume")).first()[0]


def test_volume_adds_up_across_grains(run):
    inp, core = run
    hourly = silver.report(core, inp.companies, sort=False)
    reports = gold.rollups(core, inp.companies, sort=False)
    totals = {g: _total(r) for g, r in reports.items()}
    assert len(set(totals.values())) == 1
    assert totals["day"] == _total(hourly)


def test_labels(run):
    inp, core = run
    reports = gold.rollups(core, inp.companies, sort=False)
    patterns = {"day": r"\d{4}-\d{2}-\d{2}", "month": r"\d{4}-\d{2}", "quarter": r"\d{4} Q[1-4]"}
    for grain, pat in patterns.items():
        for row in reports[grain].select(reports[grain].columns[0]).distinct().collect():
            assert re.fullmatch(pat, row[0])


def test_gold_index_within_hourly_range(run):
    inp, core = run
    lo, hi = core.agg(F.min("market_index"), F.max("market_index")).first()
    q = gold.rollup(core, inp.companies, "quarter", sort=False)
    qlo, qhi = q.agg(F.min("market_index"), F.max("market_index")).first()
    assert float(lo) - 0.005 <= qlo <= qhi <= float(hi) + 0.005


def test_every_gold_row_has_silver_rows(run):
    inp, core = run
    hourly = silver.report(core, inp.companies, sort=False).select(
        F.substring("datetime", 1, 10).alias("date"), "ticker").distinct()
    daily = gold.rollup(core, inp.companies, "day", sort=False).select("date", "ticker")
    assert daily.subtract(hourly).count() == 0


def test_explode_keeps_every_line(spark):
    docs = adapters.order_documents(spark, SF)
    lines = adapters.table(spark, SF, "lineitem").count()
    assert silver.trades_of(adapters.Inputs(None, None, documents=docs)).count() == lines
    assert docs.agg(F.max(F.size("transactions"))).first()[0] <= adapters.DOCUMENT_CHUNK


def test_hourly_buckets_on_the_hour(spark):
    h = hourly_vwap(adapters.events_trades(spark, SF))
    assert h.where((F.minute("datetime") != 0) | (F.second("datetime") != 0)).count() == 0
