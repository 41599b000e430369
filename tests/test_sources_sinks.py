"""Documents, explode, JDBC option building, CSV outputs."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import companies, index, trades
from tickfold import schemas
from tickfold.operators.explode import explode_transactions
from tickfold.plans import gold, medallion, silver
from tickfold.session import local_path, scratch_path
from tickfold.sinks.csv import read_csv, report_schema, write_csv, write_partitioned_csv
from tickfold.sources import adapters
from tickfold.sources.documents import read_documents, write_documents
from tickfold.sources.jdbc import bounds_query, connector_conf, jdbc_options

DOCS = [
    '{"timestamp": "2024-10-01T09:05:00", "transactions": ['
    '{"ticker": "A", "action": "BUY", "shares": 10, "price": 1.5},'
    '{"ticker": "B", "action": "SELL", "shares": 30, "price": 2.5}]}',
    '{"timestamp": "2024-10-01T10:05:00", "transactions": []}',
    '{"timestamp": "2024-10-01T11:05:00", "transactions": null}',
    '{"timestamp": "2024-10-01T12:05:00"}',
]


def _write_text(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_json_documents_explode_and_empty_arrays_vanish(spark):
    docs = read_documents(spark, _write_text(spark, DOCS, "docs"), fmt="json")
    rows = explode_transactions(docs).orderBy("ticker").collect()
    assert [(r.ticker, r.action, r.shares, float(r.price)) for r in rows] == [
        ("A", "BUY", 10, 1.5), ("B", "SELL", 30, 2.5)]
    assert all(r.timestamp == "2024-10-01T09:05:00" for r in rows)  # text, as the source has it


def test_float_price_documents(spark):
    docs = read_documents(spark, _write_text(spark, DOCS[:1], "docs-f"), fmt="json",
                          schema=schemas.DOCUMENT_OPEN)
    h = silver.core(explode_transactions(docs).where(F.col("ticker") == "A"),
                    index(spark, [("2024-10-01 09:00:00", 1.0)])).first()
    assert float(h.avg_price) == 1.5


def test_element_timestamp_variant(spark):
    lines = ['{"timestamp": "2024-10-01T09:05:00", "transactions": ['
             '{"timestamp": "2024-10-02T10:00:00", "ticker": "A", "action": "BUY",'
             ' "shares": 1, "price": 1.0}]}']
    schema = "timestamp timestamp_ntz, transactions array<struct<timestamp: timestamp_ntz," \
             " ticker: string, action: string, shares: int, price: decimal(18,2)>>"
    docs = spark.read.schema(schema).json(_write_text(spark, lines, "docs-e"))
    row = explode_transactions(docs, timestamp_from="element").first()
    assert str(row.timestamp) == "2024-10-02 10:00:00"
    with pytest.raises(ValueError):
        explode_transactions(docs, timestamp_from="nowhere")


def test_documents_roundtrip_parquet(spark):
    docs = read_documents(spark, _write_text(spark, DOCS, "docs-p"), fmt="json")
    path = write_documents(docs, scratch_path(spark, "docs-parquet"), fmt="parquet")
    back = read_documents(spark, path, fmt="parquet")
    assert explode_transactions(back).count() == 2


def test_jdbc_options():
    opts = jdbc_options("jdbc:mysql://h:3306/db", "market_index", user="u", password="p",
                        partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4,
                        fetch_size=1000)
    assert opts == {"url": "jdbc:mysql://h:3306/db", "dbtable": "market_index",
                    "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "p",
                    "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
                    "numPartitions": "4", "fetchsize": "1000", "preferTimestampNTZ": "true"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
    assert bounds_query("market_index", "timestamp") == (
        "(SELECT MIN(timestamp) AS lo, MAX(timestamp) AS hi FROM market_index) bounds")
    assert connector_conf("/x.jar", "g:a:1", "mongodb://h/") == {
        "spark.jars": "/x.jar", "spark.jars.packages": "g:a:1",
        "spark.mongodb.read.connection.uri": "mongodb://h/"}


def _daily(spark):
    core = silver.core(trades(spark, [("2024-10-01 09:05:00", "A", 1, 1.0),
                                      ("2024-11-02 09:05:00", "A", 3, 2.0)]),
                       index(spark, [("2024-10-01 09:00:00", 10.0), ("2024-11-02 09:00:00", 20.0)]))
    return gold.rollup(core, companies(spark, [("A", "Acme & Co.")]), "day")


def test_csv_single_file_with_header(spark):
    path = write_csv(_daily(spark), scratch_path(spark, "daily"), decimals=2)
    parts = [f for f in os.listdir(local_path(path)) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(local_path(path), parts[0])) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "date,ticker,company_name,avg_price,volume,market_index"
    assert lines[1] == "2024-10-01,A,Acme & Co.,1.0,1,10.00"
    assert read_csv(spark, path, report_schema("date")).count() == 2


def test_empty_csv_still_has_header(spark):
    empty = _daily(spark).where(F.lit(False))
    path = write_csv(empty, scratch_path(spark, "empty"))
    files = [f for f in os.listdir(local_path(path)) if f.startswith("part-")]
    text = "".join(open(os.path.join(local_path(path), f)).read() for f in files)
    assert text.splitlines() == ["date,ticker,company_name,avg_price,volume,market_index"]


def test_partitioned_csv(spark):
    path = write_partitioned_csv(_daily(spark), scratch_path(spark, "part"), "date")
    assert "year=2024" in os.listdir(local_path(path))
    back = read_csv(spark, path, report_schema("date", partitioned=True))
    assert back.where("month = 11").count() == 1


def test_full_run_writes_all_outputs(spark):
    sf = "/root/testdata/sf0.001"
    inp = adapters.inputs(spark, sf, "lineitem")
    out = medallion.run(spark, inp, scratch_path(spark, "run"))
    assert set(out) == {"hour", "day", "month", "quarter"}
    q = read_csv(spark, out["quarter"], report_schema("quarter")).collect()
    assert q and all(" Q" in r.quarter for r in q)


def test_full_run_partitioned_equals_direct_rollup(spark):
    inp = adapters.inputs(spark, "/root/testdata/sf0.001", "events")
    out = medallion.run(spark, inp, scratch_path(spark, "run-part"), partitioned=True)
    back = read_csv(spark, out["day"], report_schema("date", partitioned=True)).drop("year", "month")
    direct = gold.rollup(silver.core(inp.trades, inp.index), inp.companies, "day")
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0
    assert any(d.startswith("year=") for d in os.listdir(local_path(out["hour"])))


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    from tickfold.session import checkpoint_root
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


# The header lines of the reference's monthly and quarterly outputs.
REFERENCE_HEADERS = {
    "month": "month,ticker,company_name,avg_price,volume,market_index",
    "quarter": "quarter,ticker,company_name,avg_price,volume,market_index",
}


def test_report_headers_and_labels_match_reference_layout(spark):
    inp = adapters.inputs(spark, "/root/testdata/sf0.001", "lineitem")
    core = silver.core(inp.trades, inp.index)
    for grain, header in REFERENCE_HEADERS.items():
        path = write_csv(gold.rollup(core, inp.companies, grain), scratch_path(spark, grain), decimals=2)
        part = sorted(f for f in os.listdir(local_path(path)) if f.startswith("part-"))[0]
        with open(os.path.join(local_path(path), part)) as fh:
            first, second = fh.readline().strip(), fh.readline().strip()
        assert first == header
        label, *_, index = second.split(",")
        assert (len(label) == 7 and label[4] == "-") if grain == "month" else " Q" in label
        assert len(index.split(".")[1]) == 2


def test_run_removes_its_intermediates_and_marks_the_set(spark):
    from tickfold.session import checkpoint_root

    inp = adapters.inputs(spark, "/root/testdata/sf0.001", "events")
    out = scratch_path(spark, "run-marked")
    written = medallion.run(spark, inp, out, time_range=("2024-01-05", "2024-01-10"))
    left = os.listdir(os.path.join(local_path(checkpoint_root(spark)), "tickfold"))
    assert not [x for x in left if x.startswith("run-") and len(x) == len("run-") + 32]
    marks = spark.read.json(f"{out}/_complete").collect()
    assert {(m.grain, m.path) for m in marks} == set(written.items())
    days = {r.date for r in read_csv(spark, written["day"], report_schema("date")).collect()}
    assert days and min(days) >= "2024-01-05" and max(days) <= "2024-01-09"


def test_multiline_array_fractions_and_corrupt_lines(spark):
    from tickfold.sources.documents import document_quality

    text = ('[\n {"timestamp": "2024-10-01 09:06:00", "transactions": [{"ticker": "A", "action": "BUY",'
            ' "shares": 2.5, "price": 149.7049}]},\n {"timestamp": "2024-10-01T09:07:00Z", "transactions":'
            ' [{"ticker": "A", "action": "BUY", "shares": 10.0, "price": 1.2e-7}]}\n]')
    docs = read_documents(spark, _write_text(spark, [text], "docs-array"), multiline=True)
    h = silver.core(explode_transactions(docs), index(spark, [("2024-10-01 09:00:00", 1.0)])).first()
    assert h.volume == 12.5 and abs(h.avg_price - (2.5 * 149.7049 + 10 * 1.2e-7) / 12.5) < 1e-12
    lines = [DOCS[0], "no json", '{"timestamp": "never", "transactions": [{"ticker": "A"}]}']
    row = document_quality(read_documents(spark, _write_text(spark, lines, "docs-bad"))).first()
    assert (row.documents, row.corrupt, row.null_stamps, row.unparsed_stamps) == (3, 1, 1, 1)
    assert row.trades == 2 or row.trades == 3
    assert row.null_shares == 1 and row.null_prices == 1


def test_tiny_prices_keep_their_digits(spark):
    rows = spark.createDataFrame([("2024-10-01 09:00:00", "A", 3, 1.2e-7)],
                                 "timestamp string, ticker string, shares long, price double")
    for kind in ("double", "decimal(18,8)", "decimal(24,8)"):
        r = silver.core(rows.withColumn("price", F.col("price").cast(kind)),
                        index(spark, [("2024-10-01 09:00:00", 1.0)])).first()
        assert abs(float(r.avg_price) - 1.2e-7) < 1e-12, kind


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_prices_and_wide_index(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame([("2024-10-01 09:00:00", "A", 2, 1e9), ("2024-10-01 09:01:00", "A", 1, 1e9)],
                                     "timestamp string, ticker string, shares int, price double")
        exact = rows.withColumn("price", F.col("price").cast("decimal(18,2)"))
        wide = index(spark, [("2024-10-01 09:00:00", 100.005)]).withColumn(
            "index_value", F.lit(100.00504))
        for trades in (rows, exact):
            r = silver.core(trades, wide).first()
            assert float(r.avg_price) == 1e9 and float(r.market_index) == 100.00504
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_jdbc_split_on_a_stamp_reads_it_zoned():
    from tickfold.sources.jdbc import jdbc_options

    split = {"partition_column": "timestamp", "num_partitions": 4}
    stamp = jdbc_options("jdbc:x", "t", lower_bound="2024-01-01 00:00:00", upper_bound="2025-01-01", **split)
    number = jdbc_options("jdbc:x", "t", lower_bound=0, upper_bound=9, **split)
    assert "preferTimestampNTZ" not in stamp and number["preferTimestampNTZ"] == "true"
    assert stamp["numPartitions"] == "4" and stamp["lowerBound"] == "2024-01-01 00:00:00"
