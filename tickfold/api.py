"""Drop-in facade with the reference's method names and call chain.

A caller that today does::

    spark = create_spark_session(jdbc_jar, document_uri)
    p = TradeProcessor(spark)
    companies, index, trades = p.ingest_data(config)
    hourly = p.process_hourly_data(trades, companies, index)
    p.process_daily_data(hourly, out); p.process_monthly_data(hourly, out); ...

keeps doing so.  Differences, on purpose:

* nothing is printed; ``preview`` returns the first rows as a DataFrame;
* every step saves only when given an ``output_path`` (the reference's gold
  steps always save; its own run always passes a path, so runs are alike);
* ``save_to_csv`` writes a folder named ``filename`` through Spark's committer
  (works on shared storage, no driver-side file moves);
* gold steps roll up the timestamps and exact sums behind the hourly report
  they are given; a report from elsewhere (read back from CSV) is parsed;
* the whole-run path :meth:`run` computes silver once (see ``plans.medallion``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.functions.numeric import REPORT_DECIMALS
from tickfold.operators.explode import explode_transactions
from tickfold.operators.hourly import hourly_vwap
from tickfold.operators.preview import preview as _preview
from tickfold.operators.rollup import finish, period_state
from tickfold.plans import medallion, silver
from tickfold.session import build_session, settings
from tickfold.sinks.csv import OUTPUT_NAMES, write_csv
from tickfold.sources.adapters import Inputs
from tickfold.sources.documents import document_store_options, read_documents
from tickfold.sources.jdbc import MYSQL_DRIVER, connector_conf, read_tables

def create_spark_session(jdbc_jar: str | None = None, document_uri: str | None = None,
                         packages: str | None = None,
                         master: str | None = None) -> SparkSession:
    """Session with the JDBC driver jar and the document-store connector (M9).
    ``packages`` names the connector build for the cluster's Spark/Scala
    version (a Scala 2.12 build does not load on Spark 4)."""
    return build_session(master=master, app_name="tickfold",
                         extra=connector_conf(jdbc_jar, packages, document_uri))


def core_from_report(hourly_report: DataFrame) -> DataFrame:
    """Rows of an hourly report (text ``datetime``) back to silver core rows;
    numbers keep the types the report has."""
    return hourly_report.select(
        F.try_to_timestamp("datetime", F.lit("yyyy-MM-dd HH:mm:ss"))
        .cast(T.TimestampNTZType()).alias("datetime"),
        "ticker", "company_name", "volume", "avg_price", "market_index")


class TradeProcessor:
    """The reference's processor API (M1-M8) over this package's plans."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    # M2 ---------------------------------------------------------------------
    def ingest_data(self, config: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(company_info, market_index, transactions).

        Relational tables over JDBC (``mysql_url``, ``mysql_user``,
        ``mysql_password``, ``company_info_table``, ``market_index_table``;
        optional ``jdbc_driver``).  Documents from the document store
        (``mongodb_uri``, ``mongo_db``, ``mongo_collection``) or, when
        ``documents_path`` is given, from files (``documents_format``, default
        json; ``documents_multiline`` or, by many tasks, ``documents_json_array``
        for files that hold one JSON array; ``documents_variant`` for lines whose
        types need not be inferred).
        ``index_partition_column``, ``_lower``, ``_upper`` and ``_count``
        (with that prefix) split the index scan; without the bounds they are
        asked of the database; ``_equal`` makes parts of equal row counts.
        """
        split = {}
        if config.get("index_partition_column"):
            split = {"partition_column": config["index_partition_column"],
                     "lower_bound": config.get("index_partition_lower"),
                     "upper_bound": config.get("index_partition_upper"),
                     "num_partitions": int(config.get("index_partition_count", 8)),
                     "equal_parts": str(config.get("index_partition_equal", "")).lower() == "true"}
        companies, index = read_tables(
            self.spark, config["mysql_url"], config.get("mysql_user"), config.get("mysql_password"),
            config.get("company_info_table", "company_info"),
            config.get("market_index_table", "market_index"),
            driver=config.get("jdbc_driver", MYSQL_DRIVER), **split)
        return companies, index, explode_transactions(self.documents(config))

    def documents(self, config: dict[str, str]) -> DataFrame:
        """The documents that :meth:`ingest_data` explodes, as their source has them."""
        if config.get("documents_path"):
            return read_documents(self.spark, config["documents_path"],
                                  fmt=config.get("documents_format", "json"),
                                  **{to: str(config.get(key, "")).lower() == "true" for key, to in (
                                      ("documents_multiline", "multiline"), ("documents_json_array", "json_array"),
                                      ("documents_variant", "variant"))})
        return read_documents(
            self.spark, fmt="mongodb",
            options=document_store_options(config["mongodb_uri"], config["mongo_db"],
                                           config["mongo_collection"]))

    # M3 ---------------------------------------------------------------------
    def aggregate_hourly_transactions(self, transactions: DataFrame) -> DataFrame:
        """(datetime, ticker, volume, avg_stock_price) per traded hour."""
        with settings(self.spark):
            h = hourly_vwap(transactions)
            return h.select("datetime", "ticker", "volume",
                            F.col("avg_price").cast(T.DoubleType()).alias("avg_stock_price"))

    # M4 ---------------------------------------------------------------------
    def process_hourly_data(self, transactions: DataFrame, company_info: DataFrame,
                            market_index: DataFrame, round_decimals: int | None = None,
                            output_path: str | None = None) -> DataFrame:
        with settings(self.spark):
            core = silver.core(transactions, market_index)
            report = silver.report(core, company_info, round_decimals)
            # The rows behind the report, for the gold steps.
            report.hourly_rows = silver.rounded(core, company_info, round_decimals)
            if output_path:
                self.save_to_csv(report, output_path, f"{OUTPUT_NAMES['hour']}.csv", round_decimals)
        return report

    # M5-M7 ------------------------------------------------------------------
    def _gold(self, hourly_data: DataFrame, grain: str, output_path: str | None) -> DataFrame:
        with settings(self.spark):
            rows = vars(hourly_data).get("hourly_rows")
            rows = core_from_report(hourly_data) if rows is None else rows
            report = finish(period_state(rows, grain, keys=("ticker", "company_name")), None, grain)
            if output_path:
                self.save_to_csv(report, output_path, f"{OUTPUT_NAMES[grain]}.csv", REPORT_DECIMALS)
        return report

    def process_daily_data(self, hourly_data: DataFrame, output_path: str | None = None) -> DataFrame:
        return self._gold(hourly_data, "day", output_path)

    def process_monthly_data(self, hourly_data: DataFrame, output_path: str | None = None) -> DataFrame:
        return self._gold(hourly_data, "month", output_path)

    def process_quarterly_data(self, hourly_data: DataFrame,
                               output_path: str | None = None) -> DataFrame:
        return self._gold(hourly_data, "quarter", output_path)

    # M8, O3 -----------------------------------------------------------------
    def save_to_csv(self, df: DataFrame, output_path: str, filename: str,
                    decimals: int | None = None) -> str:
        return write_csv(df, f"{output_path.rstrip('/')}/{filename}", decimals)

    @staticmethod
    def preview(report: DataFrame, n: int = 5) -> DataFrame:
        return _preview(report, n, (report.columns[0], "ticker"))

    # M10 --------------------------------------------------------------------
    def run(self, config: dict[str, str]) -> dict[str, str]:
        """The whole run: ingest, silver once, gold, CSV outputs under
        ``config["output_path"]``."""
        companies, index, _ = self.ingest_data(config)
        return medallion.run(
            self.spark, Inputs(companies=companies, index=index, documents=self.documents(config)),
            config["output_path"])


__all__ = ["TradeProcessor", "create_spark_session", "core_from_report"]
