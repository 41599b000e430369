"""CSV outputs (K1-K4).

Writes are parallel: every task writes its own part file into the output
folder, and the committer publishes the folder atomically.  AQE coalesces the
last shuffle to its advisory partition size, so a small (gold) report comes
out as one part file and a large one as several, each in sort order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.sinks.published import folders, remove_folder, resolve

# Fixed value: the index is printed with two decimals (``2277.80``), as a
# decimal column is; prices print as doubles (``149.7``).
INDEX_TEXT_TYPE = T.DecimalType(38, 2)

# Output folder name of each report.
OUTPUT_NAMES = {
    "hour": "hourly_stock_data",
    "day": "daily_stock_data",
    "month": "monthly_stock_data",
    "quarter": "quarterly_stock_data",
}


def as_text_columns(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """``df``, with ``market_index`` printed with two decimals if the report was
    rounded to two; any other report is written as it is."""
    if decimals != INDEX_TEXT_TYPE.scale or "market_index" not in df.columns:
        return df
    return df.withColumn("market_index", F.col("market_index").cast(INDEX_TEXT_TYPE))


def write_csv(df: DataFrame, path: str, decimals: int | None = None, mode: str = "overwrite",
              header: bool = True) -> str:
    """CSV with a header line; an empty frame still writes the header.
    ``decimals`` says what the report was rounded to (None: not at all)."""
    out = as_text_columns(df, decimals)
    out.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def with_date_parts(report: DataFrame, label_col: str) -> DataFrame:
    """Add ``year`` and (when the label has one) ``month`` from a text label
    like ``2024-10-01 09:00:00``, ``2024-10-01``, ``2024-10`` or ``2024 Q4``."""
    label = F.col(label_col)
    out = report.withColumn("year", F.substring(label, 1, 4).try_cast("int"))
    if label_col != "quarter":
        out = out.withColumn("month", F.substring(label, 6, 2).try_cast("int"))
    return out


def write_partitioned_csv(report: DataFrame, path: str, label_col: str,
                          mode: str = "overwrite", cluster: bool = True,
                          decimals: int | None = None, replace: bool = False) -> str:
    """CSV partitioned by ``year`` (and ``month``) folders, so readers that
    filter on them list only matching folders.

    ``replace=True`` replaces only the folders that the report has rows for
    (dynamic partition overwrite); the files of all others stay as they are.

    ``cluster=True`` range-partitions the rows by (year, month, ticker) first,
    so each task holds one or two months and writes one or two files instead
    of one per month it happens to see, while a month holding a third of the
    rows is still cut into many tasks by ticker.  A report already sorted by
    period (range-partitioned the same way) passes ``cluster=False``.
    """
    df = with_date_parts(as_text_columns(report, decimals), label_col)
    parts = ["year"] + (["month"] if "month" in df.columns else [])
    if cluster:
        df = df.repartitionByRange(*parts, "ticker")
    df.write.mode("overwrite" if replace else mode).option("header", "true").option(
        "partitionOverwriteMode", "dynamic" if replace else "static").partitionBy(*parts).csv(path)
    return path


def drop_periods(report: DataFrame, path: str, label_col: str, periods: list[tuple[int, ...]]) -> None:
    """Remove the folders of those ``periods`` ((year,) or (year, month)) that the
    report has no rows for, which a dynamic overwrite leaves as they were."""
    names = ("year", "month")
    parts = with_date_parts(report, label_col)
    names = tuple(n for n in names if n in parts.columns)
    left = {tuple(r) for r in parts.select(*names).distinct().collect()}  # a calendar's worth
    for period in sorted({p[:len(names)] for p in periods} - left):
        *above, last = [f"{n}={v}" for n, v in zip(names, period, strict=True)]
        folder = "/".join([path, *above])
        if last in folders(report.sparkSession, folder):
            remove_folder(report.sparkSession, f"{folder}/{last}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a written report back (header line, explicit schema when given).
    A report of a published set is read where the last set has it."""
    path = resolve(spark, path)
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def report_schema(label_col: str, partitioned: bool = False) -> T.StructType:
    """Schema of a written report, for reading it back without inference."""
    fields = [
        T.StructField(label_col, T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("market_index", T.DoubleType()),
    ]
    if partitioned:
        fields.append(T.StructField("year", T.IntegerType()))
        if label_col != "quarter":
            fields.append(T.StructField("month", T.IntegerType()))
    return T.StructType(fields)
