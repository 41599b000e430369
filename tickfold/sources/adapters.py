"""The driver's parquet tables as the pipeline's three inputs.

Three mappings (trades, companies, index):

* ``events``   - trades from the ``events`` stream (stamp ``ts``, instrument
  ``user_id``, shares ``props.k``, price ``value``); companies from
  ``customer``; index = highest ``value`` of the ``error`` events of each hour.
* ``lineitem`` - trades from ``lineitem`` (stamp ``l_shipdate``, instrument
  ``l_suppkey``, shares ``l_quantity``, price ``l_extendedprice``); companies
  from ``supplier``; index = highest ``o_totalprice`` of each order date.
* ``documents`` - nested documents built from ``orders`` and ``lineitem``:
  the document stamp is ``o_orderdate`` and its array holds that order's lines
  as trades; orders without lines become documents with an empty array.

All reads are column-pruned parquet scans; filters reach the scan.  The
instrument keeps its numeric key (``user_id`` / ``l_suppkey``) as ``ticker``
through aggregation and joins - a bigint hashes and shuffles cheaper than its
text - and reports print it as text.  Documents carry text tickers, as a
document store would.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold.functions.time import bucket

PRICE = T.DecimalType(18, 2)
INDEX = T.DecimalType(10, 2)
# Fixed value: at most this many trades per built document, so no document
# (and no group building it) grows with a hot order.
DOCUMENT_CHUNK = 64
# Fixed value: lines that one task groups into documents, about; more lines are
# more tasks, not larger ones.
LINES_PER_TASK = 100_000
ADAPTERS = ("events", "lineitem", "documents")


@dataclass(frozen=True)
class Inputs:
    """Bronze inputs of one pipeline run.  Exactly one of ``trades`` and
    ``documents`` is set."""

    companies: DataFrame
    index: DataFrame
    trades: DataFrame | None = None
    documents: DataFrame | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- events ------------------------------------------------------------------

def events_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("ticker"),
        F.col("event_type").alias("action"),
        F.get_json_object("props", "$.k").try_cast("int").alias("shares"),
        F.col("value").cast(PRICE).alias("price"),
    )


def customer_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("ticker"), F.col("c_name").alias("company_name"))


def events_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return e.groupBy(bucket("ts", "hour").alias("timestamp")).agg(
        F.max("value").cast(INDEX).alias("index_value"))


# -- lineitem ----------------------------------------------------------------

def _line_trade_columns(ticker_type: str = "bigint"):
    return [
        F.col("l_suppkey").cast(ticker_type).alias("ticker"),
        F.col("l_returnflag").alias("action"),
        F.col("l_quantity").cast("int").alias("shares"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
    ]


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_shipdate").alias("timestamp"), *_line_trade_columns())


def supplier_companies(spark: SparkSession, sf_dir: str, ticker_type: str = "bigint") -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast(ticker_type).alias("ticker"),
                    F.col("s_name").alias("company_name"))


def orders_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderdate").alias("timestamp")).agg(
        F.max("o_totalprice").cast(INDEX).alias("index_value"))


# -- documents ---------------------------------------------------------------

def order_documents(spark: SparkSession, sf_dir: str, element_stamps: bool = False) -> DataFrame:
    """``(doc_id, timestamp, transactions)`` built from orders and lineitem.

    A document holds an order's lines numbered 1 to 64, the next one 65 to 128,
    and so on: whichever splits or tasks read them, the same documents come
    out, and none (and no group building one) grows with a hot order.  Lines
    are dealt to as many tasks as their number asks for (a count that reads only
    the file's footers) and grouped per (order, chunk) there, *before* any join:
    no scan task holds the lines of its split.  The chunks then meet their
    order's date in an inner join, which nothing downstream needs clustered by
    order, so AQE is free to split a hot order's partition.  Orders without any
    line are added by an anti join against the *distinct* line keys, which a
    partial aggregate shrinks before the shuffle.
    ``element_stamps=True`` also stores each line's ``l_shipdate`` as the
    element's own ``timestamp``.
    """
    fields = _line_trade_columns("string")
    if element_stamps:
        fields = [F.col("l_shipdate").alias("timestamp"), *fields]
    lineitem = table(spark, sf_dir, "lineitem")
    # No fewer than the session's: a hot order's partition is split by the tasks that made it.
    tasks = max(-(-lineitem.count() // LINES_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = (
        lineitem.select("l_orderkey", F.struct(*fields).alias("trade"),
                        F.expr(f"(l_linenumber - 1) div {DOCUMENT_CHUNK}").alias("chunk"))
        .repartition(tasks, "l_orderkey", "chunk")
        .groupBy("l_orderkey", "chunk")
        .agg(F.collect_list("trade").alias("transactions"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    filled = chunks.join(orders, chunks["l_orderkey"] == orders["o_orderkey"]).select(
        F.concat_ws("-", "o_orderkey", "chunk").alias("doc_id"),
        F.col("o_orderdate").alias("timestamp"), "transactions")
    line_keys = lineitem.select("l_orderkey").distinct()
    empty_type = filled.schema["transactions"].dataType
    empty = (
        orders.join(line_keys, orders["o_orderkey"] == line_keys["l_orderkey"], "left_anti")
        .select(F.col("o_orderkey").cast("string").alias("doc_id"),
                F.col("o_orderdate").alias("timestamp"),
                F.array().cast(empty_type).alias("transactions"))
    )
    return filled.unionByName(empty)


def inputs(spark: SparkSession, sf_dir: str, adapter: str) -> Inputs:
    """Bronze inputs for ``adapter`` in :data:`ADAPTERS`."""
    if adapter == "events":
        return Inputs(companies=customer_companies(spark, sf_dir),
                      index=events_index(spark, sf_dir),
                      trades=events_trades(spark, sf_dir))
    if adapter == "lineitem":
        return Inputs(companies=supplier_companies(spark, sf_dir),
                      index=orders_index(spark, sf_dir),
                      trades=lineitem_trades(spark, sf_dir))
    if adapter == "documents":
        return Inputs(companies=supplier_companies(spark, sf_dir, "string"),
                      index=orders_index(spark, sf_dir),
                      documents=order_documents(spark, sf_dir))
    raise ValueError(f"adapter must be one of {ADAPTERS}, got {adapter!r}")
