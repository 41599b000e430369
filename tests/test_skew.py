"""A hot hour in a shuffle join: AQE splits its partition (no broadcast)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickfold import schemas
from tickfold.plans import silver

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_hour_is_split_in_the_index_join(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        base = datetime(2024, 1, 1)
        # a third of all trades in hour 0, with many tickers; the rest spread thin
        trades = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(base))
             .otherwise(F.lit(base) + F.make_interval(hours=(F.col("id") % 97 + 1).cast("int")))
             .cast("timestamp_ntz").alias("timestamp"),
            (F.col("id") % 5000).cast("string").alias("ticker"),
            F.lit("BUY").alias("action"),
            F.lit(1).alias("shares"),
            F.lit(2.5).cast("decimal(18,2)").alias("price"))
        index = spark.createDataFrame(
            [(base + timedelta(hours=h), None) for h in range(98)], schemas.MARKET_INDEX)
        core = silver.core(trades, index)
        assert core.agg(F.sum("volume")).first()[0] == 30000
        core.collect()
        plan = core._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_order_documents_stay_bounded_and_join_is_split(spark):
    from tickfold.session import scratch_path
    from tickfold.sources import adapters

    root = scratch_path(spark, "hot-order")
    n = 30000
    # a third of all lines belong to order 0
    spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1)
         .cast("bigint").alias("l_orderkey"),
        F.expr("CAST(1 + IF(id % 3 = 0, id div 3, id div 2000) AS INT)").alias("l_linenumber"),
        # varied values, so shuffle bytes follow row counts (identical rows
        # compress to nearly nothing)
        (F.col("id") * 7919 % 100003).alias("l_suppkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        ((F.col("id") * 104729 % 10000000) / 100).alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag"),
        F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz").alias("l_shipdate"),
    ).repartition(8).write.parquet(f"{root}/lineitem.parquet")
    spark.range(2001).select(
        F.col("id").alias("o_orderkey"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("o_orderdate"),
    ).write.parquet(f"{root}/orders.parquet")
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        docs = adapters.order_documents(spark, root)
        sizes = docs.select(F.size("transactions").alias("n"))
        assert sizes.agg(F.max("n")).first()[0] <= adapters.DOCUMENT_CHUNK
        assert sizes.agg(F.sum("n")).first()[0] == n
        docs.collect()
        plan = docs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
