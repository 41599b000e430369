"""Relational sources over JDBC (company dimension, index series) and the
connector settings a session needs for them.

A JDBC scan without partition bounds is one task on one connection.  Pass
``partition_column`` with bounds and ``num_partitions`` for a parallel scan;
``fetch_size`` sets the rows per round trip.
"""

from __future__ import annotations

import re
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the MySQL driver class the relational tables are read with.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = MYSQL_DRIVER,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
    prefer_timestamp_ntz: bool = True,
) -> dict[str, str]:
    """Reader options of one JDBC table.  ``prefer_timestamp_ntz`` reads
    zone-less SQL timestamps (MySQL ``DATETIME``) as ``timestamp_ntz``, so the
    wall-clock hour does not move with the JVM's zone.  Spark splits scans on
    numbers, dates and zoned timestamps only, so a scan that is split on a
    stamp (bounds that are no numbers) reads it zoned; it is UTC like the plans."""
    opts = {"url": url, "dbtable": table}
    split_on_stamp = lower_bound is not None and not re.fullmatch(r"-?\d+(\.\d+)?", str(lower_bound))
    if prefer_timestamp_ntz and not split_on_stamp:
        opts["preferTimestampNTZ"] = "true"
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    bounds = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError(
                "partition_column, lower_bound, upper_bound and num_partitions go together")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetch_size is not None:
        opts["fetchsize"] = str(fetch_size)
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """``spark.read.format("jdbc")`` with :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def bounds_query(table: str, column: str) -> str:
    """Sub-query (for ``dbtable``) giving the range of ``column``; the
    database computes it, one row comes back."""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str,
                          num_partitions: int, **kwargs) -> DataFrame:
    """Parallel JDBC scan of ``table`` split on ``column`` (numeric, date or
    timestamp): its range is fetched first, then ``num_partitions`` range
    queries run as separate tasks.  An empty table reads as one partition."""
    lo, hi = read_jdbc(spark, url=url, table=bounds_query(table, column), **kwargs).first()
    if lo is None:
        return read_jdbc(spark, url=url, table=table, **kwargs)
    return read_jdbc(spark, url=url, table=table, partition_column=column, lower_bound=lo,
                     upper_bound=hi, num_partitions=num_partitions, **kwargs)


def quantiles_query(table: str, column: str, n: int) -> str:
    """Sub-query (for ``dbtable``) giving the least value of each of ``n`` parts of
    equal row counts; the database computes it, ``n`` rows come back."""
    return (f"(SELECT MIN(v) AS lo, part FROM (SELECT {column} AS v, NTILE({n}) OVER (ORDER BY {column}) AS part "
            f"FROM {table} WHERE {column} IS NOT NULL) ranked GROUP BY part) quantiles")


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def quantile_predicates(column: str, lows: list) -> list[str]:
    """A WHERE clause for each part, from the parts' least values: every row is in
    one, nulls in the first.  A value that fills several parts makes one."""
    cuts = [_literal(x) for x in sorted(set(lows))[1:]]
    if not cuts:
        return []
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(cuts)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc_equal_parts(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                          **kwargs) -> DataFrame:
    """Parallel JDBC scan in parts of equal row counts: where most rows lie in a few
    hours, equal widths of ``column`` leave them to one task.  The bounds are
    asked of the database; fewer values than parts make fewer parts."""
    found = read_jdbc(spark, url=url, table=quantiles_query(table, column, num_partitions), **kwargs)
    predicates = quantile_predicates(column, [r[0] for r in found.select("lo").collect()])
    if not predicates:
        return read_jdbc(spark, url=url, table=table, **kwargs)
    options = jdbc_options(url, table, **kwargs)
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_tables(spark: SparkSession, url: str, user: str | None, password: str | None,
                company_table: str = "company_info", index_table: str = "market_index",
                driver: str | None = MYSQL_DRIVER, partition_column: str | None = None,
                lower_bound=None, upper_bound=None,
                num_partitions: int | None = None,
                equal_parts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both relational tables of the pipeline; the partitioning is that of the
    index scan, whose bounds are asked of the database if they are not given:
    equal widths of the column, or with ``equal_parts`` equal row counts."""
    companies = read_jdbc(spark, url=url, table=company_table, user=user,
                          password=password, driver=driver)
    access = {"url": url, "table": index_table, "user": user, "password": password, "driver": driver}
    if partition_column and equal_parts:
        index = read_jdbc_equal_parts(spark, column=partition_column, num_partitions=num_partitions or 8, **access)
    elif partition_column and lower_bound is None:
        index = read_jdbc_partitioned(spark, column=partition_column,
                                      num_partitions=num_partitions or 8, **access)
    else:
        index = read_jdbc(spark, partition_column=partition_column, lower_bound=lower_bound,
                          upper_bound=upper_bound,
                          num_partitions=num_partitions if partition_column else None, **access)
    return companies, index


def connector_conf(jdbc_jars: str | None = None, packages: str | None = None,
                   document_uri: str | None = None) -> dict[str, str]:
    """Session settings for the connectors (S4): JDBC driver jar(s), connector
    packages (resolved at session start; a Scala 2.13 build is needed on
    Spark 4), and the document-store input URI."""
    conf = {}
    if jdbc_jars:
        conf["spark.jars"] = jdbc_jars
    if packages:
        conf["spark.jars.packages"] = packages
    if document_uri:
        conf["spark.mongodb.read.connection.uri"] = document_uri
    return conf
