"""Nested trade documents: read from any Spark source, write as JSON or parquet.

A document store is read through its Spark connector (``fmt="mongodb"`` with
``connection.uri`` / ``database`` / ``collection`` options) when that jar is on
the classpath; files of the same shape are read with the types they have.

JSON can also be taken in as VARIANT: each line (or element of an array, see
``sources.json_array``) is parsed once, in the pass that uses it, and the fields
come out in the types asked for; no pass over the files infers them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickfold import schemas
from tickfold.functions.time import as_timestamp
from tickfold.sources.json_array import array_elements, write_array


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "json",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
    multiline: bool = False,
    variant: bool = False,
    json_array: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Read documents ``(timestamp, transactions: array<struct>)``.

    By default the source supplies the types, as the document store's connector
    does: JSON is read once to infer them (``options={"samplingRatio": ...}``
    makes that pass smaller), stamps stay text and are parsed by the hourly
    step, lines that are no JSON are kept in ``_corrupt_record``.  ``schema``
    (``schemas.DOCUMENT_OPEN``, or ``DOCUMENT`` for files this package wrote)
    saves the pass.  ``multiline`` reads files that hold one JSON array, a file a
    task.

    ``json_array`` reads such files by many tasks each (cut at ``split_bytes``),
    ``variant`` reads lines; both without a pass for the types, which are those of
    ``schema`` (default ``schemas.DOCUMENT_OPEN``).
    """
    if json_array:
        return typed_documents(array_elements(spark, path, split_bytes), schema)
    if variant:
        return typed_documents(spark.read.text(path), schema)
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE").option("multiLine", str(multiline).lower()).option(
            "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]")
    if options:
        reader = reader.options(**options)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def typed_documents(lines: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The fields of ``schema`` of each JSON text in ``value``, and ``_corrupt_record``.

    A text that is no JSON leaves its fields null and is kept in
    ``_corrupt_record``; a value that can't be had in its type is null; numbers
    in quotes are numbers; blank lines are no documents.
    """
    wanted = (schema or schemas.DOCUMENT_OPEN).simpleString()
    # Not deterministic to Spark, which else parses again for the filter it makes of an explode.
    once = F.when(F.monotonically_increasing_id() >= 0, F.col("value"))
    parsed = lines.where(F.trim("value") != "").select("value", F.try_parse_json(once).alias("parsed"))
    typed = parsed.select("value", F.col("parsed").isNull().alias("corrupt"),
                          F.try_variant_get("parsed", "$", wanted).alias("document"))
    return typed.select("document.*", F.when(F.col("corrupt"), F.col("value")).alias("_corrupt_record"))


def document_quality(documents: DataFrame) -> DataFrame:
    """One row of counts: what a run over ``documents`` cannot use as it is.

    ``documents``, ``corrupt`` (no JSON), ``null_stamps``, ``unparsed_stamps``
    (text that is no stamp), ``trades``, ``null_shares``, ``null_prices``.
    One aggregate; arrays are counted in place.
    """
    return documents.agg(*quality_counts(documents))


def quality_counts(documents: DataFrame) -> list[Column]:
    """The aggregates of :func:`document_quality`, also for ``DataFrame.observe``."""
    stamp = as_timestamp("timestamp", documents.schema["timestamp"].dataType)
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in documents.columns else F.lit(False)
    trades = F.coalesce(F.col("transactions"), F.array())

    def nulls(field: str):
        return F.sum(F.size(F.filter(trades, lambda t: t[field].isNull()))).alias(f"null_{field}")

    return [
        F.count(F.lit(1)).alias("documents"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if(F.col("timestamp").isNull()).alias("null_stamps"),
        F.count_if(F.col("timestamp").isNotNull() & stamp.isNull()).alias("unparsed_stamps"),
        F.sum(F.size(trades)).alias("trades"), nulls("shares"),
        nulls("price").alias("null_prices")]


def document_store_options(uri: str, database: str, collection: str) -> dict[str, str]:
    """Reader options of the document-store connector (S3)."""
    return {"connection.uri": uri, "database": database, "collection": collection}


def write_documents(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> str:
    """Write documents in parallel (one file per task) and return the path.
    ``fmt="json_array"`` makes each file one JSON array (in a new folder)."""
    if fmt == "json_array":
        return write_array(df, path)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    writer.save(path)
    return path
