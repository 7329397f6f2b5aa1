"""Readers for Parquet and delimited tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waymark.session import use_utc


def instants(schema: T.StructType) -> T.StructType:
    """The schema with wall-clock timestamps declared as instants."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
            for f in schema.fields
        ]
    )


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; wall-clock timestamps are read as UTC instants.

    They are declared in the read schema, not cast afterwards: a cast column would keep
    time filters from reaching the scan. With ``schema`` no file is opened to plan.
    """
    use_utc(spark)
    path = f"{folder}/{name}.parquet"
    if schema is None:
        schema = instants(spark.read.parquet(path).schema)
    return spark.read.schema(schema).parquet(path)


def read_delimited(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A delimited file with a header line and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table whose later days may have more columns."""
    use_utc(spark)
    return spark.read.option("mergeSchema", True).parquet(path)
