"""Readers for the two inputs. Any DataFrame with the same columns works as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from courtlens.functions.expressions import nan_to_null, require_columns
from courtlens.schema import MATCH_LOG_SCHEMA, RATING_SCHEMA


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by name from a Parquet path, with NaN read as missing.

    Types come from the files, so string and integer ids both work.
    """
    df = spark.read.parquet(path)
    require_columns(df, schema.fieldNames(), "Missing input columns: ")
    return nan_to_null(df.select(*schema.fieldNames()))


def read_match_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per player and match."""
    return _read(spark, path, MATCH_LOG_SCHEMA)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """External ``rally_points`` per player."""
    return _read(spark, path, RATING_SCHEMA)
