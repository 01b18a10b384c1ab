"""Match logs and ratings read out of the order tables.

Player = customer, match = order; shot counts come from line items. The rules are fixed so
that the same logs can be written in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _total(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def match_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and order that has line items.

    Line items are folded to one row per order before the join, so the join moves one narrow
    row per order and reuses the aggregate's partitioning on the order key.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    shots = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy("l_orderkey")
        .agg(
            (_total(quantity, line <= 3).cast("double") / 8.0).alias("match_duration_mins"),
            _total(quantity, flag == "A").cast("bigint").alias("drop_attempts"),
            _total(quantity, (flag == "A") & (status == "F")).cast("bigint").alias("drop_successes"),
            _total(quantity, flag == "N").cast("bigint").alias("drive_attempts"),
            _total(line, (flag == "R") & (status == "O")).cast("bigint").alias("clean_winners"),
            _total(line, (flag == "N") & (status == "O")).cast("bigint").alias("dink_winners"),
            F.count_if(F.col("l_tax") >= 0.04).alias("unforced_errors"),
            F.count_if(F.col("l_discount") >= 0.05).alias("dink_errors"),
        )
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("player_id"),
        F.col("o_orderkey").alias("match_id"),
        (F.col("o_orderstatus") == "F").alias("uses_stacking"),
    )
    return orders.join(shots, orders.match_id == shots.l_orderkey).drop("l_orderkey")


def rally_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balance as the rating of each customer."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("player_id"), F.col("c_acctbal").alias("rally_points")
    )
