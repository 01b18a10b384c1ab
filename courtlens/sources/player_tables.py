"""Tables laid out by player, which joins and checks by player read without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from courtlens.operators.small_tables import checkpoint_dir
from courtlens.schema import PLAYER

# Tables that are joined need equal numbers; one bucket is one task.
BUCKETS = 64


def save_by_player(df: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in buckets of players, sorted by player, and read it back.

    ``name`` is replaced if it exists. The files go to ``path``, by default to a new folder of the
    checkpoint folder. Rows are shuffled once, here; one player's rows share a bucket.
    """
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark)}/courtlens/{uuid.uuid4().hex}/{name}"
    (
        df.repartition(buckets, PLAYER)
        .write.format("parquet")
        .bucketBy(buckets, PLAYER)
        .sortBy(PLAYER)
        .mode("overwrite")
        .option("path", path)
        .saveAsTable(name)
    )
    table = spark.table(name)
    table.stored_at = path
    return table


def drop_player_table(table: DataFrame, name: str) -> None:
    """Forget the table and delete its files."""
    spark = table.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
