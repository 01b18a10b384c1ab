"""Joins with parameter tables, and storage for results that are read many times."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest parameter table that is broadcast, in rows and in bytes.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 8 << 20


def join_small(
    df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``df`` with a table that is expected, but not trusted, to be small.

    At most BROADCAST_ROWS + 1 rows are fetched. If they are all and fit, they are broadcast, so ``df`` is not shuffled and a key holding most rows does no harm. If it does not fit, the
    join is an ordinary shuffled one, where adaptive execution splits skewed partitions.
    """
    if hasattr(small, "local_rows"):
        return join_rows(df, *small.local_rows, on, how)
    head = small.limit(BROADCAST_ROWS + 1).toArrow()
    if head.num_rows > BROADCAST_ROWS or head.nbytes > BROADCAST_BYTES:
        return df.join(small, list(on), how)
    local = df.sparkSession.createDataFrame(head, schema=small.schema)
    return df.join(F.broadcast(local), list(on), how)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of rows the driver holds; ``join_small`` takes them from here without a job."""
    frame = spark.createDataFrame(list(rows), schema)
    frame.local_rows = (list(rows), schema)
    return frame


def join_rows(
    df: DataFrame, rows: Sequence[tuple], schema: str, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``df`` with rows the driver holds already; broadcast up to BROADCAST_BYTES."""
    table = df.sparkSession.createDataFrame(list(rows), schema)
    if len(pickle.dumps(rows)) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return df.join(table, list(on), how)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: it uses a folder in its warehouse. On a cluster the setting
    is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:").rstrip("/")
    return f"{warehouse}/_checkpoints"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    Cuts the lineage for inputs of iterative work. The copy is on shared storage, so losing an
    executor costs a re-read and not a recomputation; it is columnar, so later steps read only
    the columns they use, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/courtlens/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def stored_parts(df: DataFrame, column: str, name: str) -> Callable[[object], DataFrame]:
    """``df`` written as ``materialize`` does, split by the values of ``column``.

    The result takes a value and gives its rows, without the column; a value may have none.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/courtlens/{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(column).parquet(path)
    whole = spark.read.schema(df.schema).parquet(path)

    def part(value: object) -> DataFrame:
        rows = whole.filter(F.col(column) == value).drop(column)
        rows.stored_at = path
        return rows

    return part


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables, which nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path.getParent(), True)
