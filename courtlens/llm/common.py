"""Helpers shared by the operators: inputs, stored intermediate tables, text chunks, Bloom filters."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.operators import small_tables
from courtlens.operators.small_tables import materialize

# Bytes of text that one numpy pass handles. Larger texts get a pass of their own.
CHUNK_BYTES = 1 << 18

# Bytes of rows that a batch hands to a Python task where whole texts are read; one row may be larger.
BATCH_BYTES = 1 << 21
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Copies of one row that are unfolded together, rows that a task unfolds, tasks that do so at most.
PIECE, TASK_ROWS, MAX_TASKS = 10_000, 200_000, 20_000

# The steps of the 64-bit mixer.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


store = materialize


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand rows to Python tasks in batches of about BATCH_BYTES.

    By rows alone a batch is all texts of a partition, up to 10,000, which the executor and its
    Python worker hold side by side. The session's own bound comes back afterwards.
    """
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def store_texts(df: DataFrame, name: str) -> DataFrame:
    """``store`` for steps whose Python tasks get whole texts."""
    with bounded_batches(df.sparkSession):
        return store(df, name)


def discard(*tables: DataFrame) -> None:
    """Delete what ``store`` wrote for these tables, which nothing reads any more.

    The shuffle files of the jobs that wrote them go as soon as the driver collects its garbage,
    which is asked for here: on a cluster they hold the local disks of all executors.
    """
    small_tables.discard(*tables)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def column(df: DataFrame, name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return df["`" + name.replace("`", "``") + "`"]


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, _text): identifier, hash of the text, text with null as empty.

    What the operators find depends on identifier and text alone, so the first two identify a row;
    rows that repeat in full share what is found.
    """
    text = F.coalesce(column(df, text_col), F.lit(""))
    return df.select(
        column(df, id_col).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_h"] == right["_h"])


def unfolded(rows: DataFrame, count: str, number: str, total: int) -> DataFrame:
    """A row for each of the ``count`` copies of a row, numbered from 0; in two steps.

    ``total`` copies are spread by their number: few rows may stand for many.
    """
    pieces = rows.withColumn("_piece", F.explode(F.expr(f"sequence(0L, ({count} - 1) div {PIECE})")))
    spread = pieces.repartition(min(max(1, -(-total // TASK_ROWS)), MAX_TASKS), "_piece", *rows.columns)
    last = f"least({count}, (_piece + 1) * {PIECE}) - 1"
    return spread.withColumn(number, F.explode(F.expr(f"sequence(_piece * {PIECE}, {last})"))).drop("_piece")


# ---- inside tasks -----------------------------------------------------------


def chunks(batch: pa.RecordBatch, text: str = "_text") -> Iterator[pa.RecordBatch]:
    """Slices of at most CHUNK_BYTES of text, or of one row."""
    if not batch.num_rows:
        return
    ends = np.frombuffer(_strings(batch, text).buffers()[1], np.int32)
    ends = ends[batch.column(text).offset :][: batch.num_rows + 1].astype(np.int64)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _strings(batch: pa.RecordBatch, name: str) -> pa.Array:
    array = batch.column(name)
    if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type):
        raise TypeError("text comes in batches of at most 2 GB")
    return array


def carried_text(batch: pa.RecordBatch, row: str, text: str, name: str = "_text") -> pa.RecordBatch:
    """``batch`` with the text field of its struct column ``row`` as a column; null is empty.

    The text crosses to the task once, inside the row.
    """
    texts = pc.struct_field(batch.column(row), text)
    return batch.append_column(name, texts.fill_null("") if texts.null_count else texts)


def text_buffer(batch: pa.RecordBatch, name: str = "_text") -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch, and the offset of each text with the end of the last."""
    array = _strings(batch, name)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int32)[array.offset :][: len(array) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> _S30)) * _MIX[0]
    x = (x ^ (x >> _S27)) * _MIX[1]
    return x ^ (x >> _S31)


# ---- Bloom filters ----------------------------------------------------------

BLOOM_MIN_BITS, BLOOM_MAX_BITS, BLOOM_PROBES = 1 << 16, 1 << 27, 4


def bloom_bits(rows: int) -> int:
    """Bits of the filter: 16 a value, a power of two, never more than 16 MB in all."""
    bits = BLOOM_MIN_BITS
    while bits < 16 * rows and bits < BLOOM_MAX_BITS:
        bits *= 2
    return bits


def bloom_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of a frame's only column of 64-bit hashes, as 32-bit words.

    It only saves work: beyond its size bound more values pass, and the exact join that follows
    drops them. The driver gets at most ``bits / 32`` rows whatever the number of hashes.
    """
    name = hashes.columns[0]
    # Probe i is bits of the hash turned by 16 * i, the same as in ``bloom_has``.
    probes = [
        F.shiftleft(F.col(name), 16 * i)
        .bitwiseOR(F.shiftrightunsigned(F.col(name), 64 - 16 * i) if i else F.lit(0).cast("long"))
        .bitwiseAND(F.lit(bits - 1).cast("long"))
        for i in range(BLOOM_PROBES)
    ]
    words = (
        hashes.select(F.explode(F.array(*probes)).alias("p"))
        .groupBy(F.shiftright("p", 5).cast("int").alias("w"))
        .agg(F.expr("bit_or(CAST(shiftleft(1L, CAST(p & 31 AS INT)) AS BIGINT))").alias("b"))
        .toArrow()
    )
    out = np.zeros(bits // 32, np.uint32)
    out[words["w"].to_numpy()] = words["b"].to_numpy().astype(np.uint64).astype(np.uint32)
    return out


def bloom_has(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes (uint64) the filter may hold."""
    mask = np.uint64(len(words) * 32 - 1)
    found = np.arange(len(hashes))
    for i in range(BLOOM_PROBES):
        h = hashes[found]
        if i:
            h = (h << np.uint64(16 * i)) | (h >> np.uint64(64 - 16 * i))
        p = h & mask
        hit = (words[p >> np.uint64(5)] >> (p & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
        found = found[hit.astype(bool)]
    out = np.zeros(len(hashes), bool)
    out[found] = True
    return out
