"""Sharding by a hierarchical weighted hash tree.

A row descends from the root over region and rack to a shard. At every level each child draws
``-ln(u) / weight`` with u from a hash of the key and the child's name, and the least draw wins: a
child gets rows in proportion to its weight, and changing one weight moves rows only between that
child and its siblings, so movement stays in the subtrees whose weights change.

A new shard arrives as a region of its own. Put into an old rack it would raise that rack's and
region's weights as well, and rows won there would spread over the old shards below; in a region
of its own it takes rows only into itself.

Everything is one projection. Slots number each shard's rows without gaps: rows are folded when
equal, ordered by a hash, cut into buckets of that hash, numbered in each bucket and shifted by
the counts of the buckets before, so no shard is sorted in one task.

Defined cases: a null key is hashed as the empty string; a null text has no bytes; equal rows get
slots of their own; other columns are ignored; an empty table has an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlens.llm.common import column, store, unfolded

# Rows that one slot bucket aims at, over all shards.
BUCKET_ROWS = 50_000
_HASH_DIGITS = 13  # of md5 in hexadecimal: 52 bits, exact in a double


@dataclass(frozen=True)
class Tree:
    """Shard weights by region and rack; shards are numbered in this order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def regular(regions: int, racks: int, shards: int) -> Tree:
        return Tree((((1.0,) * shards,) * racks,) * regions)

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, numbered last, in a region of its own."""
        return Tree((*self.regions, ((weight,),)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)


def hash52(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("long")


def _sql(value) -> str:
    if isinstance(value, tuple):
        return "array(" + ", ".join(map(_sql, value)) + ")"
    return f"{float(value)!r}D"


def _winner(weights: str, key: str, path: str) -> str:
    """SQL of the child with the least draw; ``path`` is SQL text naming the parent."""
    code = f"conv(substring(md5(concat({key}, '/', {path}, i)), 1, {_HASH_DIGITS}), 16, 10)"
    draw = f"-ln((CAST({code} AS BIGINT) + 0.5D) / {float(1 << 52)!r}D) / w"
    return f"array_min(transform({weights}, (w, i) -> struct({draw} AS draw, i AS child))).child"


def place(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """``df`` with the shard of the string column ``key`` as ``name``."""
    racks = tuple(tuple(sum(rack) for rack in region) for region in tree.regions)
    first, offsets = 0, []
    for region in tree.regions:
        offsets.append([])
        for rack in region:
            offsets[-1].append(first)
            first += len(rack)
    ints = "array(" + ", ".join("array(" + ", ".join(map(str, r)) + ")" for r in offsets) + ")"
    region = _winner(_sql(tuple(map(sum, racks))), key, "''")
    df = df.withColumn("_region", F.expr(region))
    df = df.withColumn(
        "_rack", F.expr(_winner(f"{_sql(racks)}[_region]", key, "concat(_region, '/')"))
    )
    leaf = _winner(
        f"{_sql(tree.regions)}[_region][_rack]", key, "concat(_region, '/', _rack, '/')"
    )
    shard = F.expr(f"{ints}[_region][_rack] + {leaf}").cast("int")
    return df.withColumn(name, shard).drop("_region", "_rack")


def shard_rows(
    docs: DataFrame,
    tree: Tree,
    grown: Tree,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(_id, size, text_crc32, shard, slot, grown_shard) per document."""
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(
        column(docs, id_col).alias("_id"),
        F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("_key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    folded = rows.groupBy("_id", "_key", "size", "text_crc32").count()
    placed = place(place(folded, "_key", tree, "shard"), "_key", grown, "grown_shard")
    order = hash52(F.concat_ws("/", "_key", "size", "text_crc32"))
    placed = store(placed.withColumn("_order", order), "placed")
    total = placed.agg(F.sum("count")).first()[0] or 0
    bits = max(0, (total // BUCKET_ROWS).bit_length())
    bucket = F.shiftright("_order", 52 - bits)
    placed = placed.withColumn("_bucket", bucket)
    # A few rows per shard and bucket: one for BUCKET_ROWS / shards documents.
    counts = placed.groupBy("shard", "_bucket").agg(F.sum("count").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        "shard", "_bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    inside = (
        Window.partitionBy("shard", "_bucket")
        .orderBy("_order", "_key", "size", "text_crc32", F.col("_id").isNull())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = placed.withColumn("_first", F.coalesce(F.sum("count").over(inside), F.lit(0)))
    numbered = numbered.join(before, ["shard", "_bucket"]).select(
        "_id", "size", "text_crc32", "shard", (F.col("before") + F.col("_first")).alias("_from"), "count", "grown_shard"
    )
    # A row that repeats very often is unfolded by many tasks.
    return unfolded(numbered, "count", "_copy", total).select(
        "_id", "size", "text_crc32", "shard", (F.col("_from") + F.col("_copy")).alias("slot"), "grown_shard"
    )
