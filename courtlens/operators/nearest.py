"""Nearest of very many centres, by a partitioned join with bounds.

``nearest_index`` compares a point with every centre of a small table that travels to all tasks.
Centres may also be a table that no task should hold: codebooks, or players compared with players.
They are cut into cells around pivots, a bounded sample of the centres, each in the cell of its
nearest pivot, and points meet only cells that can hold their nearest centre:

1. A point measures the pivots and goes to the cell of the nearest, which gives it a distance that its
   nearest centre cannot exceed.
2. It goes to another cell only if that could do better: if the cell's ball (its pivot and its largest
   distance from there) comes nearer than that, and if the half-space of places nearer to the cell's
   pivot than to its own does.

Both follow from the triangle inequality, so the result is exact; of equal distances the lowest
cluster wins. What tasks hold is the pivots, one block of a cell's centres, and a batch of points.
Cells of many points are dealt to several tasks, each with the cell's centres.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.operators.points import axis_names
from courtlens.operators.small_tables import discard, join_rows, materialize

MAX_PIVOTS = 1024
# Points that one task compares with a cell, centres compared at a time, cells of a distance matrix.
POINTS_PER_TASK, CENTRES_AT_ONCE, CELLS = 200_000, 4096, 1 << 20
# A bound has to be exceeded by more than rounding errors.
SLACK = 1e-9


def _chunks(rows: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, width))
    for start in range(0, rows, step):
        yield slice(start, start + step)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances by differences, so that equal pairs have equal ones wherever they are computed."""
    squared = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        squared += (x[:, j, None] - centres[None, :, j]) ** 2
    return np.sqrt(squared)


def other_cells(
    x: np.ndarray, own: np.ndarray, best: np.ndarray, pivots: np.ndarray, radii: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(point, cell) pairs: cells beside its own that may hold a centre nearer than ``best``."""
    points, cells = [], []
    for part in _chunks(len(x), len(pivots)):
        d = _distances(x[part], pivots)
        here = d[np.arange(len(d)), own[part]][:, None]
        limit = best[part, None] + SLACK * (1.0 + best[part, None])
        apart = _distances(pivots[own[part]], pivots)
        with np.errstate(divide="ignore", invalid="ignore"):
            half = np.where(apart > 0, (d**2 - here**2) / (2 * apart), 0.0)
        open_ = (d - radii <= limit) & (half <= limit) & (radii >= 0)
        open_[np.arange(len(d)), own[part]] = False
        p, c = np.nonzero(open_)
        points.append(p + part.start)
        cells.append(c)
    return np.concatenate(points), np.concatenate(cells)


def _place(pivots: np.ndarray, dimensions: int) -> Callable:
    """Tasks that add the nearest pivot as ``cell`` and its distance as ``reach``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(a).to_numpy() for a in axis_names(dimensions)])
            cell, reach = np.zeros(len(x), np.int32), np.zeros(len(x))
            for part in _chunks(len(x), len(pivots)):
                d = _distances(x[part], pivots)
                cell[part] = d.argmin(axis=1)
                reach[part] = d.min(axis=1)
            yield batch.append_column("cell", pa.array(cell)).append_column("reach", pa.array(reach))

    return run


def _spread(pivots: np.ndarray, radii: np.ndarray, dimensions: int) -> Callable:
    """Tasks that send points to the other cells that they have to see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(a).to_numpy() for a in axis_names(dimensions)])
            if not len(x):
                continue
            point, cell = other_cells(
                x, batch.column("cell").to_numpy(), batch.column("best").to_numpy(), pivots, radii
            )
            kept = batch.drop_columns(["cell"]).take(pa.array(point))
            yield kept.append_column("cell", pa.array(cell.astype(np.int32)))

    return run


def _compare(dimensions: int) -> Callable:
    """Tasks that compare points with the centres of their cell; rows come by cell, centres first."""
    axes = axis_names(dimensions)

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([batch.column(a).to_numpy() for a in axes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, centres, clusters = None, [], []
        for whole in batches:
            keys = np.stack([whole.column("cell").to_numpy(), whole.column("share").to_numpy()], axis=1)
            edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for first, last in zip([0, *edges], [*edges, len(keys)], strict=True):
                if first == last:
                    continue
                batch = whole.slice(int(first), int(last - first))
                if where is None or tuple(keys[first]) != where:
                    where, centres, clusters = tuple(keys[first]), [], []
                n = int((batch.column("point").to_numpy() < 0).sum())
                if n:
                    centres.append(matrix(batch.slice(0, n)))
                    clusters.append(batch.column("cluster").to_numpy()[:n])
                points = batch.slice(n)
                if not points.num_rows:
                    continue
                x = matrix(points)
                best = np.full(len(x), np.inf)
                found = np.full(len(x), np.iinfo(np.int64).max)
                for c, names in zip(centres, clusters, strict=True):
                    for j in range(0, len(c), CENTRES_AT_ONCE):
                        block, of = c[j : j + CENTRES_AT_ONCE], names[j : j + CENTRES_AT_ONCE]
                        for part in _chunks(len(x), len(block)):
                            d = _distances(x[part], block)
                            least = d.min(axis=1)
                            tied = np.where(d == least[:, None], of, np.iinfo(np.int64).max).min(axis=1)
                            nearer = (least < best[part]) | (least == best[part]) & (tied < found[part])
                            best[part] = np.where(nearer, least, best[part])
                            found[part] = np.where(nearer, tied, found[part])
                known = np.isfinite(best)
                yield pa.RecordBatch.from_arrays(
                    [points.column("point").filter(pa.array(known)), pa.array(best[known]), pa.array(found[known])],
                    ["point", "best", "cluster"],
                )

    return run


def _meet(points: DataFrame, centres: DataFrame, axes: list[str]) -> DataFrame:
    """(point, best, cluster) of points (with ``cell``) against the centres of that cell."""
    counts = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    # A row per pivot.
    shares = [(r["cell"], max(1, math.ceil(r["n"] / POINTS_PER_TASK))) for r in counts]
    schema = "cell int, shares int"
    dealt = join_rows(points, shares, schema, ["cell"]).select(
        "cell",
        F.pmod(F.xxhash64("point"), F.col("shares")).cast("int").alias("share"),
        "point",
        F.lit(0).cast("long").alias("cluster"),
        *axes,
    )
    copies = join_rows(centres, shares, schema, ["cell"]).select(
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        F.lit(-1).cast("long").alias("point"),
        "cluster",
        *axes,
    )
    rows = dealt.unionByName(copies).repartition("cell", "share")
    rows = rows.sortWithinPartitions("cell", "share", F.col("point") >= 0)
    return rows.mapInArrow(_compare(len(axes)), "point bigint, best double, cluster bigint")


def assign_nearest(
    df: DataFrame,
    features: Sequence[str],
    centres: DataFrame,
    output: str,
    pivots: int | None = None,
) -> DataFrame:
    """Add ``output``: the cluster of the nearest of ``centres``, rows (cluster, features).

    Rows that miss a feature get NULL, as all do if there are no centres.
    """
    axes = axis_names(len(features))

    def numeric(frame: DataFrame) -> list:
        return [F.col(f).cast("double").alias(a) for f, a in zip(features, axes)]

    def complete(frame: DataFrame) -> DataFrame:
        return frame.filter(" AND ".join(f"{a} IS NOT NULL AND NOT isnan({a})" for a in axes))

    there = complete(centres.select(F.col("cluster").cast("long").alias("cluster"), *numeric(centres)))
    there = materialize(there, "centres")
    wanted = pivots or min(MAX_PIVOTS, max(1, math.isqrt(there.count())))
    sample = there.select(*axes).distinct().orderBy(F.xxhash64(*axes), *axes).limit(wanted).toArrow()
    if not sample.num_rows:
        return df.withColumn(output, F.lit(None).cast("long"))
    chosen = np.column_stack([sample.column(a).to_numpy() for a in axes])
    fields = ", ".join(f"{a} double" for a in axes)
    celled = materialize(
        there.mapInArrow(_place(chosen, len(axes)), f"cluster bigint, {fields}, cell int, reach double"), "cells"
    )
    radii = np.full(len(chosen), -np.inf)
    for r in celled.groupBy("cell").agg(F.max("reach").alias("radius")).collect():
        radii[r["cell"]] = r["radius"]

    rows = materialize(df.withColumn("_point", F.monotonically_increasing_id()), "rows")
    points = complete(rows.select(F.col("_point").alias("point"), *numeric(rows)))
    placed = materialize(
        points.mapInArrow(_place(chosen, len(axes)), f"point bigint, {fields}, cell int, reach double"), "placed"
    )
    first = materialize(_meet(placed.drop("reach"), celled.drop("reach"), axes), "first")
    seen = placed.drop("reach").join(first.select("point", "best"), "point")
    spread = seen.mapInArrow(_spread(chosen, radii, len(axes)), f"point bigint, {fields}, best double, cell int")
    spread = materialize(spread.drop("best"), "spread")
    second = _meet(spread, celled.drop("reach"), axes)
    best = materialize(
        first.unionByName(second).groupBy("point").agg(F.min(F.struct("best", "cluster"))["cluster"].alias(output)), "best"
    )
    discard(there, celled, placed, first, spread)
    return rows.join(best.withColumnRenamed("point", "_point"), "_point", "left").select(*df.columns, output)
