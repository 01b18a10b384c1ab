"""K selection inside any number of groups, with the models as a table.

``selection.sweep_k`` fits the models of all groups side by side and keeps one entry a group and
model on the driver, which is right for the few groups that skill levels make. Here groups may be
many: by team, by region, by player. Nothing that the driver holds or sends grows with them.

* A group of at most ``local_points`` distinct points is one row range of a shuffle by group. A task
  reads its groups one after another and fits each with the same passes, draws and steps as the
  side-by-side way, so that the models are the same. It holds one group at a time.
* Larger groups are few, as each has more than ``local_points``: they take the side-by-side way, and
  a group that holds most of all players is spread over all tasks.
* Models, silhouettes and choices are tables keyed by (group, seed, K). Assignment joins players
  with the chosen models of their group; hot groups are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import feature_array, nearest_index
from courtlens.operators import kmeans
from courtlens.operators.kmeans import KMeansModel, Starts, fit_models
from courtlens.operators.points import GroupSize, Points, axis_names, fold_points, group_key
from courtlens.operators.selection import sweep_k
from courtlens.operators.silhouette import local_silhouettes
from courtlens.operators.small_tables import discard, join_small, materialize
from courtlens.schema import DEFAULT_SEED, K_MAX, K_MIN, MAX_ITER, N_INIT

# Distinct points of a group that one task fits and scores; its distances are the square of that.
LOCAL_POINTS = 5_000
MODEL_SCHEMA = (
    "grp string, seed int, k int, clusters int, silhouette double, cost double, iterations int, "
    "centres array<array<double>>"
)


@dataclass
class GroupSweep:
    """``models``: skill_group, seed, k, clusters, silhouette, cost, iterations, centres, selected."""

    models: DataFrame
    features: list[str]
    group_col: str

    def chosen(self) -> DataFrame:
        """The model of highest silhouette per group and seed; the smallest such K."""
        return self.models.filter("selected").drop("selected")

    def assign(self, df: DataFrame, output: str = "playstyle_cluster", seed: int = DEFAULT_SEED) -> DataFrame:
        """Add the nearest centre of the group's chosen model; 0 in groups without one, NULL without group."""
        key = group_key(self.group_col)
        chosen = self.chosen().filter(F.col("seed") == seed).select(F.col("grp").alias("_grp"), "centres")
        labelled = join_small(df.withColumn("_grp", key), chosen, ["_grp"], "left")
        nearest = F.coalesce(nearest_index(feature_array(self.features), F.col("centres")), F.lit(0))
        return labelled.select(*df.columns, F.when(key.isNotNull(), nearest).alias(output))


class _LocalPasses:
    """The passes over the points of one group that a task holds."""

    def __init__(self, batch: pa.RecordBatch, dimensions: int) -> None:
        self.batch, self.dimensions = batch, dimensions
        self.axes = axis_names(dimensions)

    def sums(self, runs: Sequence) -> tuple[np.ndarray, np.ndarray]:
        slabs, starts = kmeans._layout(runs)
        rows = sum(len(r.centres) for r in runs)
        (found,) = kmeans._sums_kernel(slabs, rows, self.dimensions)(iter([self.batch]))
        total = np.zeros((rows, self.dimensions + 2))
        values = np.column_stack([c.to_numpy() for c in found.columns[1:]])
        total[found.column("row").to_numpy()] = values
        return total, starts

    def draw(self, runs: Sequence, counts: Sequence[int], step: int, farthest: bool = False) -> list[np.ndarray]:
        slabs, _ = kmeans._layout(runs, step)
        (found,) = kmeans._draw_kernel(slabs, list(counts), self.dimensions, farthest)(iter([self.batch]))
        model, key = found.column("model").to_numpy(), found.column("key").to_numpy()
        values = np.column_stack([found.column(a).to_numpy() for a in self.axes])
        # Best key first; equal keys by their point.
        order = np.lexsort((*values.T[::-1], -key, model))
        edges = np.searchsorted(model[order], np.arange(len(runs) + 1))
        return [values[order[edges[i] : edges[i + 1]][:n]] for i, n in enumerate(counts)]


def _fit_kernel(
    features: Sequence[str],
    ks: Sequence[int],
    seeds: Sequence[int],
    n_init: int,
    max_iter: int,
    starts: Callable[[str], Starts] | None,
) -> Callable:
    """Tasks that fit and score group after group; rows arrive by group."""
    dimensions = len(features)
    axes = axis_names(dimensions)

    def fit(group: str, table: pa.Table) -> list[tuple]:
        x = np.column_stack([table[a].to_numpy() for a in axes])
        weight = table["weight"].to_numpy()
        centre = (x * weight[:, None]).sum(0) / weight.sum()
        x = x - centre
        size = GroupSize(
            int(weight.sum()), len(x), float(((x**2) * weight[:, None]).sum(0).mean() / weight.sum()), centre
        )
        wanted = [(group, k, seed) for k in ks if k < size.rows for seed in seeds]
        if not wanted or size.rows < 3:
            return []
        batch = pa.RecordBatch.from_arrays(
            [pa.array([group] * len(x)), *[pa.array(x[:, j]) for j in range(dimensions)],
             pa.array(weight), table["hash"].combine_chunks()],
            ["grp", *axes, "weight", "hash"],
        )
        points = Points(None, list(features), {group: size}, [])
        passes = _LocalPasses(batch, dimensions)
        given = None if starts is None else starts(group)
        models = fit_models(points, passes, passes, wanted, n_init, max_iter, 1e-4 if given is None else 0.0, given)
        labels = [kmeans._nearest(x, (m.centres - centre)[None])[:, 0] for m in models]
        scores = local_silhouettes(x, weight, labels)
        return [
            (group, m.seed, m.k, clusters, value, m.cost, m.iterations, m.centres.tolist())
            for m, (clusters, value) in zip(models, scores, strict=True)
        ]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32()]
        kinds.append(pa.list_(pa.list_(pa.float64())))
        names = ["grp", "seed", "k", "clusters", "silhouette", "cost", "iterations", "centres"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple] = []
        for batch in batches:
            groups = batch.column("grp").to_pylist()
            first = 0
            while first < len(groups):
                last = first
                while last < len(groups) and groups[last] == groups[first]:
                    last += 1
                if held and held[0].column("grp")[0].as_py() != groups[first]:
                    out += fit(held[0].column("grp")[0].as_py(), pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(first, last - first))
                first = last
            if len(out) > 1000:
                yield rows(out)
                out = []
        if held:
            out += fit(held[0].column("grp")[0].as_py(), pa.Table.from_batches(held))
        if out:
            yield rows(out)

    return run


def sweep_groups(
    df: DataFrame,
    features: Sequence[str],
    group_col: str = "skill_group",
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    seeds: Sequence[int] = (DEFAULT_SEED,),
    n_init: int = N_INIT,
    max_iter: int = MAX_ITER,
    local_points: int = LOCAL_POINTS,
    starts: Callable[[str], Starts] | None = None,
) -> GroupSweep:
    """Fit and score K = k_min .. min(k_max, rows - 1) in every group of three or more rows.

    Groups whose players are all alike have no chosen model; smaller groups have none at all.
    ``starts`` gives the starting centres of a group instead of random restarts.
    """
    packed = materialize(fold_points(df, features, group_col, draws=starts is None), "group_points")
    large = (
        packed.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > local_points).select("grp")
    )
    # No more rows than all points by ``local_points``.
    names = [r["grp"] for r in large.collect()]
    small = packed if not names else packed.join(F.broadcast(large), "grp", "left_anti")
    kernel = _fit_kernel(features, range(k_min, k_max + 1), list(seeds), n_init, max_iter, starts)
    models = small.repartition("grp").sortWithinPartitions("grp", "id").mapInArrow(kernel, MODEL_SCHEMA)
    if names:
        models = models.unionByName(
            _side_by_side(df, features, group_col, names, k_min, k_max, seeds, n_init, max_iter, starts)
        )
    models = materialize(models, "group_models")
    discard(packed)
    best = models.filter("silhouette IS NOT NULL").groupBy("grp", "seed").agg(
        F.max(F.struct("silhouette", (-F.col("k")).alias("smaller"))).alias("top")
    )
    marked = models.join(best.select("grp", "seed", (-F.col("top.smaller")).alias("best")), ["grp", "seed"], "left")
    marked = marked.withColumn("selected", F.col("k").eqNullSafe(F.col("best"))).drop("best")
    return GroupSweep(marked, list(features), group_col)


def _side_by_side(df, features, group_col, names, k_min, k_max, seeds, n_init, max_iter, starts) -> DataFrame:
    """Models of large groups, whose points are spread over all tasks."""
    given = None if starts is None else {k: v for name in names for k, v in starts(name).items()}
    some = df.filter(group_key(group_col).isin(names))
    sweep = sweep_k(
        some, features, group_col, k_min, k_max, seeds, n_init, min_rows=3, skip_small=True,
        starts=given, max_iter=max_iter,
    )
    rows = []
    for (group, seed, k), (clusters, value) in sweep.silhouettes.items():
        m: KMeansModel = sweep.models[(group, seed, k)]
        rows.append((group, seed, k, clusters, value, m.cost, m.iterations, m.centres.tolist()))
    return df.sparkSession.createDataFrame(rows, MODEL_SCHEMA)
