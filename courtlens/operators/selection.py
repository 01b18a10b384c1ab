"""Choosing K, clustering with the chosen model, and checking stability over seeds.

Every model of a question (all K, restarts, seeds and skill groups) is fitted in one batch, and
all resulting labelings are scored over the same distances.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.operators.agreement import adjusted_rand_index
from courtlens.operators.checks import check_one_to_one
from courtlens.operators.kmeans import (
    KMeansModel,
    Starts,
    assign_clusters,
    assign_labelings,
    centres_frame,
    fit_kmeans,
    label_points,
)
from courtlens.operators.points import ALL, pack_points
from courtlens.operators.silhouette import score_labelings
from courtlens.functions.expressions import require_columns
from courtlens.schema import (
    DEFAULT_SEED,
    K_MAX,
    K_MIN,
    MAX_ITER,
    N_INIT,
    PLAYER,
    PLAYSTYLE_FEATURES,
    SKILL_FEATURES,
    STABILITY_SEEDS,
)


@dataclass
class Sweep:
    """Fitted models and their silhouettes: one per group, seed and K."""

    models: dict[tuple[str, int, int], KMeansModel]
    silhouettes: dict[tuple[str, int, int], tuple[int, float | None]]
    features: list[str]

    def chosen(self, seed: int) -> dict[str, int]:
        """Per group, the K with the highest silhouette; the smallest such K.

        A group whose players are all alike has no K with two clusters and is left out.
        """
        best: dict[str, tuple[float, int]] = {}
        for (g, s, k), (_, value) in self.silhouettes.items():
            if s == seed and value is not None:
                best[g] = min(best.get(g, (math.inf, 0)), (-value, k))
        return {g: k for g, (_, k) in sorted(best.items())}

    def best_k(self, group: str, seed: int) -> int:
        chosen = self.chosen(seed)
        if group not in chosen:
            raise ValueError(f"No K gives at least two clusters in '{group}'.")
        return chosen[group]

    def best_models(self, seed: int) -> dict[str, KMeansModel]:
        return {g: self.models[(g, seed, k)] for g, k in self.chosen(seed).items()}

    def results(self, df: DataFrame) -> DataFrame:
        """(skill_group, seed, k, clusters, silhouette, cost, selected)."""
        chosen = {s: self.chosen(s) for s in {s for _, s, _ in self.models}}
        rows = [
            (g, s, k, clusters, value, self.models[(g, s, k)].cost, chosen[s].get(g) == k)
            for (g, s, k), (clusters, value) in sorted(self.silhouettes.items())
        ]
        return df.sparkSession.createDataFrame(
            rows,
            "skill_group string, seed int, k int, clusters int, silhouette double, "
            "cost double, selected boolean",
        )

    def centres(self, df: DataFrame) -> DataFrame:
        return centres_frame(df.sparkSession, list(self.models.values()), self.features)


def small_groups(df: DataFrame, group_col: str = "skill_group", min_rows: int = 3) -> DataFrame:
    """(group, players): groups that have too few players for several K."""
    counts = df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(F.count(F.lit(1)).alias("players"))
    return counts.filter(F.col("players") < min_rows)


def sweep_k(
    df: DataFrame,
    features: Sequence[str],
    group_col: str | None = None,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    seeds: Sequence[int] = (DEFAULT_SEED,),
    n_init: int = N_INIT,
    metric: str = "euclidean",
    min_rows: int = 0,
    skip_small: bool = False,
    starts: Starts | None = None,
    max_iter: int = MAX_ITER,
) -> Sweep:
    """Fit and score K = k_min .. min(k_max, rows - 1) in every group and for every seed.

    ``starts`` are given starting centres by (group, K, seed) instead of random restarts.
    """
    points = pack_points(df, features, group_col, draws=starts is None)
    try:
        ks = {}
        for group, size in points.groups.items():
            top = min(k_max, size.rows - 1)
            if size.rows < min_rows or top < k_min:
                if skip_small:
                    continue
                where = "" if group_col is None else f" in '{group}'"
                raise ValueError(f"Too few players{where} to compare several K.")
            ks[group] = list(range(k_min, top + 1))
        if not ks and not skip_small:
            raise ValueError("Too few players to compare several K.")
        models = fit_kmeans(
            points, ks, list(seeds), n_init=n_init, max_iter=max_iter, starts=starts
        )
        names: dict[str, list[tuple[int, int]]] = {}
        for m in models:
            names.setdefault(m.group, []).append((m.seed, m.k))
        scores = {}
        if models:
            scores = score_labelings(points, label_points(points, models), names, metric)
    finally:
        points.release()
    return Sweep(
        {(m.group, m.seed, m.k): m for m in models},
        {(g, seed, k): value for (g, (seed, k)), value in scores.items()},
        list(features),
    )


# ---- level 1: skill groups --------------------------------------------------


def prepare_clustering_data(skill_profiles: DataFrame, scaled_features: DataFrame) -> DataFrame:
    """player_id, skill_score and the ten scaled features, one row per scored player.

    Ids must be unique on both sides and no scored player may lack features.
    """
    require_columns(skill_profiles, [PLAYER], "The skill profiles lack: ")
    require_columns(scaled_features, [PLAYER], "The scaled features lack: ")
    require_columns(scaled_features, SKILL_FEATURES, "Clustering needs these features: ")
    check_one_to_one(
        skill_profiles,
        scaled_features,
        PLAYER,
        left_repeats="A player occurs twice in the skill profiles.",
        right_repeats="A player occurs twice in the scaled features.",
        lost="Some scored players have no scaled features.",
    )
    return skill_profiles.select(PLAYER, "skill_score").join(
        scaled_features.select(PLAYER, *SKILL_FEATURES), PLAYER
    )


def select_skill_k(
    clustering_data: DataFrame,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    random_state: int = DEFAULT_SEED,
    n_init: int = N_INIT,
    metric: str = "euclidean",
    starts: Starts | None = None,
    max_iter: int = MAX_ITER,
) -> tuple[int, Sweep]:
    """K with the best silhouette over the ten skill features, and everything fitted for it."""
    sweep = sweep_k(
        clustering_data, SKILL_FEATURES, None, k_min, k_max, [random_state], n_init, metric,
        starts=starts, max_iter=max_iter,
    )
    return sweep.best_k(ALL, random_state), sweep


def cluster_skill_groups(
    clustering_data: DataFrame,
    best_k: int,
    random_state: int = DEFAULT_SEED,
    sweep: Sweep | None = None,
) -> tuple[DataFrame, KMeansModel]:
    """Add ``skill_cluster``. Reuses the model of ``sweep``; fits one if there is none."""
    if sweep is None:
        points = pack_points(clustering_data, SKILL_FEATURES)
        try:
            (model,) = fit_kmeans(points, {ALL: [best_k]}, [random_state])
        finally:
            points.release()
    else:
        model = sweep.models[(ALL, random_state, best_k)]
    return assign_clusters(clustering_data, SKILL_FEATURES, [model], "skill_cluster"), model


# ---- level 2: playstyles inside skill groups --------------------------------


def _in_group(df: DataFrame, skill_group: str | None) -> DataFrame:
    return df if skill_group is None else df.filter(F.col("skill_group") == skill_group)


def select_playstyle_k(
    skill_clustered: DataFrame,
    skill_group: str | None = None,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    random_state: int = DEFAULT_SEED,
    features: Sequence[str] | None = None,
    n_init: int = N_INIT,
    metric: str = "euclidean",
    skip_small: bool = False,
    starts: Starts | None = None,
    max_iter: int = MAX_ITER,
) -> tuple[DataFrame, dict[str, int], Sweep]:
    """Best K per skill group; all groups at once, or only ``skill_group``.

    ``features`` are the columns K-Means sees: the thirteen scaled style features unless given
    (usually the component scores). A group with fewer than three players raises, unless
    ``skip_small``: then it gets no model. Neither does a group whose players are all alike.
    """
    features = list(PLAYSTYLE_FEATURES if features is None else features)
    group_data = _in_group(skill_clustered, skill_group)
    sweep = sweep_k(
        group_data, features, "skill_group", k_min, k_max, [random_state], n_init, metric,
        min_rows=3, skip_small=skip_small, starts=starts, max_iter=max_iter,
    )
    return group_data, sweep.chosen(random_state), sweep


def cluster_playstyles(
    group_data: DataFrame,
    best_k: dict[str, int] | int,
    random_state: int = DEFAULT_SEED,
    features: Sequence[str] | None = None,
    sweep: Sweep | None = None,
) -> tuple[DataFrame, dict[str, KMeansModel], DataFrame]:
    """Add ``playstyle_cluster`` (numbered from 0 inside each skill group).

    ``best_k`` is per group, or one K for all. Returns the frame, the model per group and the
    cluster sizes. A group without an entry in ``best_k`` is a single style, cluster 0.
    """
    features = list(PLAYSTYLE_FEATURES if features is None else features)
    if isinstance(best_k, int) and sweep is not None:
        best_k = {g: best_k for g, _, k in sweep.models if k == best_k}
    if sweep is None:
        points = pack_points(group_data, features, "skill_group")
        try:
            if isinstance(best_k, int):
                best_k = {g: best_k for g in points.groups}
            ks = {g: [k] for g, k in best_k.items() if g in points.groups}
            fitted = fit_kmeans(points, ks, [random_state])
        finally:
            points.release()
        models = {m.group: m for m in fitted}
    else:
        models = {g: sweep.models[(g, random_state, k)] for g, k in best_k.items()}
    clustered = assign_clusters(
        group_data, features, list(models.values()), "playstyle_cluster", "skill_group"
    )
    clustered = clustered.withColumn(
        "playstyle_cluster",
        F.when(
            F.col("skill_group").isNotNull(), F.coalesce("playstyle_cluster", F.lit(0))
        ),
    )
    return clustered, models, cluster_sizes(clustered, ["skill_group", "playstyle_cluster"])


def cluster_sizes(clustered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Players per cluster."""
    return clustered.groupBy(*keys).agg(F.count(F.lit(1)).alias("players"))


def playstyle_stability(
    skill_clustered: DataFrame,
    skill_group: str | None = None,
    random_states: Sequence[int] | None = None,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    features: Sequence[str] | None = None,
    n_init: int = N_INIT,
    metric: str = "euclidean",
    starts: Starts | None = None,
    max_iter: int = MAX_ITER,
) -> tuple[DataFrame, DataFrame]:
    """Repeat K selection under several seeds and compare the outcomes per skill group.

    Returns the runs ``(skill_group, seed, k, silhouette, k_differs, ari)``, where ``ari`` is
    the agreement with the first seed's clusters when both chose the same K, and the summary
    ``(skill_group, most_common_k, most_common_count, runs, average_silhouette,
    silhouette_std)``; the smallest K wins a tied vote.
    """
    features = list(PLAYSTYLE_FEATURES if features is None else features)
    seeds = list(STABILITY_SEEDS if random_states is None else random_states)
    data = _in_group(skill_clustered, skill_group)
    sweep = sweep_k(
        data, features, "skill_group", k_min, k_max, seeds, n_init, metric, min_rows=3,
        starts=starts, max_iter=max_iter,
    )
    spark = skill_clustered.sparkSession
    best = {seed: sweep.best_models(seed) for seed in seeds}
    chosen = spark.createDataFrame(
        [
            (
                g, i, seed, model.k, sweep.silhouettes[(g, seed, model.k)][1],
                model.k != best[seeds[0]][g].k,
            )
            for i, seed in enumerate(seeds)
            for g, model in best[seed].items()
            if g in best[seeds[0]]
        ],
        "skill_group string, position int, seed int, k int, silhouette double, k_differs boolean",
    )
    groups = sorted(set.intersection(*[set(best[s]) for s in seeds]))
    labelled = assign_labelings(
        data, features, {g: [best[s][g] for s in seeds] for g in groups}, "_labels", "skill_group"
    )
    compared = labelled.select(
        "skill_group",
        F.col("_labels")[0].alias("_first"),
        F.posexplode("_labels").alias("position", "_label"),
    )
    agreement = adjusted_rand_index(compared, "_first", "_label", ["skill_group", "position"])
    runs = (
        chosen.join(agreement, ["skill_group", "position"], "left")
        .withColumn("ari", F.when(~F.col("k_differs") & (F.col("position") > 0), F.col("ari")))
        .select("skill_group", "seed", "k", "silhouette", "k_differs", "ari")
    )
    votes = chosen.groupBy("skill_group", "k").agg(F.count(F.lit(1)).alias("n"))
    vote = votes.groupBy("skill_group").agg(
        F.max(F.struct("n", (-F.col("k")).alias("smaller"))).alias("top")
    )
    summary = (
        chosen.groupBy("skill_group")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.avg("silhouette").alias("average_silhouette"),
            F.stddev_pop("silhouette").alias("silhouette_std"),
        )
        .join(vote, "skill_group")
        .select(
            "skill_group",
            (-F.col("top.smaller")).alias("most_common_k"),
            F.col("top.n").alias("most_common_count"),
            "runs",
            "average_silhouette",
            "silhouette_std",
        )
    )
    return runs, summary
