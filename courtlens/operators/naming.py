"""Names for skill groups and playstyle clusters.

Everything here works on one row per cluster. Only the centroids (partial averages) and the
final label joins touch the players.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from courtlens.functions.naming_rules import (
    DEVELOPING,
    FAMILIES,
    HIGHER,
    INTERMEDIATE,
    archetype_name,
    describe_name,
)
from courtlens.functions.expressions import is_missing, nan_to_null
from courtlens.operators.checks import check_one_to_one
from courtlens.operators.small_tables import BROADCAST_ROWS, join_small, local_frame
from courtlens.schema import PLAYER, PLAYSTYLE_FEATURES

STYLE_KEYS = ["skill_group", "playstyle_cluster"]
# Names of few clusters, lowest first; others are numbered.
_FEW = {2: [DEVELOPING, HIGHER], 3: [DEVELOPING, INTERMEDIATE, HIGHER]}
_INCOMPLETE = "Some players have no '{}', so the averages that order the skill clusters would not be theirs."


def interpret_skill_clusters(skill_clustered: DataFrame, rank_by: str = "skill_score") -> DataFrame:
    """(skill_cluster, skill_group): clusters named by ascending average of ``rank_by``.

    Equal averages are ordered by cluster id.
    """
    if rank_by not in skill_clustered.columns:
        raise ValueError(
            f"Skill clusters are named in the order of a rating, but there is no column '{rank_by}'."
        )
    averages = skill_clustered.groupBy("skill_cluster").agg(
        F.avg(rank_by).alias("average"), F.count_if(is_missing(rank_by, skill_clustered)).alias("missing")
    )
    # The check and the averages share the pass. Few clusters come back; many are ranked in Spark.
    head = averages.limit(BROADCAST_ROWS + 1).toArrow()
    if head.num_rows > BROADCAST_ROWS:
        return rank_skill_clusters(skill_clustered, rank_by)
    if any(head.column("missing").to_pylist()):
        raise ValueError(_INCOMPLETE.format(rank_by))
    ranked = sorted(
        (r["average"], r["skill_cluster"]) for r in head.to_pylist() if r["skill_cluster"] is not None
    )
    numbered = [f"Performance Group {i + 1}" for i in range(len(ranked))]
    names = _FEW.get(len(ranked), numbered)
    kind = skill_clustered.schema["skill_cluster"].dataType.simpleString()
    return local_frame(
        skill_clustered.sparkSession,
        [(cluster, name) for (_, cluster), name in zip(ranked, names)],
        f"skill_cluster {kind}, skill_group string",
    )


def rank_skill_clusters(skill_clustered: DataFrame, rank_by: str = "skill_score") -> DataFrame:
    """As ``interpret_skill_clusters``, without a job: whoever reads the names runs the check, too.

    Averages are sorted in ranges; a rank is the place in its range after the counts of those before.
    """
    averages = (
        skill_clustered.groupBy("skill_cluster")
        .agg(F.avg(rank_by).alias("average"), F.count_if(is_missing(rank_by, skill_clustered)).alias("missing"))
        .withColumn(
            "missing",
            F.when(F.col("missing") > 0, F.raise_error(F.lit(_INCOMPLETE.format(rank_by))).cast("long")).otherwise(0),
        )
        .filter((F.col("missing") == 0) & F.col("skill_cluster").isNotNull())
    )
    ranges = averages.repartitionByRange("average", "skill_cluster").withColumn("_range", F.spark_partition_id())
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("_range", "_n"))).alias("counts"), F.sum("_n").alias("clusters")
    )
    known = ranges.withColumn("_all", totals.select(F.struct("counts", "clusters")).scalar())
    before = F.aggregate(
        F.map_values(F.map_filter(F.col("_all.counts"), lambda r, _: r < F.col("_range"))),
        F.lit(0).cast("long"),
        lambda x, n: x + n,
    )
    inside = F.row_number().over(W.partitionBy("_range").orderBy("average", "skill_cluster"))
    ranked = known.withColumn("_rank", before + inside)
    name = F.concat(F.lit("Performance Group "), F.col("_rank").cast("string"))
    for number, names in _FEW.items():
        few = F.element_at(F.array(*map(F.lit, names)), F.least("_rank", F.lit(number)).cast("int"))
        name = F.when(F.col("_all.clusters") == number, few).otherwise(name)
    return ranked.select("skill_cluster", name.alias("skill_group"))


def apply_skill_cluster_labels(skill_clustered: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``skill_group``; clusters without a label get NULL."""
    return join_small(skill_clustered, labels, ["skill_cluster"], how="left").select(
        *skill_clustered.columns, "skill_group"
    )


def playstyle_centroids(
    clustered: DataFrame, raw_playstyle_features: DataFrame, keys: Sequence[str] = STYLE_KEYS
) -> DataFrame:
    """Mean of the thirteen raw style features per cluster, in ordinary units."""
    check_one_to_one(
        clustered, raw_playstyle_features, PLAYER,
        left_repeats="A player occurs twice among the clustered players.",
        right_repeats="A player occurs twice in the raw style features.",
    )
    raw = nan_to_null(raw_playstyle_features.select(PLAYER, *PLAYSTYLE_FEATURES))
    merged = clustered.select(PLAYER, *keys).join(raw, PLAYER, "left")
    return merged.groupBy(*keys).agg(*[F.avg(f).alias(f) for f in PLAYSTYLE_FEATURES])


def scaled_centroids(clustered: DataFrame, keys: Sequence[str] = STYLE_KEYS) -> DataFrame:
    """Mean z-score of the thirteen style features per cluster; what names are read from."""
    known = nan_to_null(clustered.select(*keys, *PLAYSTYLE_FEATURES))
    return known.groupBy(*keys).agg(*[F.avg(f).alias(f) for f in PLAYSTYLE_FEATURES])


def name_playstyles(centroids: DataFrame, max_traits: int = FAMILIES) -> DataFrame:
    """(skill_group, playstyle_cluster, playstyle_archetype, playstyle_traits).

    A name takes at most one adjective per family, so asking for more could not tell clusters
    apart; clusters of a group that still share a name are numbered in cluster order, the first
    keeping the bare name.
    """
    named = centroids.select(
        *STYLE_KEYS, describe_name(max_traits).alias("playstyle_traits")
    ).withColumn("_name", archetype_name(F.col("skill_group"), F.col("playstyle_traits")))
    occurrence = F.row_number().over(
        W.partitionBy("skill_group", "_name").orderBy("playstyle_cluster")
    )
    return named.withColumn("_nth", occurrence).select(
        *STYLE_KEYS,
        F.when(F.col("_nth") == 1, F.col("_name"))
        .otherwise(F.concat("_name", F.lit(" Type "), F.col("_nth").cast("string")))
        .alias("playstyle_archetype"),
        "playstyle_traits",
    )


def interpret_playstyle_clusters(
    clustered: DataFrame, raw_playstyle_features: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(archetypes with evidence, raw centroids, scaled centroids) for all skill groups."""
    scaled = scaled_centroids(clustered.filter(F.col("skill_group").isNotNull()))
    return name_playstyles(scaled), playstyle_centroids(clustered, raw_playstyle_features), scaled


def apply_playstyle_archetypes(
    clustered: DataFrame, archetypes: DataFrame, with_traits: bool = False
) -> DataFrame:
    """Add ``playstyle_archetype`` and, if asked, its evidence as ``playstyle_traits``."""
    added = ["playstyle_archetype"] + (["playstyle_traits"] if with_traits else [])
    return join_small(
        clustered, archetypes.select(*STYLE_KEYS, *added), STYLE_KEYS, how="left"
    ).select(*clustered.columns, *added)
