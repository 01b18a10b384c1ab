"""Report tables. Each is one aggregate or a top-n; a report on features is one global aggregate
whose single row is turned into one row per feature, so players are never multiplied out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import quoted
from courtlens.operators.naming import STYLE_KEYS
from courtlens.operators.small_tables import join_small
from courtlens.schema import (
    INVERTED_FEATURES,
    MEAN_FEATURES,
    PLAYER,
    PLAYSTYLE_FEATURES,
    SKILL_FEATURES,
    SKILL_TIERS,
    SKILL_WEIGHTS,
)

# Columns of the example, evidence and final reports.
DIRECTION_FEATURES = [
    "winner_rate_mean",
    "general_error_rate_mean",
    "dink_error_rate_mean",
    "drop_efficiency_mean",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
]
EVIDENCE_FEATURES = [
    "aggression_mean",
    "drop_efficiency_mean",
    "drop_usage_rate",
    "error_to_winner_ratio",
    "aggression_std",
    "drop_efficiency_std",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
    "drop_preference_rate_mean",
    "net_game_preference_rate_mean",
]
FINAL_REPORT_FEATURES = [
    "aggression_mean",
    "drop_efficiency_mean",
    "drop_usage_rate",
    "error_to_winner_ratio",
    "drop_preference_rate_mean",
    "net_game_preference_rate_mean",
    "aggression_std",
    "general_error_rate_std",
    "dink_error_rate_std",
]


def _one_row_per_feature(
    df: DataFrame, features: Sequence[str], statistics: dict[str, str]
) -> DataFrame:
    """(feature, <statistic>...) from one global aggregate; statistics are SQL function names."""
    rows = [
        f"struct('{f}' AS feature, "
        + ", ".join(f"{fn}({quoted(f)}) AS {name}" for name, fn in statistics.items())
        + ")"
        for f in features
    ]
    return df.agg(F.expr(f"array({', '.join(rows)}) AS rows")).selectExpr("inline(rows)")


def _first_players(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    return df.select(*columns).orderBy(PLAYER).limit(n)


def feature_information(ml_features: DataFrame) -> DataFrame:
    """(feature, kind, players): MEAN or CONSISTENCY per feature."""
    features = [c for c in ml_features.columns if c in SKILL_FEATURES]
    kind = F.when(F.col("feature").isin(MEAN_FEATURES), "MEAN").otherwise("CONSISTENCY")
    # Features of an ML frame are never missing, so counting one counts players.
    counted = _one_row_per_feature(ml_features, features, {"players": "count"})
    return counted.select("feature", kind.alias("kind"), "players")


def feature_summary(ml_features: DataFrame) -> DataFrame:
    """(feature, mean, std, min, max); std is the sample standard deviation."""
    features = [c for c in ml_features.columns if c != PLAYER]
    return _one_row_per_feature(
        ml_features, features,
        {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"},
    )


def scaling_summary(scaled: DataFrame) -> DataFrame:
    """(feature, mean, std) after scaling."""
    features = [c for c in scaled.columns if c != PLAYER]
    return _one_row_per_feature(scaled, features, {"mean": "avg", "std": "stddev_samp"})


def feature_directions(ml_features: DataFrame, oriented: DataFrame) -> DataFrame:
    """(player_id, feature, original, oriented) of the first player."""
    first = _first_players(ml_features, [PLAYER, *DIRECTION_FEATURES], 1)
    other = oriented.select(PLAYER, F.struct(*DIRECTION_FEATURES).alias("_oriented"))
    # One row, so broadcasting it is safe.
    both = other.join(F.broadcast(first), PLAYER)
    return both.select(
        PLAYER,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("feature"),
                        F.col(f).alias("original"),
                        F.col("_oriented")[f].alias("oriented"),
                    )
                    for f in DIRECTION_FEATURES
                ]
            )
        ),
    )


def skill_summary(scored: DataFrame) -> DataFrame:
    """(players, average, minimum, maximum) of the skill score."""
    return scored.agg(
        F.count(F.lit(1)).alias("players"),
        F.avg("skill_score").alias("average_skill_score"),
        F.min("skill_score").alias("minimum_skill_score"),
        F.max("skill_score").alias("maximum_skill_score"),
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    """(skill_tier, players) for every tier, 0 where nobody is."""
    counted = scored.agg(*[F.count_if(F.col("skill_tier") == t).alias(t) for t in SKILL_TIERS])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(t).alias("skill_tier"), F.col(t).alias("players"))
                    for t in SKILL_TIERS
                ]
            )
        )
    )


def skill_profile_samples(scored: DataFrame, n: int = 10) -> DataFrame:
    return _first_players(scored, [PLAYER, "skill_score", "skill_tier", *SKILL_WEIGHTS], n)


def clustering_input_summary(clustering_data: DataFrame) -> DataFrame:
    """(players, features, feature_names) of what K-Means is given."""
    return clustering_data.agg(F.count(F.lit(1)).alias("players")).select(
        "players",
        F.lit(len(SKILL_FEATURES)).alias("features"),
        F.array(*[F.lit(f) for f in SKILL_FEATURES]).alias("feature_names"),
    )


def clustering_samples(clustering_data: DataFrame, n: int = 5) -> DataFrame:
    return _first_players(clustering_data, [PLAYER, "skill_score", *SKILL_FEATURES], n)


def skill_cluster_profiles(skill_clustered: DataFrame, scaler: DataFrame) -> DataFrame:
    """Players, average score and the ten features in original units and direction, per cluster.

    Averages of scaled features are scaled back with the fitted parameters (one row per
    feature), so the original frame is not joined in again.
    """
    fitted = {r["feature"]: r for r in scaler.select("feature", "mean", "scale").collect()}

    def original(f: str) -> Column:
        value = F.avg(f) * F.lit(fitted[f]["scale"]) + F.lit(fitted[f]["mean"])
        return (F.lit(0.0) - value if f in INVERTED_FEATURES else value).alias(f)

    return skill_clustered.groupBy("skill_cluster").agg(
        F.count(F.lit(1)).alias("players"),
        F.avg("skill_score").alias("average_skill_score"),
        *[original(f) for f in SKILL_FEATURES],
    )


def skill_group_summary(grouped: DataFrame) -> DataFrame:
    """Players and average, lowest and highest score per skill group."""
    return (
        grouped.filter(F.col("skill_group").isNotNull())
        .groupBy("skill_cluster", "skill_group")
        .agg(
            F.count(PLAYER).alias("players"),
            F.avg("skill_score").alias("average_skill_score"),
            F.min("skill_score").alias("minimum_skill_score"),
            F.max("skill_score").alias("maximum_skill_score"),
        )
    )


def _style_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy(*STYLE_KEYS).agg(
        F.count(F.lit(1)).alias("players"), F.avg("skill_score").alias("average_skill_score")
    )


def playstyle_cluster_profiles(clustered: DataFrame, centroids: DataFrame) -> DataFrame:
    """Players, average score and the thirteen raw feature averages per playstyle cluster."""
    return join_small(_style_sizes(clustered), centroids, STYLE_KEYS).select(
        *STYLE_KEYS, "players", "average_skill_score", *PLAYSTYLE_FEATURES
    )


def archetype_summary(clustered: DataFrame, archetypes: DataFrame) -> DataFrame:
    """Archetype, players and average score per playstyle cluster."""
    return join_small(_style_sizes(clustered), archetypes, STYLE_KEYS).select(
        *STYLE_KEYS, "playstyle_archetype", "players", "average_skill_score"
    )


def archetype_evidence(archetypes: DataFrame, centroids: DataFrame) -> DataFrame:
    """Archetype and the eleven raw averages that support it."""
    return join_small(centroids, archetypes, STYLE_KEYS).select(
        *STYLE_KEYS, "playstyle_archetype", *EVIDENCE_FEATURES
    )


def final_profile_samples(final_profiles: DataFrame, n: int = 20) -> DataFrame:
    columns = [
        PLAYER, "skill_score", "skill_group", "skill_cluster", "playstyle_cluster",
        "playstyle_archetype", *FINAL_REPORT_FEATURES,
    ]
    return _first_players(final_profiles, columns, n)
