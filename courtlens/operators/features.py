"""Feature frames: selection, orientation, standardisation, skill adjustment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import finite_or_zero, nan_to_null, quoted, require_columns
from courtlens.operators.small_tables import join_small
from courtlens.schema import INVERTED_FEATURES, PLAYER, PLAYSTYLE_FEATURES, SKILL_FEATURES

# A spread below this is rounding noise (an exactly linear feature leaves residuals near
# 1e-17): the column is centred but not divided, so noise is not blown up to unit variance.
NO_SPREAD = 1e-12


# Style features that are not profile columns already: averages per minute and per winner, with
# the denominator at least 1 and a missing one kept missing.
_DERIVED = {
    "drop_usage_rate": "average_drop_attempts"
    " / if(average_match_duration IS NOT NULL, greatest(average_match_duration, 1D), NULL)",
    "error_to_winner_ratio": "average_unforced_errors"
    " / if(average_winners IS NOT NULL, greatest(average_winners, 1D), NULL)",
}


def skill_feature_columns() -> list[str]:
    """SQL of the ten skill features of a profile, with anything not finite set to 0."""
    return [f"{finite_or_zero(f)} AS {f}" for f in SKILL_FEATURES]


def playstyle_feature_columns() -> list[str]:
    """SQL of the thirteen style features of a profile, with anything not finite set to 0."""
    return [f"{finite_or_zero(_DERIVED.get(f, f))} AS {f}" for f in PLAYSTYLE_FEATURES]


def create_ml_features(profiles: DataFrame) -> DataFrame:
    """player_id and the ten skill features."""
    require_columns(profiles, SKILL_FEATURES, "The profiles lack these features: ")
    return profiles.selectExpr(PLAYER, *skill_feature_columns())


def prepare_for_ml(ml_features: DataFrame) -> DataFrame:
    """Flip the sign of features where lower is better (0 - x, so 0 never becomes -0)."""
    return ml_features.selectExpr(
        *[f"0D - {c} AS {c}" if c in INVERTED_FEATURES else quoted(c) for c in ml_features.columns]
    )


def standardize(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """z-scores with population statistics over all rows.

    Returns the frame with ``columns`` replaced, and the fitted parameters as
    ``(feature, mean, scale)``. One aggregate computes every mean and deviation and is inlined
    as a scalar subquery.
    """
    names = {c: quoted(c) for c in columns}
    df = nan_to_null(df, columns)
    each = [f"struct(avg({n}) AS mean, stddev_pop({n}) AS sd) AS {n}" for n in names.values()]
    fitted = df.agg(F.expr(f"struct({', '.join(each)}) AS _fitted"))

    def scale(n: str) -> str:
        return f"if(_fitted.{n}.sd < {NO_SPREAD}, 1D, _fitted.{n}.sd)"

    scaled = df.withColumn("_fitted", fitted.scalar()).selectExpr(
        *[
            f"({names[c]} - _fitted.{names[c]}.mean) / {scale(names[c])} AS {names[c]}"
            if c in names
            else quoted(c)
            for c in df.columns
        ]
    )
    parameters = ", ".join(
        f"struct('{c}' AS feature, _fitted.{n}.mean AS mean, {scale(n)} AS scale)"
        for c, n in names.items()
    )
    return scaled, fitted.selectExpr(f"inline(array({parameters}))")


def scale_ml_features(oriented: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standardise the ten oriented skill features; returns (scaled, scaler parameters)."""
    return standardize(oriented.select(PLAYER, *SKILL_FEATURES), SKILL_FEATURES)


def create_playstyle_features(profiles: DataFrame) -> DataFrame:
    """player_id and the thirteen style features."""
    return profiles.selectExpr(PLAYER, *playstyle_feature_columns())


def prepare_playstyle_features(playstyle_features: DataFrame) -> DataFrame:
    """Style features keep their natural direction; a hook for callers, nothing to do."""
    return playstyle_features


def residualize_playstyle_features(
    df: DataFrame,
    features_to_residualize: Sequence[str] | None = None,
    group_column: str = "skill_group",
    target_column: str = "skill_score",
) -> DataFrame:
    """Replace each feature by its residual from a per-group straight-line fit on the target.

    One aggregate fits all features of all groups from means and covariances (partial sums
    combine on the map side, so one group may hold most rows). The fitted lines are a small
    table joined back on the group. A group with fewer than three rows, or whose target does
    not vary, keeps its values; rows without a group become NULL.
    """
    features = list(PLAYSTYLE_FEATURES if features_to_residualize is None else features_to_residualize)
    df = nan_to_null(df, [target_column, *features])
    group, x = quoted(group_column), quoted(target_column)
    fit = f"count(*) >= 3 AND min({x}) < max({x}) AND var_pop({x}) > 0"
    slopes = [
        f"struct(avg({quoted(f)}) AS mean,"
        f" if({fit}, covar_pop({x}, {quoted(f)}) / var_pop({x}), 0D) AS slope) AS {quoted(f)}"
        for f in features
    ]
    lines = (
        df.filter(f"{group} IS NOT NULL")
        .groupBy(group_column)
        .agg(F.expr(f"struct({fit} AS fit, avg({x}) AS centre, {', '.join(slopes)}) AS _line"))
    )

    def residual(f: str) -> str:
        line = f"_line.{f}"
        return (
            f"CASE WHEN _line.fit"
            f" THEN {f} - ({line}.mean + {line}.slope * ({x} - _line.centre))"
            f" WHEN {group} IS NOT NULL THEN CAST({f} AS double) END AS {f}"
        )

    joined = join_small(df, lines, [group_column], how="left")
    return joined.selectExpr(
        *[residual(quoted(c)) if c in features else quoted(c) for c in df.columns]
    )


def scale_playstyle_features(playstyle_features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standardise the thirteen style features over all players, whatever their group."""
    return standardize(playstyle_features.select(PLAYER, *PLAYSTYLE_FEATURES), PLAYSTYLE_FEATURES)
