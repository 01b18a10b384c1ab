"""Applying parameters fitted on some players to others.

Every fit of the library returns or accepts its parameters as a small DataFrame; the functions
here turn such a frame into a projection on new rows. Parameters are inlined as a scalar subquery
(one row for all features) or joined on the group, so new players are neither shuffled nor
refitted, and a player scored alone gets the same values as among others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import (
    feature_array,
    nan_to_null,
    nearest_index,
    quoted,
    round_half_even,
)
from courtlens.operators.small_tables import join_small
from courtlens.schema import PLAYSTYLE_FEATURES, SKILL_PENALTIES, SKILL_WEIGHTS


def _by_feature(parameters: DataFrame, key: str, *values: str) -> Column:
    """Map from feature to a struct of values, as one scalar subquery."""
    entry = F.struct(F.col(key), F.struct(*values))
    return parameters.agg(F.map_from_entries(F.collect_list(entry)).alias("by_feature")).scalar()


def skill_bounds(profiles: DataFrame) -> DataFrame:
    """(metric, low, high) of the four scored metrics."""
    metrics = list(SKILL_WEIGHTS)
    each = [
        f"struct('{m}' AS metric, min({quoted(m)}) AS low, max({quoted(m)}) AS high)" for m in metrics
    ]
    known = nan_to_null(profiles, metrics)
    return known.agg(F.expr(f"array({', '.join(each)}) AS bounds")).selectExpr("inline(bounds)")


def apply_skill_bounds(profiles: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add ``skill_score`` under given bounds; it leaves 0..100 for metrics beyond them."""
    rows = nan_to_null(profiles, list(SKILL_WEIGHTS))
    rows = rows.withColumn("_bounds", _by_feature(bounds, "metric", "low", "high"))

    def term(metric: str) -> Column:
        low, high = (F.col("_bounds")[metric][end] for end in ("low", "high"))
        value = F.when(low == high, F.lit(0.5)).otherwise((F.col(metric) - low) / (high - low))
        if metric in SKILL_PENALTIES:
            value = F.lit(1.0) - value
        return value * F.lit(SKILL_WEIGHTS[metric])

    total = reduce(add, [term(m) for m in SKILL_WEIGHTS])
    return rows.withColumn("skill_score", round_half_even(total * 100.0)).drop("_bounds")


def apply_scaler(df: DataFrame, parameters: DataFrame, features: Sequence[str]) -> DataFrame:
    """z-scores of ``features`` under the ``(feature, mean, scale)`` that a scaling step returned."""
    rows = nan_to_null(df, features)
    rows = rows.withColumn("_fitted", _by_feature(parameters, "feature", "mean", "scale"))
    scaled = {f: (F.col(f) - F.col("_fitted")[f]["mean"]) / F.col("_fitted")[f]["scale"] for f in features}
    return rows.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def residual_lines(
    df: DataFrame,
    features: Sequence[str] = PLAYSTYLE_FEATURES,
    group_column: str = "skill_group",
    target_column: str = "skill_score",
) -> DataFrame:
    """(group, fitted, centre, lines): the line of every feature on the target, per group.

    ``lines`` maps a feature to (mean, slope). A group with fewer than three rows or without spread
    in the target is not fitted.
    """
    x = quoted(target_column)
    fit = f"count(*) >= 3 AND min({x}) < max({x}) AND var_pop({x}) > 0"
    lines = ", ".join(
        f"'{f}', struct(avg({quoted(f)}) AS mean,"
        f" if({fit}, covar_pop({x}, {quoted(f)}) / var_pop({x}), 0D) AS slope)"
        for f in features
    )
    return (
        nan_to_null(df, [target_column, *features])
        .filter(F.col(group_column).isNotNull())
        .groupBy(group_column)
        .agg(F.expr(f"{fit} AS fitted"), F.expr(f"avg({x}) AS centre"), F.expr(f"map({lines}) AS lines"))
    )


def apply_residual_lines(
    df: DataFrame,
    lines: DataFrame,
    features: Sequence[str] = PLAYSTYLE_FEATURES,
    group_column: str = "skill_group",
    target_column: str = "skill_score",
) -> DataFrame:
    """Residuals from given lines. Groups not fitted keep their values, unknown ones get NULL."""
    joined = join_small(nan_to_null(df, [target_column, *features]), lines, [group_column], "left")

    def residual(f: str) -> Column:
        line = F.col("lines")[f]
        away = F.col(f) - (line["mean"] + line["slope"] * (F.col(target_column) - F.col("centre")))
        return F.when(F.col("fitted"), away).when(~F.col("fitted"), F.col(f).cast("double")).alias(f)

    return joined.select(*[residual(c) if c in features else F.col(c) for c in df.columns])


def apply_loadings(df: DataFrame, loadings: DataFrame) -> DataFrame:
    """Add ``components``, the scores under the loadings that ``extract_playstyle_components`` gave.

    The array is in component order, however many components there are.
    """
    entry = F.struct("component", F.map_from_entries(F.collect_list(F.struct("feature", F.struct("loading", "mean")))).alias("by"))
    kept = loadings.groupBy("component").agg(entry.alias("entry"))
    table = kept.agg(F.array_sort(F.collect_list(F.struct("entry.component", F.map_entries("entry.by").alias("weights")))).alias("t"))
    values = F.create_map(*[x for f in PLAYSTYLE_FEATURES for x in (F.lit(f), F.col(f))])
    rows = nan_to_null(df, PLAYSTYLE_FEATURES).withColumn("_table", table.scalar())

    def score(component: Column) -> Column:
        return F.aggregate(
            component["weights"],
            F.lit(0.0),
            lambda total, w: total + (values[w["key"]] - w["value"]["mean"]) * w["value"]["loading"],
        )

    return rows.withColumn("components", F.transform("_table", score)).drop("_table")


def apply_centres(
    df: DataFrame,
    centres: DataFrame,
    features: Sequence[str],
    output: str,
    group_col: str | None = None,
) -> DataFrame:
    """Add the number of the nearest of the group's centres, rows ``(grp, cluster, features)``.

    One model per group is expected: filter a sweep's centres by k and seed first.
    """
    table = centres.groupBy("grp").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("cluster", F.array(*features).alias("at")))),
            lambda c: c["at"],
        ).alias("_centres")
    )
    key = F.lit("all") if group_col is None else F.col(group_col).cast("string")
    joined = join_small(df.withColumn("grp", key), table, ["grp"], "left")
    return joined.select(*df.columns, nearest_index(feature_array(features), F.col("_centres")).alias(output))
