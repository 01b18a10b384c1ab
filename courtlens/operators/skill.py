"""The 0-100 skill score and its tiers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import (
    is_missing,
    nan_to_null,
    require_columns,
    round_half_even,
)
from courtlens.schema import (
    INTERMEDIATE_FROM,
    PROFESSIONAL_FROM,
    SKILL_PENALTIES,
    SKILL_TIERS,
    SKILL_WEIGHTS,
)


def min_max_bounds(df: DataFrame, columns: list[str]) -> Column:
    """Minimum and maximum of every column as one scalar-subquery struct.

    A single one-row aggregate serves all columns and is inlined as a value: no join and no
    global window. Read a bound as ``bounds[column]["lo"]``.
    """
    return df.agg(
        F.struct(
            *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
        ).alias("bounds")
    ).scalar()


def min_max_normalize(value: Column, bounds: Column) -> Column:
    """Map to 0..1; a column without spread is 0.5 in every row, missing rows included."""
    low, high = bounds["lo"], bounds["hi"]
    return F.when(low == high, F.lit(0.5)).otherwise((value - low) / (high - low))


def calculate_skill_score(profiles: DataFrame) -> DataFrame:
    """Add ``skill_score``: weighted sum of the four normalised metrics, 2 decimals.

    A NaN metric is missing: it takes no part in the bounds, and its row has no score.
    """
    metrics = list(SKILL_WEIGHTS)
    require_columns(profiles, metrics, "The skill score needs these columns: ")
    profiles = nan_to_null(profiles, metrics)
    bounded = profiles.withColumn("_bounds", min_max_bounds(profiles, metrics))

    def term(metric: str) -> Column:
        value = min_max_normalize(F.col(metric), F.col("_bounds")[metric])
        if metric in SKILL_PENALTIES:
            value = F.lit(1.0) - value
        return value * F.lit(SKILL_WEIGHTS[metric])

    total = reduce(add, [term(m) for m in metrics])
    return bounded.withColumn("skill_score", round_half_even(total * 100.0)).drop("_bounds")


def assign_skill_tier(profiles: DataFrame) -> DataFrame:
    """Add ``skill_tier`` from the rounded score; a missing score counts as the lowest tier.

    NaN is missing too; Spark would order it above every number.
    """
    beginner, intermediate, professional = SKILL_TIERS
    score = F.when(~is_missing("skill_score", profiles), F.col("skill_score"))
    return profiles.withColumn(
        "skill_tier",
        F.when(score >= PROFESSIONAL_FROM, professional)
        .when(score >= INTERMEDIATE_FROM, intermediate)
        .otherwise(beginner),
    )


def build_skill_model(profiles: DataFrame) -> DataFrame:
    """Score, then tier."""
    return profiles.transform(calculate_skill_score).transform(assign_skill_tier)
