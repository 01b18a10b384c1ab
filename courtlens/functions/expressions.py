"""Small Column builders: null-safe clamps, guarded ratios, rounding, distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in every floating-point column, or in those of ``columns``.

    Spark orders NaN above all numbers and lets it poison averages; NULL is skipped by
    aggregates and fails comparisons, which is the missing-value rule used here.
    """
    floating = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        and (columns is None or f.name in columns)
    }
    if not floating:
        return df
    return df.selectExpr(
        *[
            f"CASE WHEN NOT isnan({quoted(c)}) THEN {quoted(c)} END AS {quoted(c)}"
            if c in floating
            else quoted(c)
            for c in df.columns
        ]
    )


def at_least(value: Column, floor: float) -> Column:
    """max(value, floor), keeping NULL (plain ``greatest`` would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value.cast("double"), F.lit(float(floor))))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole where whole is positive, else 0; the guard wraps the division (ANSI)."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def quoted(name: str) -> str:
    """Column name for use in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def finite_or_zero(value: str) -> str:
    """SQL: 0.0 for NULL, NaN and infinities.

    Expressions repeated over many features are SQL text: one call to the JVM per feature
    instead of one per operator.
    """
    value = f"CAST({value} AS double)"
    return (
        f"CASE WHEN {value} IS NULL OR isnan({value}) OR abs({value}) = double('Infinity') "
        f"THEN 0D ELSE {value} END"
    )


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Binary half-even rounding: scale, ``rint``, unscale.

    ``round`` and ``bround`` work on the decimal text of the double and would lift
    39.995 to 40.0, a different tier.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two array<double> columns."""
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )


def nearest_index(point: Column, centres: Column) -> Column:
    """Position of the centre (array<array<double>>) nearest to the point; lowest wins ties."""
    distances = F.transform(centres, lambda c: squared_distance(point, c))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def feature_array(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def is_missing(name: str, df: DataFrame) -> Column:
    """NULL, or NaN where the column can hold it."""
    kind = df.schema[name].dataType
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if isinstance(kind, (T.DoubleType, T.FloatType)) else missing


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str], message: str) -> None:
    """Raise ValueError naming the columns that are missing from ``df``."""
    missing = missing_columns(df, columns)
    if missing:
        raise ValueError(message + ", ".join(missing))
