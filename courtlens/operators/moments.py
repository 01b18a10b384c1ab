"""Statistics as states that can be stored, merged and, for fits, taken back.

A state holds counts, means and sums of squared deviations. Two states of disjoint rows merge into
that of all rows (Chan, Golub and LeVeque 1979): the difference of the means carries what the
deviations cannot know of each other, so that nothing cancels, however far the values are from zero.

* Player states: per player, what the profile aggregates of any number of matches are made of. New
  matches are aggregated alone and merged; old ones are not read again. States are joined by player:
  stored as player tables of equal buckets (``sources.player_tables``) they need no shuffle.
* Fit states: per group, counts, means and co-moments of columns. Scaling parameters, residual lines
  and principal components follow from them, and rows that leave are subtracted.

Rows that miss a value of a column have no part in that column's player state, as in an average;
fit states are of rows that have all columns, as the feature frames here do. Minima and maxima merge,
but cannot be taken back: bounds of the skill score are no part of a fit state.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import nan_to_null, quoted
from courtlens.operators.components import Components, components_of
from courtlens.operators.features import NO_SPREAD
from courtlens.operators.points import ALL, group_key
from courtlens.operators.profiles import match_features
from courtlens.schema import PLAYER, PLAYSTYLE_COMPONENT_SHARE, RATE_PREFIXES

# Columns of a match whose deviations profiles ask for, and those of which the mean is enough.
SPREAD = list(RATE_PREFIXES)
AVERAGED = {
    "average_drop_attempts": "drop_attempts",
    "average_winners": "total_winners",
    "average_unforced_errors": "unforced_errors",
    "average_dink_errors": "dink_errors",
    "average_match_duration": "match_duration_mins",
    "stacking_rate": "uses_stacking",
}


# ---- players ----------------------------------------------------------------


def player_states(match_logs: DataFrame) -> DataFrame:
    """(player_id, match_count, a state (n, mean, m2) per column): one aggregate with partial sums."""
    rates = match_features(match_logs).filter(F.col(PLAYER).isNotNull())
    states = []
    for c in [*SPREAD, *AVERAGED.values()]:
        value = F.col(c).cast("double")
        mean = F.coalesce(F.avg(value), F.lit(0.0))
        n = F.count(value)
        m2 = F.coalesce(F.var_pop(value) * n, F.lit(0.0)) if c in SPREAD else F.lit(0.0)
        states.append(F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2")).alias(c))
    return rates.groupBy(PLAYER).agg(F.count("match_id").alias("match_count"), *states)


def _merged(a: Column, b: Column) -> Column:
    """State of the rows of two states; either may be missing."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = F.when(n > 0, b["n"] / n).otherwise(0.0)
    both = F.struct(
        n.alias("n"),
        # An empty state has mean 0, which must not count.
        F.when(a["n"] == 0, b["mean"]).when(b["n"] == 0, a["mean"]).otherwise(a["mean"] + apart * share).alias("mean"),
        (a["m2"] + b["m2"] + F.when((a["n"] > 0) & (b["n"] > 0), apart * apart * a["n"] * share).otherwise(0.0)).alias("m2"),
    )
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def merge_player_states(*states: DataFrame) -> DataFrame:
    """States of all matches of states whose matches are disjoint; players may be in any of them."""

    def two(left: DataFrame, right: DataFrame) -> DataFrame:
        a, b = left.alias("a"), right.alias("b")
        joined = a.join(b, F.col(f"a.{PLAYER}") == F.col(f"b.{PLAYER}"), "full_outer")
        count = F.coalesce("a.match_count", F.lit(0)) + F.coalesce("b.match_count", F.lit(0))
        return joined.select(
            F.coalesce(f"a.{PLAYER}", f"b.{PLAYER}").alias(PLAYER),
            count.cast("long").alias("match_count"),
            *[_merged(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in [*SPREAD, *AVERAGED.values()]],
        )

    return reduce(two, states)


def profiles_of_states(states: DataFrame) -> DataFrame:
    """The profiles that ``aggregate_player_profiles`` gives for the matches of the states."""

    def mean(c: str) -> Column:
        return F.when(F.col(c)["n"] > 0, F.col(c)["mean"])

    def spread(c: str) -> Column:
        n = F.col(c)["n"]
        return F.when(n > 1, F.sqrt(F.col(c)["m2"] / (n - 1))).otherwise(0.0)

    return states.select(
        PLAYER,
        *[mean(r).alias(f"{p}_mean") for r, p in RATE_PREFIXES.items()],
        *[spread(r).alias(f"{p}_std") for r, p in RATE_PREFIXES.items()],
        *[mean(c).alias(name) for name, c in AVERAGED.items()],
        "match_count",
    )


# ---- fits -------------------------------------------------------------------


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def fit_states(df: DataFrame, columns: Sequence[str], group_col: str | None = None) -> DataFrame:
    """(grp, columns, n, means, moments) over the rows that have all columns; rows without group go.

    ``moments`` has the sum of the products of deviations of every two columns, by rows of the upper
    triangle.
    """
    columns = list(columns)
    values = [F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    rows = nan_to_null(df, columns).select(group_key(group_col).alias("grp"), *values).dropna()
    pairs = _pairs(len(columns))
    n = F.count(F.lit(1))
    states = rows.groupBy("grp").agg(
        n.alias("n"),
        F.array(*[F.avg(f"c{i}") for i in range(len(columns))]).alias("means"),
        F.array(*[F.covar_pop(f"c{i}", f"c{j}") * n for i, j in pairs]).alias("moments"),
    )
    return states.select("grp", F.array(*map(F.lit, columns)).alias("columns"), "n", "means", "moments")


def _products(apart: Column, size: Column) -> Column:
    """Products of every two entries of an array of ``size`` entries, by rows of the upper triangle."""
    rows = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.transform(F.sequence(i, size), lambda j: F.element_at(apart, i) * F.element_at(apart, j)),
    )
    return F.flatten(rows)


def _together(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    a, b = a.alias("a"), b.alias("b")
    joined = a.join(b, F.col("a.grp") == F.col("b.grp"), how)
    other = F.col("a.columns") != F.col("b.columns")
    return joined.withColumn(
        "_checked", F.when(other, F.raise_error(F.lit("The states are of different columns."))).cast("boolean")
    )


def merge_fit_states(*states: DataFrame) -> DataFrame:
    """States of all rows of states whose rows are disjoint."""

    def two(left: DataFrame, right: DataFrame) -> DataFrame:
        joined = _together(left, right, "full_outer")
        a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
        n = a("n") + b("n")
        apart = F.zip_with(a("means"), b("means"), lambda x, y: y - x)
        means = F.zip_with(a("means"), apart, lambda x, d: x + d * b("n") / n)
        products = _products(apart, F.size(a("means")))
        moments = F.zip_with(
            F.zip_with(a("moments"), b("moments"), lambda x, y: x + y),
            products,
            lambda x, p: x + p * a("n") * b("n") / n,
        )

        def either(c: str, both: Column) -> Column:
            return F.when(a("grp").isNull(), b(c)).when(b("grp").isNull(), a(c)).otherwise(both).alias(c)

        return joined.filter("_checked IS NULL").select(
            F.coalesce(a("grp"), b("grp")).alias("grp"),
            F.coalesce(a("columns"), b("columns")).alias("columns"),
            either("n", n),
            either("means", means),
            either("moments", moments),
        )

    return reduce(two, states)


def take_back(whole: DataFrame, part: DataFrame) -> DataFrame:
    """States of the rows of ``whole`` that are not in ``part``; groups left without rows go."""
    joined = _together(whole, part, "left")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    n = a("n") - b("n")
    # The rest's mean lies on the other side of the whole's.
    means = F.zip_with(a("means"), b("means"), lambda x, y: x + (x - y) * b("n") / n)
    apart = F.zip_with(b("means"), means, lambda x, y: x - y)
    products = _products(apart, F.size(a("means")))
    moments = F.zip_with(
        F.zip_with(a("moments"), b("moments"), lambda x, y: x - y),
        products,
        lambda x, p: x - p * b("n") * n / a("n"),
    )

    def rest(c: str, both: Column) -> Column:
        return F.when(b("grp").isNull(), a(c)).otherwise(both).alias(c)

    left = joined.filter("_checked IS NULL").filter(b("grp").isNull() | (n > 0))
    return left.select(
        a("grp").alias("grp"), a("columns").alias("columns"), rest("n", n), rest("means", means), rest("moments", moments)
    )


def _deviation(i: Column) -> Column:
    """Population variance of the column at a place (from 0) of a state."""
    size = F.size("means")
    # Rows of the triangle before it have size, size - 1, ... entries.
    at = (i * size - (i * (i - 1)) / 2).cast("int")
    return F.greatest(F.get("moments", at) / F.col("n"), F.lit(0.0))


def scaler_of_states(states: DataFrame) -> DataFrame:
    """(feature, mean, scale) as ``standardize`` fits them; ``states`` is of one group."""
    each = states.select("n", "means", "moments", F.posexplode("columns").alias("at", "feature"))
    scale = F.sqrt(_deviation(F.col("at")))
    return each.select(
        "feature",
        F.get("means", "at").alias("mean"),
        F.when(scale < NO_SPREAD, 1.0).otherwise(scale).alias("scale"),
    )


def lines_of_states(states: DataFrame, target: str) -> DataFrame:
    """(grp, feature, slope, mean, centre): straight lines of every other column on ``target``.

    A group of fewer than three rows, or whose target does not vary, has no line.
    """
    place = F.array_position("columns", target).cast("int") - 1
    states = states.withColumn("_x", place).withColumn("_var", _deviation(place))
    each = states.select("*", F.posexplode("columns").alias("at", "feature")).filter(F.col("feature") != target)
    low, high = F.least("at", "_x"), F.greatest("at", "_x")
    size = F.size("means")
    cross = F.get("moments", (low * size - (low * (low - 1)) / 2 + high - low).cast("int"))
    return each.filter((F.col("n") >= 3) & (F.col("_var") > 0)).select(
        "grp",
        "feature",
        (cross / F.col("n") / F.col("_var")).alias("slope"),
        F.get("means", "at").alias("mean"),
        F.get("means", "_x").alias("centre"),
    )


def components_of_states(states: DataFrame, min_share: float = PLAYSTYLE_COMPONENT_SHARE) -> Components:
    """Principal components as ``fit_components`` fits them; ``states`` is of one group."""
    (state,) = states.filter(F.col("grp") == ALL).take(1) or states.take(1)
    size = len(state["columns"])
    matrix = np.zeros((size, size))
    for (i, j), value in zip(_pairs(size), state["moments"], strict=True):
        matrix[i, j] = matrix[j, i] = value / state["n"]
    return components_of(list(state["columns"]), np.array(state["means"]), matrix, min_share)
