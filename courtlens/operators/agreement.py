"""Adjusted Rand index of two labelings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1.0) / 2.0


def adjusted_rand_index(
    df: DataFrame, left: str, right: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Pair-counting agreement of two label columns, per group.

    The players are folded to the contingency table in one aggregate with map-side partial
    counts; everything after works on its few cells. Two labelings without any pair to disagree
    on score 1.
    """
    keys = list(group_cols)
    cells = (
        df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
        .groupBy(*keys, F.col(left).alias("_left"), F.col(right).alias("_right"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Cell, row and column totals, told apart by the grouping id (bit set = column left out).
    counted = cells.groupingSets(
        [[*keys, "_left", "_right"], [*keys, "_left"], [*keys, "_right"]],
        *keys, "_left", "_right",
    ).agg(F.sum("_n").alias("_n"), F.grouping_id().alias("_set"))
    cell, left_total, right_total = 0, 1, 2

    def pairs_in(part: int) -> Column:
        return F.sum(F.when(F.col("_set") == part, _pairs(F.col("_n"))).otherwise(0.0))

    sums = counted.groupBy(*keys).agg(
        pairs_in(cell).alias("_both"),
        pairs_in(left_total).alias("_in_left"),
        pairs_in(right_total).alias("_in_right"),
        _pairs(F.sum(F.when(F.col("_set") == cell, F.col("_n")))).alias("_all"),
    )
    expected = F.when(
        F.col("_all") > 0, F.col("_in_left") * F.col("_in_right") / F.col("_all")
    ).otherwise(0.0)
    ceiling = (F.col("_in_left") + F.col("_in_right")) / 2.0
    spread = ceiling - expected
    return sums.select(
        *keys,
        F.when(spread == 0.0, F.lit(1.0))
        .otherwise((F.col("_both") - expected) / spread)
        .alias("ari"),
    )
