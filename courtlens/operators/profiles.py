"""Match logs to one profile row per player."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.functions.expressions import at_least, nan_to_null, ratio_or_zero
from courtlens.schema import PLAYER, RATE_PREFIXES


def match_features(match_logs: DataFrame) -> DataFrame:
    """Per-match rates: one projection, no shuffle.

    Durations under a minute count as one minute; a missing duration leaves the per-minute
    rates missing. Shares with nothing in the denominator are 0.
    """
    minutes = at_least(F.col("match_duration_mins"), 1.0)
    drops, drives = F.col("drop_attempts"), F.col("drive_attempts")
    winners = F.col("clean_winners") + F.col("dink_winners")
    errors = F.col("unforced_errors")
    return nan_to_null(match_logs).select(
        PLAYER,
        "match_id",
        "match_duration_mins",
        "drop_attempts",
        "unforced_errors",
        "dink_errors",
        "uses_stacking",
        winners.alias("total_winners"),
        ratio_or_zero(F.col("drop_successes"), drops).alias("drop_efficiency"),
        (winners / minutes).alias("winner_rate_pm"),
        (errors / minutes).alias("general_error_rate_pm"),
        (F.col("dink_errors") / minutes).alias("dink_error_rate_pm"),
        ratio_or_zero(winners, winners + errors).alias("aggression_rate"),
        ratio_or_zero(drops, drops + drives).alias("drop_preference_rate"),
        ratio_or_zero(F.col("dink_winners"), winners).alias("net_game_preference_rate"),
    )


def aggregate_player_profiles(match_logs: DataFrame) -> DataFrame:
    """Means, sample standard deviations and averages per player, in one shuffle.

    Every aggregate has a partial form, so a player holding a large share of all matches is
    folded on the map side and only one small buffer per task crosses the network.
    """
    rates = match_features(match_logs).filter(F.col(PLAYER).isNotNull())
    means = [F.avg(r).alias(f"{p}_mean") for r, p in RATE_PREFIXES.items()]
    # One usable match has no spread: NULL becomes 0.
    spreads = [
        F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias(f"{p}_std") for r, p in RATE_PREFIXES.items()
    ]
    return rates.groupBy(PLAYER).agg(
        *means,
        *spreads,
        F.avg("drop_attempts").alias("average_drop_attempts"),
        F.avg("total_winners").alias("average_winners"),
        F.avg("unforced_errors").alias("average_unforced_errors"),
        F.avg("dink_errors").alias("average_dink_errors"),
        F.avg("match_duration_mins").alias("average_match_duration"),
        F.avg(F.col("uses_stacking").cast("double")).alias("stacking_rate"),
        F.count("match_id").alias("match_count"),
    )
