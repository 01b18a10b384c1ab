"""Input schemas, feature lists and the other named constants of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

PLAYER = "player_id"

MATCH_LOG_SCHEMA = T.StructType(
    [
        T.StructField("player_id", T.StringType()),
        T.StructField("match_id", T.StringType()),
        T.StructField("match_duration_mins", T.DoubleType()),
        T.StructField("drop_attempts", T.LongType()),
        T.StructField("drop_successes", T.LongType()),
        T.StructField("drive_attempts", T.LongType()),
        T.StructField("clean_winners", T.LongType()),
        T.StructField("dink_winners", T.LongType()),
        T.StructField("unforced_errors", T.LongType()),
        T.StructField("dink_errors", T.LongType()),
        T.StructField("uses_stacking", T.BooleanType()),
    ]
)

RATING_SCHEMA = T.StructType(
    [
        T.StructField("player_id", T.StringType()),
        T.StructField("rally_points", T.DoubleType()),
    ]
)

TRAITS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("feature", T.StringType()),
            T.StructField("family", T.StringType()),
            T.StructField("direction", T.StringType()),
            T.StructField("z", T.DoubleType()),
        ]
    )
)

# Per-match rate -> prefix of its `_mean` and `_std` profile columns.
RATE_PREFIXES = {
    "drop_efficiency": "drop_efficiency",
    "winner_rate_pm": "winner_rate",
    "general_error_rate_pm": "general_error_rate",
    "dink_error_rate_pm": "dink_error_rate",
    "aggression_rate": "aggression",
    "drop_preference_rate": "drop_preference_rate",
    "net_game_preference_rate": "net_game_preference_rate",
}

# ---- Fixed values: feature sets --------------------------------------------
# Order matters: it is the column order of every feature frame.

MEAN_FEATURES = [
    "winner_rate_mean",
    "general_error_rate_mean",
    "dink_error_rate_mean",
    "drop_efficiency_mean",
    "aggression_mean",
]

STD_FEATURES = [
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
    "drop_efficiency_std",
    "aggression_std",
]

SKILL_FEATURES = MEAN_FEATURES + STD_FEATURES

# Lower is better for these, so they are sign-flipped before scaling.
INVERTED_FEATURES = ["general_error_rate_mean", "dink_error_rate_mean"] + STD_FEATURES

PLAYSTYLE_FEATURES = [
    "aggression_mean",
    "aggression_std",
    "drop_efficiency_mean",
    "drop_efficiency_std",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
    "drop_usage_rate",
    "error_to_winner_ratio",
    "drop_preference_rate_mean",
    "drop_preference_rate_std",
    "net_game_preference_rate_mean",
    "net_game_preference_rate_std",
]

# ---- Fixed values: scoring --------------------------------------------------

SKILL_WEIGHTS = {
    "drop_efficiency_mean": 0.25,
    "winner_rate_mean": 0.30,
    "general_error_rate_mean": 0.20,
    "dink_error_rate_mean": 0.25,
}
# Metrics that count as one minus their normalised value.
SKILL_PENALTIES = {"general_error_rate_mean", "dink_error_rate_mean"}

INTERMEDIATE_FROM = 40
PROFESSIONAL_FROM = 75
SKILL_TIERS = ["Beginner", "Intermediate", "Professional"]

# ---- Fixed values: model selection ------------------------------------------

PLAYSTYLE_COMPONENT_SHARE = 0.80
K_MIN, K_MAX = 2, 5
DEFAULT_SEED = 42
STABILITY_SEEDS = [1, 7, 21, 42, 100]
N_INIT = 20
MAX_ITER = 300
