import math

import pytest
from pyspark.sql import functions as F

from courtlens.functions.expressions import nan_to_null, round_half_even
from courtlens.operators.profiles import aggregate_player_profiles, match_features
from courtlens.operators.skill import (
    assign_skill_tier,
    build_skill_model,
    calculate_skill_score,
)
from courtlens.operators.summaries import skill_summary, tier_counts
from courtlens.schema import RATE_PREFIXES
from courtlens.sources import read_match_logs

RATES = {
    "m1": (0.9, 0.9, 0.05, 0, 0.947368, 0.833333, 0.333333),
    "m2": (1, 0.933333, 0.066667, 0.033333, 0.933333, 1, 0.285714),
    "m3": (0, 1, 3, 1, 0.25, 0, 0),
    "m4": (0.375, 0.2, 0.36, 0.16, 0.357143, 0.5, 0.2),
    "m5": (0.333333, 0, 0, 0.133333, 0, 0.6, 0),
    "m6": (0, 0.277778, 0.277778, 0, 0.5, 0, 0),
    "m7": (0.25, None, None, None, 0.666667, 0.5, 0.5),
}
MEANS = {
    "p1": (0.95, 0.916667, 0.058333, 0.016667, 0.940351, 0.916667, 0.309524),
    "p2": (0.1875, 0.6, 1.68, 0.58, 0.303571, 0.25, 0.1),
    "p3": (0.333333, 0, 0, 0.133333, 0, 0.6, 0),
    "p4": (0.125, 0.277778, 0.277778, 0, 0.583333, 0.25, 0.25),
}
STDS = {
    "p1": (0.070711, 0.023570, 0.011785, 0.023570, 0.009924, 0.117851, 0.033672),
    "p2": (0.265165, 0.565685, 1.866762, 0.593970, 0.075761, 0.353553, 0.141421),
    "p3": (0, 0, 0, 0, 0, 0, 0),
    "p4": (0.176777, 0, 0, 0, 0.117851, 0.353553, 0.353553),
}


def close(got, want):
    for g, w in zip(got, want):
        assert (g is None) == (w is None)
        if w is not None:
            assert g == pytest.approx(w, abs=2e-6)


def test_match_rates(micro_logs):
    for row in match_features(micro_logs).collect():
        close([row[r] for r in RATE_PREFIXES], RATES[row.match_id])


def test_profiles(micro_logs):
    rows = {r.player_id: r for r in aggregate_player_profiles(micro_logs).collect()}
    assert set(rows) == set(MEANS)
    for player, row in rows.items():
        close([row[f"{p}_mean"] for p in RATE_PREFIXES.values()], MEANS[player])
        close([row[f"{p}_std"] for p in RATE_PREFIXES.values()], STDS[player])
    assert rows["p4"].average_match_duration == 18.0
    assert rows["p1"].average_winners == 23.0
    assert [rows[p].match_count for p in sorted(rows)] == [2, 2, 1, 2]
    assert [rows[p].stacking_rate for p in sorted(rows)] == [0.5, 0.5, 0.0, 0.5]


def test_null_players_are_dropped_and_null_matches_not_counted(spark, micro_logs):
    extra = micro_logs.filter("match_id = 'm1'").withColumn("player_id", F.lit(None).cast("string"))
    unnamed = micro_logs.filter("match_id = 'm5'").withColumn("match_id", F.lit(None).cast("string"))
    rows = {
        r.player_id: r
        for r in aggregate_player_profiles(micro_logs.union(extra).union(unnamed)).collect()
    }
    assert None not in rows and rows["p3"].match_count == 1


def test_nan_is_missing(spark, micro_logs):
    with_nan = micro_logs.withColumn(
        "match_duration_mins", F.coalesce("match_duration_mins", F.lit(float("nan")))
    )
    want = {r.player_id: r for r in aggregate_player_profiles(micro_logs).collect()}
    for row in aggregate_player_profiles(with_nan).collect():
        assert row == want[row.player_id]
    assert nan_to_null(with_nan).filter("match_duration_mins is null").count() == 1


def test_scores_and_tiers(micro_logs):
    rows = {r.player_id: r for r in build_skill_model(aggregate_player_profiles(micro_logs)).collect()}
    assert {p: (r.skill_score, r.skill_tier) for p, r in rows.items()} == {
        "p1": (98.59, "Professional"),
        "p2": (21.53, "Beginner"),
        "p3": (45.57, "Intermediate"),
        "p4": (50.78, "Intermediate"),
    }


def test_rounding_keeps_tier_borders(spark):
    cases = {
        39.995: 39.99, 40.005: 40.01, 62.345: 62.34, 0.125: 0.12,
        2.675: 2.68, 0.135: 0.14, 1.005: 1.0, 74.995: 75.0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    got = {r.x: r.y for r in df.select("x", round_half_even(F.col("x")).alias("y")).collect()}
    assert got == cases


def test_tier_borders_and_missing_score(spark):
    df = spark.createDataFrame([(39.99,), (40.0,), (74.99,), (75.0,), (None,)], "skill_score double")
    got = [r.skill_tier for r in assign_skill_tier(df).collect()]
    assert got == ["Beginner", "Intermediate", "Intermediate", "Professional", "Beginner"]


def test_constant_metric_is_half_for_everyone(spark):
    df = spark.createDataFrame(
        [("a", 0.2, 1.0, 0.5, 0.1), ("b", 0.8, 1.0, 0.1, 0.3), ("c", 0.5, None, 0.2, 0.2)],
        "player_id string, drop_efficiency_mean double, winner_rate_mean double, "
        "general_error_rate_mean double, dink_error_rate_mean double",
    )
    rows = {r.player_id: r.skill_score for r in calculate_skill_score(df).collect()}
    assert rows["a"] == pytest.approx(0 + 15 + 0 + 25)
    assert rows["b"] == pytest.approx(25 + 15 + 20 + 0)
    assert rows["c"] is not None  # a missing value of a constant column is 0.5 as well


def test_missing_metric_gives_missing_score(spark):
    df = spark.createDataFrame(
        [("a", 0.2, 1.0, 0.5, 0.1), ("b", None, 2.0, 0.1, 0.3), ("c", 0.5, 1.5, 0.2, 0.2)],
        "player_id string, drop_efficiency_mean double, winner_rate_mean double, "
        "general_error_rate_mean double, dink_error_rate_mean double",
    )
    rows = {r.player_id: r for r in build_skill_model(df).collect()}
    assert rows["b"].skill_score is None and rows["b"].skill_tier == "Beginner"


def test_missing_score_columns(spark):
    with pytest.raises(ValueError, match="winner_rate_mean, .*dink_error_rate_mean"):
        calculate_skill_score(spark.createDataFrame([("a", 0.1)], "player_id string, drop_efficiency_mean double"))


def test_summaries(micro_logs):
    scored = build_skill_model(aggregate_player_profiles(micro_logs))
    row = skill_summary(scored).first()
    assert (row.players, row.minimum_skill_score, row.maximum_skill_score) == (4, 21.53, 98.59)
    assert math.isclose(row.average_skill_score, (98.59 + 21.53 + 45.57 + 50.78) / 4)
    only_low = scored.filter("skill_tier = 'Beginner'")
    counts = {r.skill_tier: r.players for r in tier_counts(only_low).collect()}
    assert counts == {"Beginner": 1, "Intermediate": 0, "Professional": 0}


def test_reader(spark, micro_logs, tmp_path):
    path = str(tmp_path / "logs")
    micro_logs.withColumn("note", F.lit("x")).write.parquet(path)
    assert read_match_logs(spark, path).count() == 7
    micro_logs.drop("dink_errors").write.parquet(path + "2")
    with pytest.raises(ValueError, match="dink_errors"):
        read_match_logs(spark, path + "2")


def test_nan_is_missing_in_scores_and_tiers(spark):
    metrics = ["drop_efficiency_mean", "winner_rate_mean", "general_error_rate_mean", "dink_error_rate_mean"]
    rows = [("a", 0.1, 0.2, 0.3, 0.4), ("b", 0.9, 0.8, 0.1, 0.1), ("c", float("nan"), 0.5, 0.2, 0.2)]
    df = spark.createDataFrame(rows, "player_id string, " + ", ".join(f"{m} double" for m in metrics))
    got = {r.player_id: r for r in build_skill_model(df).collect()}
    assert (got["a"].skill_score, got["a"].skill_tier) == (0.0, "Beginner")
    assert (got["b"].skill_score, got["b"].skill_tier) == (100.0, "Professional")
    assert (got["c"].skill_score, got["c"].skill_tier) == (None, "Beginner")
    nan = spark.createDataFrame([("a", float("nan"))], "player_id string, skill_score double")
    assert assign_skill_tier(nan).first().skill_tier == "Beginner"
