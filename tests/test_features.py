import numpy as np
import pytest
from pyspark.sql import functions as F

from courtlens.operators.components import covariance, fit_components
from courtlens.operators.features import (
    create_ml_features,
    create_playstyle_features,
    prepare_for_ml,
    residualize_playstyle_features,
    scale_ml_features,
    standardize,
)
from courtlens.operators.profiles import aggregate_player_profiles
from courtlens.operators.summaries import feature_directions, skill_cluster_profiles
from courtlens.schema import INVERTED_FEATURES, PLAYSTYLE_FEATURES, SKILL_FEATURES


@pytest.fixture(scope="module")
def micro_profiles(micro_logs):
    return aggregate_player_profiles(micro_logs).persist()


def frame(spark, values, names):
    rows = [(f"p{i}", *map(float, row)) for i, row in enumerate(values)]
    return spark.createDataFrame(rows, "player_id string, " + ", ".join(f"{n} double" for n in names))


def matrix(df, names):
    return np.array([[r[n] for n in names] for r in df.orderBy("player_id").collect()], dtype=float)


def test_not_finite_becomes_zero(micro_profiles):
    odd = micro_profiles.withColumn(
        "winner_rate_mean",
        F.expr("case player_id when 'p1' then double('NaN') when 'p2' then double('-Infinity')"
               " when 'p3' then null else 0.5 end"),
    )
    got = {r.player_id: r.winner_rate_mean for r in create_ml_features(odd).collect()}
    assert got == {"p1": 0.0, "p2": 0.0, "p3": 0.0, "p4": 0.5}


def test_missing_feature_columns(micro_profiles):
    with pytest.raises(ValueError, match="aggression_std"):
        create_ml_features(micro_profiles.drop("aggression_std"))


def test_orientation(micro_profiles):
    ml = create_ml_features(micro_profiles)
    oriented = prepare_for_ml(ml)
    before, after = matrix(ml, SKILL_FEATURES), matrix(oriented, SKILL_FEATURES)
    signs = np.array([-1 if f in INVERTED_FEATURES else 1 for f in SKILL_FEATURES])
    assert np.allclose(after, before * signs)
    assert not np.signbit(after[after == 0]).any()
    report = feature_directions(ml, oriented).collect()
    assert len(report) == 7 and {r.player_id for r in report} == {"p1"}


def test_standardize_uses_population_spread(spark):
    values = np.random.default_rng(0).normal(3, 5, size=(40, 2))
    values = np.column_stack([values, np.full(40, 7.0)])
    scaled, parameters = standardize(frame(spark, values, "abc"), ["a", "b", "c"])
    order = np.argsort([f"p{i}" for i in range(40)])
    want = (values - values.mean(0)) / np.where(values.std(0) == 0, 1, values.std(0))
    assert np.allclose(matrix(scaled, "abc"), want[order])
    fitted = {r.feature: (r.mean, r.scale) for r in parameters.collect()}
    assert fitted["c"] == (7.0, 1.0)
    assert fitted["a"] == pytest.approx((values[:, 0].mean(), values[:, 0].std()))


def test_scaling_back_gives_original_units(micro_profiles):
    ml = create_ml_features(micro_profiles)
    scaled, scaler = scale_ml_features(prepare_for_ml(ml))
    cluster = F.when(F.col("player_id") < "p3", 0).otherwise(1).alias("skill_cluster")
    labelled = scaled.select("*", cluster, F.lit(1.0).alias("skill_score"))
    got = {r.skill_cluster: r for r in skill_cluster_profiles(labelled, scaler).collect()}
    direct = ml.select("*", cluster).groupBy("skill_cluster").agg(*[F.avg(f).alias(f) for f in SKILL_FEATURES])
    for row in direct.collect():
        for f in SKILL_FEATURES:
            assert got[row.skill_cluster][f] == pytest.approx(row[f], abs=1e-12)


def test_style_features(micro_profiles):
    rows = {r.player_id: r for r in create_playstyle_features(micro_profiles).collect()}
    assert rows["p1"].drop_usage_rate == pytest.approx(11 / 25)
    assert rows["p3"].error_to_winner_ratio == 0.0
    short = micro_profiles.withColumn("average_match_duration", F.lit(0.25)).withColumn(
        "average_winners", F.lit(0.5)
    )
    row = create_playstyle_features(short).filter("player_id = 'p1'").first()
    assert row.drop_usage_rate == 11.0 and row.error_to_winner_ratio == 1.5
    missing = micro_profiles.withColumn("average_match_duration", F.lit(None).cast("double"))
    assert create_playstyle_features(missing).first().drop_usage_rate == 0.0


def style_frame(spark, groups, scores, seed=0):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(len(groups), 13)) + 0.3 * np.nan_to_num(scores)[:, None]
    rows = [
        (f"p{i:03d}", g, None if np.isnan(s) else float(s), *map(float, v))
        for i, (g, s, v) in enumerate(zip(groups, scores, values))
    ]
    names = ", ".join(f"{f} double" for f in PLAYSTYLE_FEATURES)
    return spark.createDataFrame(rows, f"player_id string, skill_group string, skill_score double, {names}"), values


def test_residuals_match_line_fit_per_group(spark):
    rng = np.random.default_rng(1)
    groups = ["a"] * 30 + ["b"] * 5 + ["two"] * 2 + ["flat"] * 4 + [None] * 2
    scores = rng.uniform(0, 100, len(groups))
    scores[37:41] = 50.0
    df, values = style_frame(spark, groups, scores)
    got = matrix(residualize_playstyle_features(df), PLAYSTYLE_FEATURES)
    for start, stop, fitted in [(0, 30, True), (30, 35, True), (35, 37, False), (37, 41, False)]:
        for j in range(13):
            y, x = values[start:stop, j], scores[start:stop]
            want = y - np.polyval(np.polyfit(x, y, 1), x) if fitted else y
            assert np.allclose(got[start:stop, j], want, atol=1e-9)
    assert np.isnan(got[41:]).all()
    assert abs(got[:30].mean(0)).max() < 1e-12
    assert abs(got[:30].T @ (scores[:30] - scores[:30].mean())).max() < 1e-9


def test_residuals_of_listed_features_and_other_columns(spark):
    df, values = style_frame(spark, ["a"] * 10, np.arange(10.0))
    df = df.withColumnRenamed("skill_group", "team").withColumnRenamed("skill_score", "level")
    out = residualize_playstyle_features(df, ["aggression_mean"], "team", "level")
    got = matrix(out, PLAYSTYLE_FEATURES)
    assert np.allclose(got[:, 1:], values[:, 1:])
    assert abs(got[:, 0] @ np.arange(10.0)) < 1e-9


def test_many_groups_take_the_shuffled_join(spark, monkeypatch):
    from courtlens.operators import small_tables

    groups = [f"g{i % 20}" for i in range(100)]
    df, _ = style_frame(spark, groups, np.random.default_rng(2).uniform(0, 9, 100))
    want = matrix(residualize_playstyle_features(df), PLAYSTYLE_FEATURES)
    monkeypatch.setattr(small_tables, "BROADCAST_ROWS", 5)
    assert np.allclose(matrix(residualize_playstyle_features(df), PLAYSTYLE_FEATURES), want)


def test_exactly_linear_feature_is_not_blown_up(spark):
    df, _ = style_frame(spark, ["a"] * 12, np.linspace(0, 7, 12))
    df = df.withColumn("aggression_mean", F.col("skill_score") * 0.1 + 0.3)
    scaled, _ = standardize(residualize_playstyle_features(df), PLAYSTYLE_FEATURES)
    assert abs(matrix(scaled, ["aggression_mean"])).max() < 1e-9


def test_components_match_svd(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 13)) @ rng.normal(size=(13, 13))
    df = frame(spark, x, PLAYSTYLE_FEATURES)
    x = x[np.argsort([f"p{i}" for i in range(60)])]
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    shares = s**2 / (s**2).sum()
    for min_share in (0.5, 0.8, 1.0):
        fitted = fit_components(df, min_share)
        n = len(fitted.names)
        assert np.cumsum(shares)[n - 1] >= min_share - 1e-12
        assert n == 1 or np.cumsum(shares)[n - 2] < min_share
        assert fitted.share == pytest.approx(np.cumsum(shares)[n - 1])
        scores = matrix(fitted.add_to(df), fitted.names)
        want = centred @ vt[:n].T
        want *= np.sign((want * scores).sum(0))
        assert np.allclose(scores, want, atol=1e-8)
    pairs = {(r.feature_a, r.feature_b): r.covariance for r in covariance(df, PLAYSTYLE_FEATURES).collect()}
    cov = np.cov(centred.T, bias=True)
    assert pairs[(PLAYSTYLE_FEATURES[0], PLAYSTYLE_FEATURES[5])] == pytest.approx(cov[0, 5])
    assert len(pairs) == 13 * 14 // 2
