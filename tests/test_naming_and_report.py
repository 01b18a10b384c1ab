import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtlens import OffendingPlayers, discard
from courtlens.operators.naming import (
    apply_playstyle_archetypes,
    apply_skill_cluster_labels,
    interpret_playstyle_clusters,
    interpret_skill_clusters,
    name_playstyles,
)
from courtlens.plans.player_report import (
    build_final_player_profiles,
    find_playstyles,
    find_skill_groups,
    player_report,
)
from courtlens.operators.small_tables import checkpoint_dir
from courtlens.schema import MATCH_LOG_SCHEMA, PLAYSTYLE_FEATURES

DEVELOPING, HIGHER = "Developing / Lower-Performance", "Higher-Performance"


def centroids(spark, *clusters, group=DEVELOPING):
    """One centroid per dict of z-scores; features left out are 0.0."""
    rows = [
        (c.get("group", group), i, *[z if z is None else float(z) for z in (c.get(f, 0.0) for f in PLAYSTYLE_FEATURES)])
        for i, c in enumerate(clusters)
    ]
    names = ", ".join(f"{f} double" for f in PLAYSTYLE_FEATURES)
    return spark.createDataFrame(rows, f"skill_group string, playstyle_cluster int, {names}")


def names(spark, *clusters, **kw):
    rows = name_playstyles(centroids(spark, *clusters, **kw)).orderBy("playstyle_cluster").collect()
    return [r.playstyle_archetype for r in rows]


def traits(spark, cluster):
    entries = name_playstyles(centroids(spark, cluster)).first().playstyle_traits
    return [(e.label, e.feature, e.family, e.direction, e.z) for e in entries]


@pytest.mark.parametrize(
    "clusters, want",
    [
        (1, ["Performance Group 1"]),
        (2, [DEVELOPING, HIGHER]),
        (3, [DEVELOPING, "Intermediate-Performance", HIGHER]),
        (4, [f"Performance Group {i}" for i in (1, 2, 3, 4)]),
    ],
)
def test_skill_group_names(spark, clusters, want):
    # cluster ids run against the ranking
    rows = [(f"p{i}", clusters - 1 - c, c * 10.0 + i % 2) for i, c in enumerate(list(range(clusters)) * 3)]
    df = spark.createDataFrame(rows, "player_id string, skill_cluster int, rally_points double")
    labels = interpret_skill_clusters(df, "rally_points")
    got = {r.skill_cluster: r.skill_group for r in labels.collect()}
    assert got == {clusters - 1 - i: name for i, name in enumerate(want)}
    applied = apply_skill_cluster_labels(df.withColumn("skill_cluster", F.lit(99)), labels)
    assert applied.filter("skill_group is not null").isEmpty()


def test_ranking_column_is_checked(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 1, None)], "player_id string, skill_cluster int, rally_points double")
    with pytest.raises(ValueError, match="no column 'skill_score'"):
        interpret_skill_clusters(df)
    with pytest.raises(ValueError, match="no 'rally_points'"):
        interpret_skill_clusters(df, "rally_points")
    nan = df.withColumn("rally_points", F.coalesce("rally_points", F.lit(float("nan"))))
    with pytest.raises(ValueError, match="no 'rally_points'"):
        interpret_skill_clusters(nan, "rally_points")


def test_trait_threshold_and_identity_fallback(spark):
    assert names(spark, {"drop_efficiency_mean": 0.2}) == ["Developing Precise All-Court Player"]
    assert names(spark, {"drop_efficiency_mean": 0.19}) == ["Developing All-Court Player"]
    assert traits(spark, {}) == [("All-Court Player", None, "identity", "above", 0.0)]


def test_sides_without_a_word_are_skipped(spark):
    z = {"drop_efficiency_mean": -2.0, "error_to_winner_ratio": 1.5, "winner_rate_std": 0.5}
    assert names(spark, z) == ["Developing Streaky All-Court Player"]
    z = {"drop_efficiency_mean": -2.0, "error_to_winner_ratio": -0.3}
    assert names(spark, z) == ["Developing Clean All-Court Player"]


def test_one_trait_per_family_strongest_first(spark):
    z = {
        "winner_rate_std": 0.9, "drop_efficiency_std": 1.2, "drop_efficiency_mean": 0.4,
        "error_to_winner_ratio": -0.3, "net_game_preference_rate_mean": -0.71239,
        "drop_preference_rate_mean": 0.5,
    }
    assert traits(spark, z) == [
        ("Inconsistent", "drop_efficiency_std", "consistency", "above", 1.2),
        ("Precise", "drop_efficiency_mean", "precision", "above", 0.4),
        ("Power Player", "net_game_preference_rate_mean", "identity", "below", -0.712),
    ]
    assert names(spark, z) == ["Developing Inconsistent Precise Power Player"]


def test_ties_follow_vocabulary_order(spark):
    z = {"aggression_std": -0.5, "dink_error_rate_std": 0.5, "drop_preference_rate_mean": 0.4,
         "net_game_preference_rate_mean": -0.4}
    assert names(spark, z) == ["Developing Steady Dropper"]


def test_excluded_features_never_name(spark):
    z = {"aggression_mean": 3, "drop_usage_rate": 3, "drop_preference_rate_std": 3, "net_game_preference_rate_std": -3}
    assert names(spark, z) == ["Developing All-Court Player"]


def test_missing_z_contributes_nothing(spark):
    z = {"drop_efficiency_mean": None, "winner_rate_std": -0.6, "drop_preference_rate_mean": None,
         "net_game_preference_rate_mean": 0.3}
    assert names(spark, z) == ["Developing Consistent Net Player"]


def test_repeated_names_are_numbered_per_group(spark):
    same = {"drop_preference_rate_mean": -1.0}
    rows = [dict(same), dict(same), {"drop_preference_rate_mean": 1.0}, dict(same), {**same, "group": HIGHER}]
    assert names(spark, *rows) == [
        "Developing Driver", "Developing Driver Type 2", "Developing Dropper",
        "Developing Driver Type 3", "Advanced Driver",
    ]


def test_other_prefixes(spark):
    assert names(spark, {}, group="Intermediate-Performance") == ["Intermediate All-Court Player"]
    assert names(spark, {}, group="Performance Group 3") == ["Group 3 All-Court Player"]


def styled(spark):
    z = centroids(spark, {"drop_preference_rate_mean": -1.0}, {"drop_preference_rate_mean": 1.0},
                  {"drop_preference_rate_mean": -1.0, "group": HIGHER})
    # one player per centroid; its z-scores are the cluster's centroid
    players = z.select(
        F.concat(F.lit("p"), "playstyle_cluster").alias("player_id"),
        F.lit(50.0).alias("skill_score"), F.lit(0).alias("skill_cluster"), "*",
    )
    raw = players.select("player_id", *[(F.col(f) + 10.0).alias(f) for f in PLAYSTYLE_FEATURES])
    return players, raw


def test_interpretation_and_application(spark):
    players, raw = styled(spark)
    archetypes, raw_centroids, scaled = interpret_playstyle_clusters(players, raw)
    assert scaled.count() == 3
    low = raw_centroids.filter("playstyle_cluster = 0").first()
    assert low.drop_preference_rate_mean == 9.0 and low.aggression_mean == 10.0
    named = apply_playstyle_archetypes(players, archetypes, with_traits=True)
    got = {r.player_id: r for r in named.collect()}
    assert got["p2"].playstyle_archetype == "Advanced Driver"
    assert got["p1"].playstyle_traits[0].label == "Dropper"
    assert "playstyle_traits" not in apply_playstyle_archetypes(players, archetypes).columns


def test_final_profiles_and_their_checks(spark):
    players, raw = styled(spark)
    named = apply_playstyle_archetypes(players, name_playstyles(players))
    by_group = [named.filter(F.col("skill_group") == g) for g in (HIGHER, DEVELOPING)]
    final = build_final_player_profiles(by_group, raw)
    assert len(final.columns) == 19
    assert [r.player_id for r in final.collect()] == ["p0", "p1", "p2"]
    assert final.first().drop_preference_rate_mean == 9.0
    with pytest.raises(ValueError, match="two playstyle assignments"):
        build_final_player_profiles(named.union(named.limit(1)), raw)
    with pytest.raises(ValueError, match="two rows of style evidence"):
        build_final_player_profiles(named, raw.union(raw.limit(1)))
    with pytest.raises(ValueError, match="lack style evidence: p1"):
        build_final_player_profiles(named, raw.filter("player_id <> 'p1'"))
    hole = raw.withColumn("drop_usage_rate", F.when(F.col("player_id") != "p2", F.col("drop_usage_rate")))
    with pytest.raises(ValueError, match="evidence: p2"):
        build_final_player_profiles(named, hole)
    nan = raw.withColumn("drop_usage_rate", F.lit(float("nan")))
    with pytest.raises(OffendingPlayers, match="evidence: p0, p1, p2") as failed:
        build_final_player_profiles(named, nan)
    assert {r[0] for r in failed.value.players.collect()} == {"p0", "p1", "p2"}


@pytest.fixture(scope="module")
def league(spark):
    """Two clearly different kinds of player, each with two shot habits."""
    rng = np.random.default_rng(11)
    rows, ratings = [], []
    for i in range(80):
        strong, dropper = i % 2, (i // 2) % 2
        player = f"p{i:02d}"
        ratings.append((player, 1500.0 + 300 * strong + float(rng.normal(0, 20))))
        for m in range(6):
            attempts = int(12 + 20 * dropper + rng.integers(0, 5))
            rows.append((
                player, f"{player}-{m}", float(rng.uniform(18, 22)), attempts,
                int(attempts * (0.5 + 0.4 * strong)), int(30 - 20 * dropper + rng.integers(0, 4)),
                int(8 + 25 * strong + rng.integers(0, 3)), int(3 + rng.integers(0, 3)),
                int(25 - 18 * strong + rng.integers(0, 3)), int(10 - 8 * strong + rng.integers(0, 2)),
                bool(rng.integers(0, 2)),
            ))
    return (
        spark.createDataFrame(rows, MATCH_LOG_SCHEMA),
        spark.createDataFrame(ratings, "player_id string, rally_points double"),
    )


def test_whole_report(spark, league):
    logs, ratings = league
    skill = find_skill_groups(logs, ratings, n_init=4)
    assert skill.best_k == 2
    assert {r.skill_group for r in skill.labels.collect()} == {DEVELOPING, HIGHER}
    strong = {f"p{i:02d}" for i in range(80) if i % 2}
    assert {r.player_id for r in skill.players.filter(F.col("skill_group") == HIGHER).collect()} == strong
    styles = find_playstyles(skill, n_init=4)
    assert styles.components.share >= 0.80
    assert set(styles.best_k) == {DEVELOPING, HIGHER}
    report = player_report(logs, ratings, n_init=4).collect()
    assert [r.player_id for r in report] == [f"p{i:02d}" for i in range(80)]
    for r in report:
        assert r.playstyle_archetype.startswith("Advanced" if r.player_id in strong else "Developing")
        assert r.playstyle_traits[-1].family == "identity"
    per_cluster = {(r.skill_group, r.playstyle_cluster): r.playstyle_archetype for r in report}
    assert len(set(per_cluster.values())) == len(per_cluster)


def stored_tables(spark):
    folder = checkpoint_dir(spark).removeprefix("file://") + "/courtlens"
    return {f"{d}/{n}" for d in os.listdir(folder) for n in os.listdir(f"{folder}/{d}")}


def test_options_and_storage(spark, league):
    logs, ratings = league
    player_report(logs, ratings, n_init=1)  # so that the folder exists
    before = stored_tables(spark)
    report = player_report(logs, ratings, n_init=2, skip_small=True, min_share=0.5)
    assert report.count() == 80
    # Of all tables of the run only the report is left, until it is discarded.
    assert {t.split("/")[1] for t in stored_tables(spark) - before} == {"player_report"}
    discard(report)
    assert stored_tables(spark) == before


def test_ratings_must_cover_every_player_once(spark, league):
    logs, ratings = league
    with pytest.raises(ValueError, match="two ratings: p00, p01"):
        find_skill_groups(logs, ratings.union(ratings.filter("player_id < 'p02'")), n_init=1)
    nan = ratings.withColumn("rally_points", F.lit(float("nan")))
    with pytest.raises(ValueError, match="rally_points"):
        find_skill_groups(logs, nan, n_init=1)
    with pytest.raises(ValueError, match="rally_points"):
        find_skill_groups(logs, ratings.limit(10), n_init=1)


def test_without_ratings_the_score_ranks(spark, league):
    skill = find_skill_groups(league[0], n_init=2)
    averages = {r.skill_group: r.a for r in skill.players.groupBy("skill_group").agg(F.avg("skill_score").alias("a")).collect()}
    assert averages[HIGHER] > averages[DEVELOPING]
