"""One callable per operator: (spark, sf_dir) -> DataFrame over the whole tables.

Labels that K-Means would find are replaced by fixed rules wherever a query is compared with
SQL, so that the comparison does not depend on random starts. ``playstyle_stability`` is about
these starts: its SQL draws them from the same random numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.functions import expressions
from courtlens.functions.expressions import feature_array, nearest_index, quoted
from courtlens.operators import (
    agreement,
    components,
    features,
    fitted,
    group_sweep,
    moments,
    naming,
    nearest,
    profiles,
    selection,
    silhouette,
    skill,
    summaries,
)
from courtlens.plans import player_report
from courtlens.functions.naming_rules import DEVELOPING, HIGHER, INTERMEDIATE
from courtlens.schema import K_MAX, K_MIN, PLAYER, PLAYSTYLE_FEATURES, SKILL_FEATURES
from courtlens.sources import order_logs, player_tables

# Sums run in any order, so doubles are compared rounded. Averages of simple fractions are often
# exact multiples of 1/128 or 1/256; 8 decimals keep those off the rounding edge.
DIGITS = 8
# The eigenvectors of the SQL come from powers of the matrix.
COMPONENT_DIGITS = 6
STYLE_KEYS = naming.STYLE_KEYS

# Seed and Lloyd steps of K selection with given starts, seeds of the stability test.
SEED, STEPS, STABILITY_SEEDS = 42, 3, [1, 7, 21, 42, 100]
GROUP_NAMES = [
    "all", DEVELOPING, INTERMEDIATE, HIGHER, *[f"Performance Group {i}" for i in range(1, 6)]
]


def fixed_starts(dimensions: int) -> dict:
    """Starting centres on the diagonal, so that every fit is a fixed computation."""
    return {
        (group, k, SEED): [
            [(0.5 + SEED / 200) * (2 * j / (k - 1) - 1)] * dimensions for j in range(k)
        ]
        for group in GROUP_NAMES
        for k in range(K_MIN, K_MAX + 1)
    }


# Centres of the nearest-centre query, one value for all ten z-scored features.
FIXED_CENTRES = [-0.5, 0.0, 0.5]


# ---- shared inputs ----------------------------------------------------------


def _rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles for comparison; + 0.0 keeps -0.0 out of the result."""
    return df.selectExpr(
        *[
            f"round({quoted(c)}, {digits}) + 0D AS {quoted(c)}" if kind == "double" else quoted(c)
            for c, kind in df.dtypes
        ]
    )


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player profiles, kept because most queries read them more than once.

    Equal plans share the cached rows; ``spark.catalog.clearCache()`` releases them.
    """
    return profiles.aggregate_player_profiles(order_logs.match_logs(spark, sf_dir)).persist()


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skill.build_skill_model(_profiles(spark, sf_dir))


def _oriented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prepare_for_ml(features.create_ml_features(_profiles(spark, sf_dir)))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.scale_ml_features(_oriented(spark, sf_dir))[0]


def _clustering_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.prepare_clustering_data(_scored(spark, sf_dir), _scaled(spark, sf_dir))


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias(PLAYER), F.col("c_nationkey").alias("nation")
    )


def _with_skill_cluster(
    spark: SparkSession, sf_dir: str, df: DataFrame, clusters: int = 2
) -> DataFrame:
    """Add the fixed skill cluster: nation modulo the number of clusters."""
    cluster = (F.col("nation") % clusters).cast("int").alias("skill_cluster")
    return df.join(_nation(spark, sf_dir).select(PLAYER, cluster), PLAYER)


def _grouped(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Add the fixed skill cluster and its name (ranked by rating) to a frame of players."""
    clustered = _with_skill_cluster(spark, sf_dir, df)
    rated = clustered.join(order_logs.rally_points(spark, sf_dir), PLAYER, "left")
    labels = naming.interpret_skill_clusters(rated, "rally_points")
    return naming.apply_skill_cluster_labels(clustered, labels)


def _style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prepare_playstyle_features(
        features.create_playstyle_features(_profiles(spark, sf_dir))
    )


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill-adjusted style features with the skill columns."""
    grouped = _grouped(spark, sf_dir, _scored(spark, sf_dir).select(PLAYER, "skill_score"))
    joined = grouped.join(_style(spark, sf_dir), PLAYER)
    return features.residualize_playstyle_features(joined).persist()


def _scaled_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.scale_playstyle_features(_residuals(spark, sf_dir))[0]


def _playstyle_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z-scored style features with the skill columns merged back."""
    residuals = _residuals(spark, sf_dir)
    scaled, _ = features.scale_playstyle_features(residuals)
    skills = residuals.select(PLAYER, "skill_score", "skill_cluster", "skill_group")
    return skills.join(scaled, PLAYER)


def _styled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the fixed playstyle cluster: signs of two z-scores."""
    cluster = (F.col("drop_preference_rate_mean") > 0).cast("int") + 2 * (
        F.col("drop_efficiency_mean") > 0
    ).cast("int")
    return _playstyle_input(spark, sf_dir).withColumn("playstyle_cluster", cluster).persist()


def _archetypes(styled: DataFrame) -> DataFrame:
    return naming.name_playstyles(naming.scaled_centroids(styled))


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    styled = _styled(spark, sf_dir)
    named = naming.apply_playstyle_archetypes(styled, _archetypes(styled))
    by_group = [named.filter(F.col("skill_group") == g) for g in (DEVELOPING, HIGHER)]
    return player_report.build_final_player_profiles(by_group, _style(spark, sf_dir))


def _exploded(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per evidence entry of ``playstyle_traits``."""
    return df.select(*keys, F.posexplode("playstyle_traits").alias("position", "entry")).select(
        *keys, "position", "entry.*"
    )


# ---- per-match and per-player -----------------------------------------------


def match_features(spark, sf_dir):
    return _rounded(profiles.match_features(order_logs.match_logs(spark, sf_dir)))


def player_profiles(spark, sf_dir):
    return _rounded(_profiles(spark, sf_dir))


def player_profiles_appended(spark, sf_dir):
    """Profiles out of states of three disjoint parts of the matches, none of which is read twice."""
    logs = order_logs.match_logs(spark, sf_dir)
    parts = [moments.player_states(logs.filter(F.col("match_id") % 3 == i)) for i in range(3)]
    return _rounded(moments.profiles_of_states(moments.merge_player_states(*parts)))


def skill_scores(spark, sf_dir):
    scored = skill.calculate_skill_score(_profiles(spark, sf_dir))
    return scored.select(PLAYER, "skill_score")


def skill_tiers(spark, sf_dir):
    return _scored(spark, sf_dir).select(PLAYER, "skill_score", "skill_tier")


def skill_tiers_with_missing(spark, sf_dir):
    """A metric of some players is 0 / 0, which is NaN: they have no score, others keep theirs."""
    profiles = _profiles(spark, sf_dir).join(_nation(spark, sf_dir), PLAYER)
    rate = F.when(F.col("nation") == 0, F.lit(float("nan"))).otherwise(F.col("drop_efficiency_mean"))
    scored = skill.build_skill_model(profiles.withColumn("drop_efficiency_mean", rate))
    return scored.select(PLAYER, "skill_score", "skill_tier")


def skill_summary(spark, sf_dir):
    return _rounded(summaries.skill_summary(_scored(spark, sf_dir)))


def tier_counts(spark, sf_dir):
    return summaries.tier_counts(_scored(spark, sf_dir))


def skill_profile_samples(spark, sf_dir):
    return _rounded(summaries.skill_profile_samples(_scored(spark, sf_dir)))


# ---- skill features ---------------------------------------------------------


def ml_features(spark, sf_dir):
    return _rounded(features.create_ml_features(_profiles(spark, sf_dir)))


def oriented_features(spark, sf_dir):
    return _rounded(_oriented(spark, sf_dir))


def orientation_report(spark, sf_dir):
    ml = features.create_ml_features(_profiles(spark, sf_dir))
    return _rounded(summaries.feature_directions(ml, features.prepare_for_ml(ml)))


def feature_information(spark, sf_dir):
    return summaries.feature_information(features.create_ml_features(_profiles(spark, sf_dir)))


def feature_summary(spark, sf_dir):
    ml = features.create_ml_features(_profiles(spark, sf_dir))
    return _rounded(summaries.feature_summary(ml))


def scaled_features(spark, sf_dir):
    return _rounded(_scaled(spark, sf_dir))


def scaler_parameters(spark, sf_dir):
    return _rounded(features.scale_ml_features(_oriented(spark, sf_dir))[1])


def scaler_parameters_merged(spark, sf_dir):
    """Scaling parameters out of states of the players: two parts merged, one of them added and taken back."""
    oriented = _oriented(spark, sf_dir)
    even, odd = (moments.fit_states(oriented.filter(F.col(PLAYER) % 2 == i), SKILL_FEATURES) for i in (0, 1))
    whole = moments.merge_fit_states(even, odd, odd)
    return _rounded(moments.scaler_of_states(moments.take_back(whole, odd)))


def scaling_summary(spark, sf_dir):
    return _rounded(summaries.scaling_summary(_scaled(spark, sf_dir)))


# ---- skill groups -----------------------------------------------------------


def clustering_input(spark, sf_dir):
    return _rounded(_clustering_data(spark, sf_dir))


def clustering_input_bucketed(spark, sf_dir):
    """The same from tables in buckets of players, which are checked and joined without a shuffle."""
    scored = _scored(spark, sf_dir).select(PLAYER, "skill_score")
    name = f"players_{uuid.uuid4().hex}"
    left = player_tables.save_by_player(scored, f"{name}_scored", 8)
    right = player_tables.save_by_player(_scaled(spark, sf_dir), f"{name}_scaled", 8)
    return _rounded(selection.prepare_clustering_data(left, right))


def missing_columns(spark, sf_dir):
    """Skill features that the order tables themselves do not have."""
    found = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders")}
    frame = found["customer"].select("c_custkey", F.col("c_acctbal").alias("aggression_mean"))
    rows = [(c,) for c in expressions.missing_columns(frame, ["c_custkey", *SKILL_FEATURES])]
    return spark.createDataFrame(rows, "feature string")


def small_groups(spark, sf_dir):
    """Groups of too few players for several K: players by nation and thousands of their balance."""
    players = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat_ws("/", F.col("c_nationkey"), F.floor(F.col("c_acctbal") / 1000)).alias("skill_group")
    )
    return selection.small_groups(players)


def clustering_input_summary(spark, sf_dir):
    summary = summaries.clustering_input_summary(_clustering_data(spark, sf_dir))
    return summary.select("players", "features", F.explode("feature_names").alias("feature"))


def clustering_samples(spark, sf_dir):
    return _rounded(summaries.clustering_samples(_clustering_data(spark, sf_dir)))


def _skill_selection(spark, sf_dir):
    data = _clustering_data(spark, sf_dir)
    starts = fixed_starts(len(SKILL_FEATURES))
    return data, *selection.select_skill_k(data, starts=starts, max_iter=STEPS)


def skill_k_selection(spark, sf_dir):
    data, _, sweep = _skill_selection(spark, sf_dir)
    return _rounded(sweep.results(data).drop("skill_group"))


def skill_clusters(spark, sf_dir):
    data, best_k, sweep = _skill_selection(spark, sf_dir)
    clustered, _ = selection.cluster_skill_groups(data, best_k, sweep=sweep)
    return selection.cluster_sizes(clustered, ["skill_cluster"])


def nearest_of_many(spark, sf_dir):
    """The nearest, in skill, of every seventh player: centres that grow with the players."""
    scaled = _scaled(spark, sf_dir)
    centres = scaled.filter(F.col(PLAYER) % 7 == 0).withColumnRenamed(PLAYER, "cluster")
    return nearest.assign_nearest(scaled.select(PLAYER, *SKILL_FEATURES), SKILL_FEATURES, centres, "cluster").select(
        PLAYER, "cluster"
    )


def nearest_centre(spark, sf_dir):
    """Assignment to fixed centres, and the centres after one update."""
    centres = F.array(
        *[F.array(*[F.lit(c) for _ in SKILL_FEATURES]) for c in FIXED_CENTRES]
    )
    assigned = _scaled(spark, sf_dir).withColumn(
        "cluster", nearest_index(feature_array(SKILL_FEATURES), centres)
    )
    return _rounded(
        assigned.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("players"), *[F.avg(f).alias(f) for f in SKILL_FEATURES]
        )
    )


def skill_group_names(spark, sf_dir):
    """Names for the two-, three- and four-cluster cases."""
    return _skill_group_names(spark, sf_dir, naming.interpret_skill_clusters)


def skill_group_names_ranked(spark, sf_dir):
    """The same, ranked in Spark."""
    return _skill_group_names(spark, sf_dir, naming.rank_skill_clusters)


def _skill_group_names(spark, sf_dir, interpret):
    rated = order_logs.rally_points(spark, sf_dir)
    named = None
    for clusters in (2, 3, 4):
        clustered = _with_skill_cluster(spark, sf_dir, rated, clusters)
        labels = interpret(clustered, "rally_points").select(
            F.lit(clusters).alias("clusters"), "skill_cluster", "skill_group"
        )
        named = labels if named is None else named.unionByName(labels)
    return named


def skill_groups_applied(spark, sf_dir):
    scored = _scored(spark, sf_dir).select(PLAYER, "skill_score")
    return _grouped(spark, sf_dir, scored)


def skill_cluster_profiles(spark, sf_dir):
    scaled, scaler = features.scale_ml_features(_oriented(spark, sf_dir))
    data = selection.prepare_clustering_data(_scored(spark, sf_dir), scaled)
    clustered = _with_skill_cluster(spark, sf_dir, data)
    return _rounded(summaries.skill_cluster_profiles(clustered, scaler))


def skill_group_summary(spark, sf_dir):
    scored = _scored(spark, sf_dir).select(PLAYER, "skill_score")
    return _rounded(summaries.skill_group_summary(_grouped(spark, sf_dir, scored)))


def silhouette_scores(spark, sf_dir):
    """Exact Euclidean silhouette of two fixed labelings over the ten z-scored features."""
    labelled = _with_skill_cluster(spark, sf_dir, _scaled(spark, sf_dir), 3).select(
        *SKILL_FEATURES,
        F.col("skill_cluster").alias("by_nation"),
        (F.col("winner_rate_mean") > 0).cast("int").alias("by_winners"),
    )
    return _rounded(
        silhouette.silhouette(labelled, SKILL_FEATURES, ["by_nation", "by_winners"])
    )


def adjusted_rand(spark, sf_dir):
    """Agreement of two fixed labelings, per skill cluster."""
    labelled = _with_skill_cluster(spark, sf_dir, _scaled(spark, sf_dir)).select(
        "skill_cluster",
        (F.col("winner_rate_mean") > 0).cast("int").alias("a"),
        ((F.col("winner_rate_mean") > 0.5).cast("int") + (F.col("aggression_mean") > 0).cast("int"))
        .alias("b"),
    )
    return _rounded(agreement.adjusted_rand_index(labelled, "a", "b", ["skill_cluster"]))


# ---- playstyles -------------------------------------------------------------


def playstyle_features(spark, sf_dir):
    return _rounded(_style(spark, sf_dir))


def residualized_features(spark, sf_dir):
    return _rounded(_residuals(spark, sf_dir))


def scaled_playstyle(spark, sf_dir):
    return _rounded(_scaled_style(spark, sf_dir))


def playstyle_covariance(spark, sf_dir):
    return _rounded(components.covariance(_scaled_style(spark, sf_dir), PLAYSTYLE_FEATURES))


def playstyle_components(spark, sf_dir):
    """One row per player and component; how many there are depends on the data."""
    scores = components.extract_playstyle_components(_scaled_style(spark, sf_dir))[0]
    names = [c for c in scores.columns if c != PLAYER]
    listed = scores.select(PLAYER, F.posexplode(F.array(*names)).alias("at", "score"))
    return _rounded(
        listed.select(PLAYER, (F.col("at") + 1).alias("component"), "score"), COMPONENT_DIGITS
    )


def playstyle_loadings(spark, sf_dir):
    loadings = components.extract_playstyle_components(_scaled_style(spark, sf_dir))[1]
    return _rounded(loadings, COMPONENT_DIGITS)


def playstyle_clustering_input(spark, sf_dir):
    return _rounded(_playstyle_input(spark, sf_dir))


def _component_input(spark, sf_dir):
    data = _playstyle_input(spark, sf_dir)
    fitted = components.fit_components(data)
    return fitted.add_to(data), fitted.names


def _style_selection(spark, sf_dir):
    data, names = _component_input(spark, sf_dir)
    found = selection.select_playstyle_k(
        data, features=names, starts=fixed_starts(len(names)), max_iter=STEPS
    )
    return *found, names


def playstyle_k_selection(spark, sf_dir):
    data, _, sweep, _ = _style_selection(spark, sf_dir)
    return _rounded(sweep.results(data), COMPONENT_DIGITS)


def playstyle_clusters(spark, sf_dir):
    group_data, best_k, sweep, names = _style_selection(spark, sf_dir)
    return selection.cluster_playstyles(group_data, best_k, features=names, sweep=sweep)[2]


def playstyle_k_selection_by_group(spark, sf_dir):
    """The same selection by tasks that take a group each, the models as a table."""
    data, names = _component_input(spark, sf_dir)
    given = fixed_starts(len(names))

    def starts(group):
        return {(group, k, SEED): given[(group, k, SEED)] for k in range(K_MIN, K_MAX + 1)}

    sweep = group_sweep.sweep_groups(data, names, starts=starts, max_iter=STEPS)
    columns = ["seed", "k", "clusters", "silhouette", "cost", "selected"]
    return _rounded(sweep.models.select(F.col("grp").alias("skill_group"), *columns), COMPONENT_DIGITS)


def one_group_selection(spark, sf_dir):
    """K selection of a single skill group."""
    data, names = _component_input(spark, sf_dir)
    group_data, best_k, sweep = selection.select_playstyle_k(
        data, HIGHER, features=names, starts=fixed_starts(len(names)), max_iter=STEPS
    )
    return _rounded(sweep.results(group_data), COMPONENT_DIGITS)


def _even(df: DataFrame) -> DataFrame:
    return df.filter(F.col(PLAYER) % 2 == 0)


def new_player_scores(spark, sf_dir):
    """Bounds, scaler and centres fitted on players with even ids, applied to all."""
    profiles, oriented = _profiles(spark, sf_dir), _oriented(spark, sf_dir)
    scored = fitted.apply_skill_bounds(profiles, fitted.skill_bounds(_even(profiles)))
    scaler = features.standardize(_even(oriented), SKILL_FEATURES)[1]
    scaled = fitted.apply_scaler(oriented, scaler, SKILL_FEATURES)
    centres = spark.createDataFrame(
        [("all", i, *[c] * len(SKILL_FEATURES)) for i, c in enumerate(FIXED_CENTRES)],
        "grp string, cluster int, " + ", ".join(f"{f} double" for f in SKILL_FEATURES),
    )
    assigned = fitted.apply_centres(scaled, centres, SKILL_FEATURES, "cluster")
    return _rounded(assigned.join(scored.select(PLAYER, "skill_score"), PLAYER))


def new_player_components(spark, sf_dir):
    """Lines, scaler and loadings fitted on players with even ids, applied to all."""
    grouped = _grouped(spark, sf_dir, _scored(spark, sf_dir).select(PLAYER, "skill_score"))
    joined = grouped.join(_style(spark, sf_dir), PLAYER).persist()
    residuals = fitted.apply_residual_lines(joined, fitted.residual_lines(_even(joined)))
    scaler = features.standardize(_even(residuals), PLAYSTYLE_FEATURES)[1]
    scaled = fitted.apply_scaler(residuals, scaler, PLAYSTYLE_FEATURES).persist()
    _, loadings, _ = components.extract_playstyle_components(_even(scaled))
    scores = fitted.apply_loadings(scaled, loadings)
    listed = scores.select(PLAYER, F.posexplode("components").alias("at", "score"))
    return _rounded(
        listed.select(PLAYER, (F.col("at") + 1).alias("component"), "score"), COMPONENT_DIGITS
    )


def playstyle_stability(spark, sf_dir):
    """Every seed fits 20 random restarts until they settle, as the reference does."""
    data, names = _component_input(spark, sf_dir)
    runs, summary = selection.playstyle_stability(
        data, random_states=STABILITY_SEEDS, features=names
    )
    return _rounded(runs.join(summary, "skill_group"), COMPONENT_DIGITS)


def playstyle_centroids(spark, sf_dir):
    return _rounded(
        naming.playstyle_centroids(_styled(spark, sf_dir), _style(spark, sf_dir))
    )


def playstyle_cluster_profiles(spark, sf_dir):
    styled = _styled(spark, sf_dir)
    centroids = naming.playstyle_centroids(styled, _style(spark, sf_dir))
    return _rounded(summaries.playstyle_cluster_profiles(styled, centroids))


def scaled_centroids(spark, sf_dir):
    return _rounded(naming.scaled_centroids(_styled(spark, sf_dir)))


def playstyle_traits(spark, sf_dir):
    """One row per chosen trait."""
    entries = _exploded(_archetypes(_styled(spark, sf_dir)), STYLE_KEYS)
    return entries.filter(F.col("family") != "identity")


def archetype_names(spark, sf_dir):
    return _archetypes(_styled(spark, sf_dir)).drop("playstyle_traits")


def archetypes_applied(spark, sf_dir):
    """Archetype and evidence of every player, one row per evidence entry."""
    styled = _styled(spark, sf_dir)
    applied = naming.apply_playstyle_archetypes(styled, _archetypes(styled), with_traits=True)
    return _exploded(applied, [PLAYER, *STYLE_KEYS, "playstyle_archetype"])


def archetype_summary(spark, sf_dir):
    styled = _styled(spark, sf_dir)
    return _rounded(summaries.archetype_summary(styled, _archetypes(styled)))


def archetype_evidence(spark, sf_dir):
    styled = _styled(spark, sf_dir)
    centroids = naming.playstyle_centroids(styled, _style(spark, sf_dir))
    return _rounded(summaries.archetype_evidence(_archetypes(styled), centroids))


def final_profiles(spark, sf_dir):
    return _rounded(_final(spark, sf_dir))


def final_profile_samples(spark, sf_dir):
    return _rounded(summaries.final_profile_samples(_final(spark, sf_dir)))


def player_archetypes(spark, sf_dir):
    """The whole analysis with groups and styles found from given starts."""
    report = player_report.player_report(
        order_logs.match_logs(spark, sf_dir),
        order_logs.rally_points(spark, sf_dir),
        skill_starts=fixed_starts(len(SKILL_FEATURES)),
        style_starts=fixed_starts,
        max_iter=STEPS,
    )
    return _rounded(report.drop("playstyle_traits"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in [
        match_features,
        player_profiles,
        player_profiles_appended,
        skill_scores,
        skill_tiers,
        skill_tiers_with_missing,
        skill_summary,
        tier_counts,
        skill_profile_samples,
        ml_features,
        oriented_features,
        orientation_report,
        feature_information,
        feature_summary,
        scaled_features,
        scaler_parameters,
        scaling_summary,
        clustering_input,
        clustering_input_summary,
        clustering_samples,
        skill_k_selection,
        skill_clusters,
        nearest_centre,
        skill_group_names,
        skill_groups_applied,
        skill_cluster_profiles,
        skill_group_summary,
        silhouette_scores,
        adjusted_rand,
        playstyle_features,
        residualized_features,
        scaled_playstyle,
        playstyle_covariance,
        playstyle_components,
        playstyle_loadings,
        playstyle_clustering_input,
        playstyle_k_selection,
        playstyle_clusters,
        one_group_selection,
        new_player_scores,
        new_player_components,
        playstyle_stability,
        playstyle_centroids,
        playstyle_cluster_profiles,
        scaled_centroids,
        playstyle_traits,
        archetype_names,
        archetypes_applied,
        archetype_summary,
        archetype_evidence,
        final_profiles,
        final_profile_samples,
        player_archetypes,
        scaler_parameters_merged,
        clustering_input_bucketed,
        nearest_of_many,
        skill_group_names_ranked,
        playstyle_k_selection_by_group,
        missing_columns,
        small_groups,
    ]
}
