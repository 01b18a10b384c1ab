"""Player analytics on Spark: match logs in, explained player profiles out."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from courtlens.functions.naming_rules import (  # noqa: E402
    choose_traits as choose_playstyle_traits,
    describe_name as describe_playstyle_name,
)
from courtlens.operators.agreement import adjusted_rand_index  # noqa: E402
from courtlens.operators.checks import OffendingPlayers  # noqa: E402
from courtlens.operators.components import extract_playstyle_components  # noqa: E402
from courtlens.operators.features import (  # noqa: E402
    create_ml_features,
    create_playstyle_features,
    prepare_for_ml,
    prepare_playstyle_features,
    residualize_playstyle_features,
    scale_ml_features,
    scale_playstyle_features,
)
from courtlens.operators.fitted import (  # noqa: E402
    apply_centres,
    apply_loadings,
    apply_residual_lines,
    apply_scaler,
    apply_skill_bounds,
    residual_lines,
    skill_bounds,
)
from courtlens.operators.group_sweep import sweep_groups  # noqa: E402
from courtlens.operators.moments import (  # noqa: E402
    components_of_states,
    fit_states,
    lines_of_states,
    merge_fit_states,
    merge_player_states,
    player_states,
    profiles_of_states,
    scaler_of_states,
    take_back,
)
from courtlens.operators.naming import (  # noqa: E402
    apply_playstyle_archetypes,
    apply_skill_cluster_labels,
    interpret_playstyle_clusters,
    interpret_skill_clusters,
    name_playstyles,
    playstyle_centroids,
    rank_skill_clusters,
    scaled_centroids,
)
from courtlens.operators.nearest import assign_nearest  # noqa: E402
from courtlens.operators.profiles import aggregate_player_profiles, match_features  # noqa: E402
from courtlens.operators.selection import (  # noqa: E402
    cluster_playstyles,
    cluster_skill_groups,
    playstyle_stability,
    prepare_clustering_data,
    select_playstyle_k,
    select_skill_k,
    small_groups,
)
from courtlens.operators.silhouette import silhouette  # noqa: E402
from courtlens.operators.skill import (  # noqa: E402
    assign_skill_tier,
    build_skill_model,
    calculate_skill_score,
    min_max_normalize,
)
from courtlens.operators.summaries import (  # noqa: E402
    archetype_evidence,
    archetype_summary,
    clustering_input_summary,
    clustering_samples,
    feature_directions,
    feature_information,
    feature_summary,
    final_profile_samples,
    playstyle_cluster_profiles,
    scaling_summary,
    skill_cluster_profiles,
    skill_group_summary,
    skill_profile_samples,
    skill_summary,
    tier_counts,
)
from courtlens.operators.small_tables import discard  # noqa: E402
from courtlens.plans.player_report import (  # noqa: E402
    build_final_player_profiles,
    find_playstyles,
    find_skill_groups,
    player_report,
)
from courtlens.sources.player_tables import drop_player_table, save_by_player  # noqa: E402
from courtlens.sources.tables import read_match_logs, read_ratings  # noqa: E402

__all__ = [
    "sweep_groups",
    "components_of_states",
    "fit_states",
    "lines_of_states",
    "merge_fit_states",
    "merge_player_states",
    "player_states",
    "profiles_of_states",
    "scaler_of_states",
    "take_back",
    "rank_skill_clusters",
    "assign_nearest",
    "small_groups",
    "save_by_player",
    "drop_player_table",
    "OffendingPlayers",
    "adjusted_rand_index",
    "archetype_evidence",
    "archetype_summary",
    "choose_playstyle_traits",
    "clustering_input_summary",
    "clustering_samples",
    "describe_playstyle_name",
    "discard",
    "feature_directions",
    "feature_information",
    "feature_summary",
    "final_profile_samples",
    "playstyle_cluster_profiles",
    "scaling_summary",
    "skill_bounds",
    "skill_cluster_profiles",
    "skill_group_summary",
    "skill_profile_samples",
    "skill_summary",
    "tier_counts",
    "aggregate_player_profiles",
    "apply_centres",
    "apply_loadings",
    "apply_playstyle_archetypes",
    "apply_residual_lines",
    "apply_scaler",
    "apply_skill_bounds",
    "apply_skill_cluster_labels",
    "assign_skill_tier",
    "build_final_player_profiles",
    "build_skill_model",
    "calculate_skill_score",
    "cluster_playstyles",
    "cluster_skill_groups",
    "create_ml_features",
    "create_playstyle_features",
    "extract_playstyle_components",
    "find_playstyles",
    "find_skill_groups",
    "interpret_playstyle_clusters",
    "interpret_skill_clusters",
    "match_features",
    "min_max_normalize",
    "name_playstyles",
    "player_report",
    "playstyle_centroids",
    "playstyle_stability",
    "prepare_clustering_data",
    "prepare_for_ml",
    "prepare_playstyle_features",
    "read_match_logs",
    "read_ratings",
    "residual_lines",
    "residualize_playstyle_features",
    "scale_ml_features",
    "scale_playstyle_features",
    "scaled_centroids",
    "select_playstyle_k",
    "select_skill_k",
    "silhouette",
]
