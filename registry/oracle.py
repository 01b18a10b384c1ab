"""The registered queries in plain SQL over the same tables.

Each statement is written out of the shared table expressions below; it uses the ones it needs.
"""

from __future__ import annotations

import re

import numpy as np

# ---- Fixed values, written out so that they check those of the engine -------

RATE_PREFIXES = {
    "drop_efficiency": "drop_efficiency",
    "winner_rate_pm": "winner_rate",
    "general_error_rate_pm": "general_error_rate",
    "dink_error_rate_pm": "dink_error_rate",
    "aggression_rate": "aggression",
    "drop_preference_rate": "drop_preference_rate",
    "net_game_preference_rate": "net_game_preference_rate",
}
SKILL_FEATURES = [
    "winner_rate_mean",
    "general_error_rate_mean",
    "dink_error_rate_mean",
    "drop_efficiency_mean",
    "aggression_mean",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
    "drop_efficiency_std",
    "aggression_std",
]
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
DIRECTION_FEATURES = [
    "winner_rate_mean",
    "general_error_rate_mean",
    "dink_error_rate_mean",
    "drop_efficiency_mean",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
]
EVIDENCE_FEATURES = [
    "aggression_mean",
    "drop_efficiency_mean",
    "drop_usage_rate",
    "error_to_winner_ratio",
    "aggression_std",
    "drop_efficiency_std",
    "winner_rate_std",
    "general_error_rate_std",
    "dink_error_rate_std",
    "drop_preference_rate_mean",
    "net_game_preference_rate_mean",
]
FINAL_REPORT_FEATURES = [
    "aggression_mean",
    "drop_efficiency_mean",
    "drop_usage_rate",
    "error_to_winner_ratio",
    "drop_preference_rate_mean",
    "net_game_preference_rate_mean",
    "aggression_std",
    "general_error_rate_std",
    "dink_error_rate_std",
]
# K selection with given starts: seed, number of Lloyd steps, smallest and largest K.
SEED, STABILITY_SEEDS, STEPS, K_MIN, K_MAX = 42, [1, 7, 21, 42, 100], 3, 2, 5
MIN_SHARE = 0.8

DIGITS = 8


def r(expression: str, name: str | None = None) -> str:
    """Rounded column; + 0.0 keeps -0.0 out of the result."""
    alias = name if name is not None else expression
    return f"round({expression}, {DIGITS}) + 0.0 AS {alias}"


def rounded(columns) -> str:
    return ",\n  ".join(r(c) for c in columns)


def each(columns, template: str) -> str:
    return ",\n  ".join(template.replace("{c}", c) for c in columns)


def rows(columns, template: str) -> str:
    return "\nUNION ALL\n".join(template.replace("{c}", c) for c in columns)


PROFILE_COLUMNS = [
    *[f"{p}_mean" for p in RATE_PREFIXES.values()],
    *[f"{p}_std" for p in RATE_PREFIXES.values()],
    "average_drop_attempts",
    "average_winners",
    "average_unforced_errors",
    "average_dink_errors",
    "average_match_duration",
    "stacking_rate",
]

# name -> (expressions it reads, SQL)
TABLES: dict[str, tuple[list[str], str]] = {}

TABLES["logs"] = (
    [],
    """SELECT o.o_custkey AS player_id, o.o_orderkey AS match_id,
  CAST(sum(CASE WHEN l_linenumber <= 3 THEN l_quantity ELSE 0 END) AS double) / 8.0 AS match_duration_mins,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS bigint) AS drop_attempts,
  CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS bigint) AS drop_successes,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS bigint) AS drive_attempts,
  CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_linenumber ELSE 0 END) AS bigint) AS clean_winners,
  CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_linenumber ELSE 0 END) AS bigint) AS dink_winners,
  CAST(sum(CASE WHEN l_tax >= 0.04 THEN 1 ELSE 0 END) AS bigint) AS unforced_errors,
  CAST(sum(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS bigint) AS dink_errors,
  o.o_orderstatus = 'F' AS uses_stacking
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_custkey, o.o_orderkey, o.o_orderstatus""",
)

TABLES["rates"] = (
    ["logs"],
    """SELECT player_id, match_id, match_duration_mins, drop_attempts, unforced_errors, dink_errors,
  uses_stacking,
  clean_winners + dink_winners AS total_winners,
  CASE WHEN drop_attempts > 0 THEN drop_successes / drop_attempts ELSE 0.0 END AS drop_efficiency,
  (clean_winners + dink_winners) / minutes AS winner_rate_pm,
  unforced_errors / minutes AS general_error_rate_pm,
  dink_errors / minutes AS dink_error_rate_pm,
  CASE WHEN clean_winners + dink_winners + unforced_errors > 0
    THEN (clean_winners + dink_winners) / (clean_winners + dink_winners + unforced_errors)
    ELSE 0.0 END AS aggression_rate,
  CASE WHEN drop_attempts + drive_attempts > 0
    THEN drop_attempts / (drop_attempts + drive_attempts) ELSE 0.0 END AS drop_preference_rate,
  CASE WHEN clean_winners + dink_winners > 0
    THEN dink_winners / (clean_winners + dink_winners) ELSE 0.0 END AS net_game_preference_rate
FROM (SELECT *, CASE WHEN match_duration_mins IS NOT NULL
        THEN greatest(match_duration_mins, 1.0) END AS minutes FROM logs)""",
)

TABLES["profiles"] = (
    ["rates"],
    "SELECT player_id,\n  "
    + ",\n  ".join(f"avg({rate}) AS {p}_mean" for rate, p in RATE_PREFIXES.items())
    + ",\n  "
    + ",\n  ".join(
        f"coalesce(stddev_samp({rate}), 0.0) AS {p}_std" for rate, p in RATE_PREFIXES.items()
    )
    + """,
  avg(drop_attempts) AS average_drop_attempts,
  avg(total_winners) AS average_winners,
  avg(unforced_errors) AS average_unforced_errors,
  avg(dink_errors) AS average_dink_errors,
  avg(match_duration_mins) AS average_match_duration,
  avg(CASE WHEN uses_stacking THEN 1.0 ELSE 0.0 END) AS stacking_rate,
  count(match_id) AS match_count
FROM rates WHERE player_id IS NOT NULL GROUP BY player_id""",
)


def _normalised(c: str) -> str:
    return f"CASE WHEN hi_{c} = lo_{c} THEN 0.5 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"


_METRICS = [
    "drop_efficiency_mean",
    "winner_rate_mean",
    "general_error_rate_mean",
    "dink_error_rate_mean",
]

TABLES["scored"] = (
    ["profiles"],
    f"""SELECT *, CASE WHEN skill_score >= 75 THEN 'Professional'
    WHEN skill_score >= 40 THEN 'Intermediate' ELSE 'Beginner' END AS skill_tier
FROM (SELECT profiles.*,
  round_even((({_normalised(_METRICS[0])}) * CAST(0.25 AS double)
    + ({_normalised(_METRICS[1])}) * CAST(0.30 AS double)
    + (1.0 - ({_normalised(_METRICS[2])})) * CAST(0.20 AS double)
    + (1.0 - ({_normalised(_METRICS[3])})) * CAST(0.25 AS double)) * 100.0 * 100.0, 0) / 100.0 AS skill_score
  FROM profiles, (SELECT {each(_METRICS, "min({c}) AS lo_{c}, max({c}) AS hi_{c}")} FROM profiles))""",
)

_INVERTED = [
    f for f in SKILL_FEATURES
    if f.endswith("_std") or f in ("general_error_rate_mean", "dink_error_rate_mean")
]

TABLES["ml"] = (
    ["profiles"],
    "SELECT player_id,\n  "
    + each(SKILL_FEATURES, "CASE WHEN isfinite({c}) THEN {c} ELSE 0.0 END AS {c}")
    + "\nFROM profiles",
)

TABLES["oriented"] = (
    ["ml"],
    "SELECT player_id,\n  "
    + ",\n  ".join(f"0.0 - {f} AS {f}" if f in _INVERTED else f for f in SKILL_FEATURES)
    + "\nFROM ml",
)


def _z(columns, source: str, keep: str = "player_id") -> str:
    stats = each(
        columns,
        "avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) < 1e-12 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}",
    )
    return (
        f"SELECT {keep},\n  " + each(columns, "({c} - m_{c}) / s_{c} AS {c}")
        + f"\nFROM {source}, (SELECT {stats} FROM {source})"
    )


TABLES["scaled"] = (["oriented"], _z(SKILL_FEATURES, "oriented"))

TABLES["clustering"] = (
    ["scored", "scaled"],
    f"""SELECT player_id, scored.skill_score, {each(SKILL_FEATURES, "scaled.{c}")}
FROM scored JOIN scaled USING (player_id)""",
)

TABLES["nation"] = (
    [],
    "SELECT c_custkey AS player_id, c_nationkey AS nation, c_acctbal AS rally_points FROM customer",
)


def _labels(clusters: int) -> str:
    """Skill-cluster names for nation % clusters, ranked by rating."""
    return f"""SELECT skill_cluster, CASE
    WHEN {clusters} IN (2, 3) AND position = 1 THEN 'Developing / Lower-Performance'
    WHEN {clusters} IN (2, 3) AND position = {clusters} THEN 'Higher-Performance'
    WHEN {clusters} = 3 THEN 'Intermediate-Performance'
    ELSE 'Performance Group ' || position END AS skill_group
  FROM (SELECT skill_cluster, row_number() OVER (ORDER BY points, skill_cluster) AS position
    FROM (SELECT CAST(nation % {clusters} AS integer) AS skill_cluster, avg(rally_points) AS points
      FROM {{source}} GROUP BY 1))"""


TABLES["grouped"] = (
    ["scored", "nation"],
    f"""SELECT p.player_id, p.skill_score, p.skill_cluster, labels.skill_group
FROM (SELECT player_id, skill_score, CAST(nation % 2 AS integer) AS skill_cluster
      FROM scored JOIN nation USING (player_id)) p
JOIN ({_labels(2).replace("{source}", "(SELECT nation.* FROM nation JOIN scored USING (player_id))")}) labels
  USING (skill_cluster)""",
)

_STYLE_SOURCE = {
    "drop_usage_rate": "average_drop_attempts / CASE WHEN average_match_duration IS NOT NULL "
    "THEN greatest(average_match_duration, 1.0) END",
    "error_to_winner_ratio": "average_unforced_errors / CASE WHEN average_winners IS NOT NULL "
    "THEN greatest(average_winners, 1.0) END",
}

TABLES["style"] = (
    ["profiles"],
    "SELECT player_id,\n  "
    + ",\n  ".join(
        "CASE WHEN isfinite({e}) THEN {e} ELSE 0.0 END AS {f}".format(e=_STYLE_SOURCE.get(f, f), f=f)
        for f in PLAYSTYLE_FEATURES
    )
    + "\nFROM profiles",
)

TABLES["residuals"] = (
    ["grouped", "style"],
    "SELECT player_id, skill_score, g.skill_cluster, g.skill_group,\n  "
    + each(
        PLAYSTYLE_FEATURES,
        "CASE WHEN fit THEN {c} - (a_{c} + b_{c} * skill_score) ELSE {c} END AS {c}",
    )
    + "\nFROM grouped g JOIN style USING (player_id)\nJOIN (SELECT skill_group,"
    + " count(*) >= 3 AND min(skill_score) < max(skill_score) AS fit,\n  "
    + each(
        PLAYSTYLE_FEATURES,
        "regr_slope({c}, skill_score) AS b_{c}, regr_intercept({c}, skill_score) AS a_{c}",
    )
    + "\n  FROM grouped JOIN style USING (player_id) GROUP BY skill_group) lines"
    + " ON g.skill_group = lines.skill_group",
)

TABLES["scaled_style"] = (
    ["residuals"],
    _z(PLAYSTYLE_FEATURES, "residuals", "player_id, skill_score, skill_cluster, skill_group"),
)

TABLES["styled"] = (
    ["scaled_style"],
    """SELECT *, CAST(drop_preference_rate_mean > 0 AS integer)
  + 2 * CAST(drop_efficiency_mean > 0 AS integer) AS playstyle_cluster FROM scaled_style""",
)

TABLES["centroids"] = (
    ["styled"],
    "SELECT skill_group, playstyle_cluster,\n  "
    + each(PLAYSTYLE_FEATURES, "avg({c}) AS {c}")
    + "\nFROM styled GROUP BY ALL",
)

TABLES["raw_centroids"] = (
    ["styled", "style"],
    "SELECT s.skill_group, s.playstyle_cluster,\n  "
    + each(PLAYSTYLE_FEATURES, "avg(style.{c}) AS {c}")
    + "\nFROM styled s LEFT JOIN style USING (player_id) GROUP BY ALL",
)

# Fixed values: (feature, family, low word, high word), then (feature, low noun, high noun).
_TRAIT_WORDS = [
    ("drop_efficiency_mean", "precision", "NULL", "'Precise'"),
    ("error_to_winner_ratio", "precision", "'Clean'", "NULL"),
    ("aggression_std", "consistency", "'Steady'", "'Unpredictable'"),
    ("drop_efficiency_std", "consistency", "'Reliable'", "'Inconsistent'"),
    ("winner_rate_std", "consistency", "'Consistent'", "'Streaky'"),
    ("general_error_rate_std", "consistency", "'Composed'", "'Unpredictable'"),
    ("dink_error_rate_std", "consistency", "'Solid-Net'", "'Unpredictable'"),
]
_NOUNS = [
    ("drop_preference_rate_mean", "'Driver'", "'Dropper'"),
    ("net_game_preference_rate_mean", "'Power Player'", "'Net Player'"),
]

TABLES["traits"] = (
    ["centroids"],
    """SELECT skill_group, playstyle_cluster, label, feature, family, z,
  row_number() OVER (PARTITION BY skill_group, playstyle_cluster ORDER BY abs(z) DESC, place) AS nth
FROM (SELECT *, row_number() OVER (PARTITION BY skill_group, playstyle_cluster, family
        ORDER BY abs(z) DESC, place) AS in_family
  FROM ("""
    + "\n    UNION ALL ".join(
        f"SELECT skill_group, playstyle_cluster, {i} AS place, '{f}' AS feature, "
        f"'{family}' AS family, {f} AS z, CASE WHEN {f} >= 0 THEN {high} ELSE {low} END AS label "
        "FROM centroids"
        for i, (f, family, low, high) in enumerate(_TRAIT_WORDS)
    )
    + ")\n  WHERE label IS NOT NULL AND abs(z) >= 0.2)\nWHERE in_family = 1",
)

TABLES["nouns"] = (
    ["centroids"],
    f"""SELECT skill_group, playstyle_cluster,
  CASE WHEN greatest(abs({_NOUNS[0][0]}), abs({_NOUNS[1][0]})) < 0.2 THEN 'All-Court Player'
    WHEN abs({_NOUNS[0][0]}) >= abs({_NOUNS[1][0]})
      THEN CASE WHEN {_NOUNS[0][0]} >= 0 THEN {_NOUNS[0][2]} ELSE {_NOUNS[0][1]} END
    ELSE CASE WHEN {_NOUNS[1][0]} >= 0 THEN {_NOUNS[1][2]} ELSE {_NOUNS[1][1]} END END AS label,
  CASE WHEN greatest(abs({_NOUNS[0][0]}), abs({_NOUNS[1][0]})) < 0.2 THEN NULL
    WHEN abs({_NOUNS[0][0]}) >= abs({_NOUNS[1][0]}) THEN '{_NOUNS[0][0]}'
    ELSE '{_NOUNS[1][0]}' END AS feature,
  CASE WHEN greatest(abs({_NOUNS[0][0]}), abs({_NOUNS[1][0]})) < 0.2 THEN 0.0
    WHEN abs({_NOUNS[0][0]}) >= abs({_NOUNS[1][0]}) THEN {_NOUNS[0][0]}
    ELSE {_NOUNS[1][0]} END AS z
FROM centroids""",
)

# Evidence rows of a name, numbered from 0: traits first, noun last.
TABLES["evidence"] = (
    ["traits", "nouns"],
    """SELECT skill_group, playstyle_cluster, CAST(nth - 1 AS integer) AS position, label, feature,
  family, CASE WHEN z >= 0 THEN 'above' ELSE 'below' END AS direction,
  round_even(z * 1000.0, 0) / 1000.0 AS z
FROM traits
UNION ALL
SELECT skill_group, playstyle_cluster, CAST(coalesce(n, 0) AS integer), label, feature, 'identity',
  CASE WHEN z >= 0 THEN 'above' ELSE 'below' END, round_even(z * 1000.0, 0) / 1000.0
FROM nouns LEFT JOIN (SELECT skill_group, playstyle_cluster, count(*) AS n FROM traits GROUP BY ALL)
  USING (skill_group, playstyle_cluster)""",
)

TABLES["archetypes"] = (
    ["evidence"],
    """SELECT skill_group, playstyle_cluster, name || CASE WHEN nth > 1 THEN ' Type ' || nth ELSE '' END
  AS playstyle_archetype
FROM (SELECT *, row_number() OVER (PARTITION BY skill_group, name ORDER BY playstyle_cluster) AS nth
  FROM (SELECT skill_group, playstyle_cluster, CASE skill_group
      WHEN 'Developing / Lower-Performance' THEN 'Developing'
      WHEN 'Higher-Performance' THEN 'Advanced'
      ELSE replace(replace(skill_group, '-Performance', ''), 'Performance Group', 'Group') END
      || ' ' || string_agg(label, ' ' ORDER BY position) AS name
    FROM evidence GROUP BY skill_group, playstyle_cluster))""",
)

TABLES["final"] = (
    ["styled", "archetypes", "style"],
    "SELECT player_id, s.skill_score, skill_group, s.skill_cluster, playstyle_cluster,"
    " playstyle_archetype,\n  "
    + each(PLAYSTYLE_FEATURES, "style.{c}")
    + "\nFROM styled s JOIN archetypes USING (skill_group, playstyle_cluster)"
    + " LEFT JOIN style USING (player_id)",
)


TABLES["rated_with_missing"] = (
    ["profiles", "nation"],
    "SELECT profiles.* REPLACE (CASE WHEN nation <> 0 THEN drop_efficiency_mean END AS drop_efficiency_mean)"
    " FROM profiles JOIN nation USING (player_id)",
)
TABLES["scored_with_missing"] = (
    ["rated_with_missing"],
    TABLES["scored"][1].replace("profiles", "rated_with_missing"),
)

# ---- principal components ---------------------------------------------------

_N = len(PLAYSTYLE_FEATURES)

# Covariances as one list, row by row, then one component after another: the power of the matrix
# by repeated squaring tends to the outer product of its first eigenvector, which is taken away.
TABLES["matrix"] = (
    ["scaled_style"],
    "SELECT ["
    + ", ".join(f"covar_pop({a}, {b})" for a in PLAYSTYLE_FEATURES for b in PLAYSTYLE_FEATURES)
    + "] AS m, ["
    + ", ".join(f"avg({f})" for f in PLAYSTYLE_FEATURES)
    + "] AS means FROM scaled_style",
)


def _trace(m: str) -> str:
    return "(" + " + ".join(f"{m}[{_N * i + i + 1}]" for i in range(_N)) + ")"


_SQUARINGS = 30
_PRODUCT = (
    f"list_transform(range({_N * _N}), lambda ij: list_sum(list_transform(range({_N}), lambda q:"
    f" p[(ij // {_N}) * {_N} + q + 1] * p[q * {_N} + ij % {_N} + 1])))"
)
_DIAGONAL = "[" + ", ".join(f"p[{_N * i + i + 1}]" for i in range(_N)) + "]"
_COLUMN = f"list_transform(range({_N}), lambda i: p[i * {_N} + list_position({_DIAGONAL}, list_max({_DIAGONAL}))])"

TABLES["powers"] = (
    ["matrix"],
    f"""SELECT 0 AS component, 0 AS step, m, m AS p, CAST(NULL AS DOUBLE[]) AS v, CAST(NULL AS DOUBLE) AS variance
FROM matrix
UNION ALL
SELECT CASE WHEN step < {_SQUARINGS} THEN component ELSE component + 1 END,
  CASE WHEN step < {_SQUARINGS} THEN step + 1 ELSE 0 END,
  CASE WHEN step < {_SQUARINGS} THEN m ELSE rest END,
  CASE WHEN step < {_SQUARINGS} THEN list_transform(square, lambda x: x / {_trace("square")}) ELSE rest END,
  CASE WHEN step < {_SQUARINGS} THEN NULL ELSE unit END,
  CASE WHEN step < {_SQUARINGS} THEN NULL ELSE found END
FROM (SELECT *, list_transform(range({_N * _N}), lambda ij:
        m[ij + 1] - found * unit[ij // {_N} + 1] * unit[ij % {_N} + 1]) AS rest
  FROM (SELECT *, list_sum(list_transform(range({_N * _N}), lambda ij:
          unit[ij // {_N} + 1] * m[ij + 1] * unit[ij % {_N} + 1])) AS found
    FROM (SELECT *, list_transform(col, lambda x: x / sqrt(list_sum(list_transform(col, lambda y: y * y)))) AS unit
      FROM (SELECT component, step, m, p, {_PRODUCT} AS square, {_COLUMN} AS col
        FROM powers WHERE component < {_N}))))
WHERE {_trace("m")} > 1e-9""",
)

TABLES["eigen"] = (
    ["powers"],
    f"""SELECT component, list_transform(v, lambda x: x * sign(v[list_position(
    list_transform(v, lambda y: abs(y)), list_max(list_transform(v, lambda y: abs(y))))])) AS v,
  variance / total AS share,
  coalesce(sum(variance / total) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    < {MIN_SHARE} AS kept
FROM powers, (SELECT {_trace("m")} AS total FROM matrix) WHERE v IS NOT NULL""",
)

TABLES["component_points"] = (
    ["scaled_style", "eigen", "matrix"],
    f"""SELECT player_id, skill_group AS grp, list(score ORDER BY component) AS x
FROM (SELECT player_id, skill_group, component, list_sum(list_transform(range({_N}), lambda i:
    (z[i + 1] - means[i + 1]) * v[i + 1])) AS score
  FROM (SELECT player_id, skill_group, [{", ".join(PLAYSTYLE_FEATURES)}] AS z FROM scaled_style), eigen, matrix
  WHERE kept)
GROUP BY player_id, skill_group""",
)

# ---- K-Means from given starts, one pair of expressions a step --------------


def _k_means(name: str, points: str, seeds: list[int]) -> None:
    """Tables {name}_labels (player_id, grp, seed, k, label, d) and {name}_runs with silhouettes."""
    starts = ", ".join(
        f"({seed}, {k}, {j}, {(0.5 + seed / 200) * (2 * j / (k - 1) - 1)!r}::DOUBLE)"
        for seed in seeds
        for k in range(K_MIN, K_MAX + 1)
        for j in range(k)
    )
    TABLES[f"{name}_centres_0"] = (
        [points],
        f"""SELECT grp, seed, k, cluster, list_transform(range(n), lambda i: c) AS c
FROM (SELECT grp, min(len(x)) AS n, count(*) AS players FROM {points} GROUP BY grp),
  (VALUES {starts}) AS t(seed, k, cluster, c) WHERE k < players""",
    )
    for step in range(STEPS):
        nearest = f"{name}_nearest_{step}"
        TABLES[nearest] = _nearest(f"{name}_centres_{step}", points)
        TABLES[f"{name}_centres_{step + 1}"] = (
            [nearest, points],
            f"""SELECT grp, seed, k, cluster, list(a ORDER BY i) AS c
FROM (SELECT grp, seed, k, cluster, i, avg(v) AS a
  FROM (SELECT l.grp, seed, k, label AS cluster, unnest(x) AS v, unnest(range(len(x))) AS i
    FROM {nearest} l JOIN {points} USING (player_id))
  GROUP BY ALL)
GROUP BY grp, seed, k, cluster""",
        )
    _judged(name, points, f"{name}_centres_{STEPS}")


def _nearest(centres: str, points: str) -> tuple[list[str], str]:
    return (
        [centres, points],
        f"""SELECT player_id, grp, seed, k, arg_min(cluster, list_distance(x, c)) AS label,
  min(list_distance(x, c)) AS d
FROM {points} JOIN {centres} USING (grp) GROUP BY player_id, grp, seed, k""",
    )


def _judged(name: str, points: str, centres: str) -> None:
    """{name}_labels and {name}_runs of the models with these centres."""
    # Clusters are numbered by their centres.
    TABLES[f"{name}_final"] = (
        [centres],
        f"SELECT grp, seed, k, c, CAST(row_number() OVER (PARTITION BY grp, seed, k ORDER BY c) - 1"
        f" AS integer) AS cluster FROM {centres}",
    )
    TABLES[f"{name}_labels"] = _nearest(f"{name}_final", points)
    TABLES[f"{name}_runs"] = (
        [f"{name}_labels", points],
        f"""SELECT grp, seed, k, clusters, silhouette, cost,
  row_number() OVER (PARTITION BY grp, seed ORDER BY silhouette DESC, k) = 1 AS selected
FROM (SELECT grp, seed, k, CAST(count(DISTINCT own) AS integer) AS clusters,
    avg(CASE WHEN size = 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)
      AS silhouette
  FROM (SELECT grp, seed, k, id, own, max(n) FILTER (other = own) AS size,
      max(total / greatest(n - 1, 1)) FILTER (other = own) AS a,
      min(total / n) FILTER (other <> own) AS b
    FROM (SELECT p.grp, l.seed, l.k, p.id, mine.label AS own, l.label AS other, count(*) AS n, sum(p.d) AS total
      FROM (SELECT p.grp, p.player_id AS id, q.player_id AS other, list_distance(p.x, q.x) AS d
        FROM {points} p JOIN {points} q USING (grp)) p
      JOIN {name}_labels l ON l.player_id = p.other
      JOIN {name}_labels mine ON mine.player_id = p.id AND mine.seed = l.seed AND mine.k = l.k
      GROUP BY ALL)
    GROUP BY ALL)
  GROUP BY grp, seed, k)
JOIN (SELECT grp, seed, k, sum(d * d) AS cost FROM {name}_labels GROUP BY ALL) USING (grp, seed, k)""",
    )


# ---- K-Means from random restarts until they settle --------------------------

# Fixed values of the random numbers: the last one is the salt of k-means++.
N_INIT, MAX_ITER, TOLERANCE, ROUNDS, PLUS_PLUS_STEP, KEPT_DIGITS = 20, 300, 1e-4, 2, 1000, 6
_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _salt(*key: int) -> int:
    return int(np.random.SeedSequence(key).generate_state(1, np.uint64)[0])


def _uniforms(name: str, step: int) -> str:
    """A number between 0 and 1 for every point and restart: SplitMix64 of the hash and a salt."""
    mixed = f"SELECT grp, run, k, x, weight, xor(hash, salts[{step + 1}]) AS z FROM {name}_folded JOIN {name}_restarts USING (grp)"
    for shift, factor in zip((30, 27), _MULTIPLIERS):
        product = f"CAST(xor(z, z >> {shift}) AS UHUGEINT) * CAST({factor} AS UHUGEINT)"
        mixed = f"SELECT * REPLACE (CAST({product} % 18446744073709551616 AS UBIGINT) AS z) FROM ({mixed})"
    return f"(SELECT *, (CAST(xor(z, z >> 31) >> 11 AS DOUBLE) + 0.5) * pow(2, -53) AS u FROM ({mixed}))"


def _restarted_k_means(name: str, points: str, seeds: list[int]) -> None:
    """As ``_k_means``, of the best of 20 random restarts that run until they settle.

    Candidates are drawn in rounds with odds by weight and squared distance, k-means++ reduces them
    to K starts, and a restart ends when its centres hardly move.
    """
    keys = [(s, k, r) for s in seeds for k in range(K_MIN, K_MAX + 1) for r in range(N_INIT)]
    values = ",\n".join(
        f"({run}, {seed}, {k}, {restart}, [{', '.join(f'{_salt(seed, k, restart, step)}::UBIGINT' for step in range(ROUNDS + 1))}],"
        f" [{', '.join(map(repr, np.random.default_rng(_salt(seed, k, restart, PLUS_PLUS_STEP)).random(k).tolist()))}]::DOUBLE[])"
        for run, (seed, k, restart) in enumerate(keys)
    )
    power = "floor(log10(abs(v)))"
    number = f"floor(v * pow(10, {KEPT_DIGITS - 1} - {power}) + 0.5)"
    # Draws go by the digits of a point, since its last ones are noise, and its number among equals.
    TABLES[f"{name}_folded"] = (
        [points],
        f"""SELECT grp, x, weight, CAST('0x' || substr(md5(digits || ',' || copy), 1, 15) AS UBIGINT) AS hash
FROM (SELECT *, row_number() OVER (PARTITION BY grp, digits ORDER BY x) AS copy
  FROM (SELECT grp, x, count(*) AS weight, array_to_string(list_transform(x, lambda v: CASE WHEN v = 0 THEN '0,0'
      ELSE CAST({number} AS BIGINT) || ',' || CAST({power} AS BIGINT) END), ',') AS digits
    FROM {points} GROUP BY grp, x))""",
    )
    TABLES[f"{name}_restarts"] = (
        [points],
        f"""SELECT grp, tolerance, t.* FROM (VALUES {values}) AS t(run, seed, k, restart, salts, draws),
  (SELECT grp, count(*) AS players FROM {points} GROUP BY grp)
  JOIN (SELECT grp, avg(spread) * {TOLERANCE} AS tolerance
    FROM (SELECT grp, i, var_pop(v) AS spread
      FROM (SELECT grp, unnest(x) AS v, unnest(range(len(x))) AS i FROM {points}) GROUP BY grp, i) GROUP BY grp) USING (grp)
WHERE k < players""",
    )
    common = [f"{name}_folded", f"{name}_restarts"]
    TABLES[f"{name}_drawn_0"] = (
        common,
        f"""SELECT grp, run, k, [arg_max(x, ln(u) / weight)] AS drawn
FROM {_uniforms(name, 0)} GROUP BY grp, run, k""",
    )
    for step in range(1, ROUNDS + 1):
        before = f"{name}_drawn_{step - 1}"
        TABLES[f"{name}_drawn_{step}"] = (
            [before, *common],
            f"""SELECT grp, run, k, list_concat(drawn, coalesce(more, [])) AS drawn
FROM {before} LEFT JOIN (SELECT grp, run, list(x ORDER BY place) AS more
  FROM (SELECT grp, run, x, k, row_number() OVER (PARTITION BY grp, run ORDER BY ln(u) / (d * d * weight) DESC, x) AS place
    FROM (SELECT u.*, list_min(list_transform(drawn, lambda c: list_distance(x, c))) AS d
      FROM {_uniforms(name, step)} u JOIN {before} USING (grp, run))
    WHERE d * d > 1e-12)
  WHERE place <= 2 * k GROUP BY grp, run) USING (grp, run)""",
        )
    drawn = f"{name}_drawn_{ROUNDS}"
    TABLES[f"{name}_weighed"] = (
        [drawn, *common],
        f"""SELECT grp, run, draws, drawn, list_transform(range(len(drawn)), lambda i:
    coalesce(weights[list_position(places, i + 1)], 0)::DOUBLE) AS weights
FROM {drawn} JOIN (SELECT grp, run, list(place) AS places, list(weight) AS weights
  FROM (SELECT grp, run, list_position(ds, list_min(ds)) AS place, sum(weight) AS weight
    FROM (SELECT grp, run, weight, list_transform(drawn, lambda c: list_distance(x, c)) AS ds
      FROM {name}_folded JOIN {drawn} USING (grp))
    GROUP BY grp, run, place)
  GROUP BY grp, run) USING (grp, run) JOIN {name}_restarts USING (grp, run)""",
    )
    TABLES[f"{name}_started"] = (
        [f"{name}_weighed"],
        f"""SELECT grp, run, draws, drawn, weights, weights AS odds, CAST([] AS BIGINT[]) AS chosen FROM {name}_weighed
UNION ALL
SELECT grp, run, draws, drawn, weights, list_transform(range(len(drawn)), lambda i: weights[i + 1]
    * list_min(list_transform(picked, lambda p: list_distance(drawn[i + 1], drawn[p]) ** 2))), picked
FROM (SELECT *, list_append(chosen, list_position(list_transform(range(len(odds)), lambda i:
      list_sum(odds[1:i + 1]) / list_sum(odds) > draws[len(chosen) + 1]), true)) AS picked
  FROM {name}_started WHERE len(chosen) < len(draws) AND list_sum(odds) > 0)""",
    )
    sums = ", ".join(f"sum(weight * x[{i + 1}]) / sum(weight)" for i in range(_N))
    # A centre without points moves to the point that is worst served.
    TABLES[f"{name}_settled"] = (
        [f"{name}_started", *common],
        f"""SELECT grp, run, 0 AS step, true AS moving, list_transform(chosen, lambda i: drawn[i]) AS centres
FROM (SELECT grp, run, arg_max(chosen, len(chosen)) AS chosen, arg_max(drawn, len(chosen)) AS drawn
  FROM {name}_started GROUP BY grp, run)
UNION ALL
SELECT grp, run, step + 1, list_sum(list_transform(range(len(centres)), lambda j:
    list_distance(centres[j + 1], moved[j + 1]) ** 2)) > tolerance, moved
FROM (SELECT grp, run, step, centres, list_transform(range(1, len(centres) + 1), lambda j:
    coalesce(means[list_position(filled, j)], worst[j - len(list_filter(filled, lambda f: f <= j))].x, centres[j])) AS moved
  FROM (SELECT grp, run, step, centres, list(cluster) AS filled, list(mean) AS means,
      list_reverse_sort(flatten(list(far))) AS worst
    FROM (SELECT grp, run, step, centres, cluster, [{sums}][1:len(any_value(x))] AS mean,
        arg_max({{'d': d, 'x': x}}, d, {K_MAX}) AS far
      FROM (SELECT grp, run, step, centres, x, weight, list_position(ds, list_min(ds)) AS cluster, list_min(ds) AS d
        FROM (SELECT grp, run, step, centres, x, weight, list_transform(centres, lambda c: list_distance(x, c)) AS ds
          FROM {name}_settled JOIN {name}_folded USING (grp) WHERE moving AND step < {MAX_ITER}))
      GROUP BY grp, run, step, centres, cluster)
    GROUP BY grp, run, step, centres))
JOIN {name}_restarts USING (grp, run)""",
    )
    TABLES[f"{name}_best"] = (
        [f"{name}_settled", *common],
        f"""SELECT grp, seed, k, unnest(list_filter(centres, lambda c, i: list_contains(filled, i))) AS c
FROM (SELECT grp, seed, k, arg_min(centres, (cost, restart)) AS centres, arg_min(filled, (cost, restart)) AS filled
  FROM (SELECT grp, run, centres, sum(weight * d * d) AS cost, list(DISTINCT cluster) AS filled
    FROM (SELECT grp, run, centres, weight, list_min(ds) AS d, list_position(ds, list_min(ds)) AS cluster
      FROM (SELECT grp, run, centres, weight, list_transform(centres, lambda c: list_distance(x, c)) AS ds
        FROM (SELECT grp, run, arg_max(centres, step) AS centres FROM {name}_settled GROUP BY grp, run)
        JOIN {name}_folded USING (grp)))
    GROUP BY grp, run, centres)
  JOIN {name}_restarts USING (grp, run) GROUP BY grp, seed, k)""",
    )
    _judged(name, points, f"{name}_best")


TABLES["skill_points"] = (
    ["clustering"],
    f"SELECT player_id, 'all' AS grp, [{', '.join(SKILL_FEATURES)}] AS x FROM clustering",
)
_k_means("skill", "skill_points", [SEED])
_k_means("style", "component_points", [SEED])
_restarted_k_means("stable", "component_points", STABILITY_SEEDS)

_RUN_COLUMNS = ("silhouette", "cost")

# Agreement of every seed's chosen labels with those of the first seed, by the pairs of players.
TABLES["stable_chosen"] = (
    ["stable_runs"],
    f"""SELECT c.*, c.k <> f.k AS k_differs, c.k = f.k AND c.seed <> {STABILITY_SEEDS[0]} AS compared
FROM stable_runs c JOIN (SELECT grp, k FROM stable_runs WHERE selected AND seed = {STABILITY_SEEDS[0]}) f USING (grp)
WHERE selected""",
)
TABLES["stable_cells"] = (
    ["stable_chosen", "stable_labels"],
    f"""SELECT c.grp, c.seed, f.label AS a, l.label AS b, CAST(count(*) AS double) AS n
FROM stable_chosen c JOIN stable_labels l ON l.grp = c.grp AND l.seed = c.seed AND l.k = c.k
JOIN stable_labels f ON f.player_id = l.player_id AND f.seed = {STABILITY_SEEDS[0]} AND f.k = c.k
WHERE c.compared GROUP BY ALL""",
)
TABLES["stable_agreement"] = (
    ["stable_cells"],
    """SELECT grp, seed, CASE WHEN (in_a + in_b) / 2 - in_a * in_b / everything = 0 THEN 1.0
  ELSE (both_in - in_a * in_b / everything) / ((in_a + in_b) / 2 - in_a * in_b / everything) END AS ari
FROM (SELECT grp, seed, sum(n * (n - 1) / 2) AS both_in, sum(n) * (sum(n) - 1) / 2 AS everything
    FROM stable_cells GROUP BY ALL)
JOIN (SELECT grp, seed, sum(n * (n - 1) / 2) AS in_a
    FROM (SELECT grp, seed, a, sum(n) AS n FROM stable_cells GROUP BY ALL) GROUP BY ALL) USING (grp, seed)
JOIN (SELECT grp, seed, sum(n * (n - 1) / 2) AS in_b
    FROM (SELECT grp, seed, b, sum(n) AS n FROM stable_cells GROUP BY ALL) GROUP BY ALL) USING (grp, seed)""",
)

# ---- the whole analysis: the same tables over groups and styles that were found -------------

_FOUND = [
    "residuals", "scaled_style", "matrix", "powers", "eigen", "component_points", "centroids",
    "traits", "nouns", "evidence", "archetypes", "final", "grouped", "styled",
]


def _found(text: str) -> str:
    return re.sub(r"\b(" + "|".join(_FOUND) + r")\b", r"found_\1", text)


for _name in _FOUND[:-2]:
    _needs, _sql = TABLES[_name]
    TABLES[_found(_name)] = ([_found(n) for n in _needs], _found(_sql))
_k_means("found_style", "found_component_points", [SEED])

TABLES["found_grouped"] = (
    ["skill_labels", "skill_runs", "scored", "nation"],
    """SELECT player_id, skill_score, skill_cluster, CASE
    WHEN n IN (2, 3) AND position = 1 THEN 'Developing / Lower-Performance'
    WHEN n IN (2, 3) AND position = n THEN 'Higher-Performance'
    WHEN n = 3 THEN 'Intermediate-Performance'
    ELSE 'Performance Group ' || position END AS skill_group
FROM (SELECT player_id, label AS skill_cluster FROM skill_labels JOIN skill_runs USING (grp, seed, k) WHERE selected)
JOIN scored USING (player_id)
JOIN (SELECT skill_cluster, count(*) OVER () AS n, row_number() OVER (ORDER BY points, skill_cluster) AS position
  FROM (SELECT label AS skill_cluster, avg(rally_points) AS points
    FROM skill_labels JOIN skill_runs USING (grp, seed, k) JOIN nation USING (player_id)
    WHERE selected GROUP BY label)) USING (skill_cluster)""",
)
TABLES["found_styled"] = (
    ["found_scaled_style", "found_style_labels", "found_style_runs"],
    """SELECT s.*, label AS playstyle_cluster FROM found_scaled_style s
JOIN found_style_labels l USING (player_id) JOIN found_style_runs r USING (grp, seed, k) WHERE selected""",
)


def with_tables(wanted: list[str], select: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in TABLES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in wanted:
        visit(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED (\n{TABLES[name][1]}\n)" for name in order)
    return f"WITH RECURSIVE {parts}\n{select}" if parts else select


def _distance(center: float) -> str:
    return " + ".join(f"({f} - ({center})) * ({f} - ({center}))" for f in SKILL_FEATURES)


def _pair_distance() -> str:
    return " + ".join(f"(p.{f} - q.{f}) * (p.{f} - q.{f})" for f in SKILL_FEATURES)


def _silhouette(label: str) -> str:
    """Mean silhouette straight from the definition: all pairs of players."""
    return f"""SELECT '{label}' AS labeling, CAST(count(DISTINCT own) AS integer) AS clusters,
  round(avg(CASE WHEN size = 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
    ELSE (b - a) / greatest(a, b) END), {DIGITS}) + 0.0 AS silhouette
FROM (SELECT id, own, max(size) FILTER (other = own) AS size,
    max(total / greatest(size - 1, 1)) FILTER (other = own) AS a,
    min(total / size) FILTER (other <> own) AS b
  FROM (SELECT p.player_id AS id, p.{label} AS own, q.{label} AS other, count(*) AS size,
      sum(sqrt({_pair_distance()})) AS total
    FROM labelled p, labelled q GROUP BY p.player_id, p.{label}, q.{label})
  GROUP BY id, own)"""


def _pairs(n: str) -> str:
    return f"(CAST({n} AS double) * ({n} - 1) / 2.0)"


_GROUPED = "skill_score, skill_cluster, skill_group"

# ---- parameters fitted on players with even ids, applied to all -------------

_EVEN = "player_id % 2 = 0"

TABLES["even_scored"] = (
    ["profiles"],
    f"""SELECT player_id,
  round_even((({_normalised(_METRICS[0])}) * CAST(0.25 AS double)
    + ({_normalised(_METRICS[1])}) * CAST(0.30 AS double)
    + (1.0 - ({_normalised(_METRICS[2])})) * CAST(0.20 AS double)
    + (1.0 - ({_normalised(_METRICS[3])})) * CAST(0.25 AS double)) * 100.0 * 100.0, 0) / 100.0 AS skill_score
FROM profiles, (SELECT {each(_METRICS, "min({c}) AS lo_{c}, max({c}) AS hi_{c}")} FROM profiles WHERE {_EVEN})""",
)
TABLES["even_scaled"] = (
    ["oriented"],
    _z(SKILL_FEATURES, "oriented").removesuffix("FROM oriented)") + f"FROM oriented WHERE {_EVEN})",
)
TABLES["even_residuals"] = (
    ["grouped", "style"],
    TABLES["residuals"][1].replace(
        "FROM grouped JOIN style USING (player_id) GROUP BY",
        f"FROM grouped JOIN style USING (player_id) WHERE {_EVEN} GROUP BY",
    ),
)
_styles = "player_id, skill_score, skill_cluster, skill_group"
TABLES["even_scaled_style"] = (
    ["even_residuals"],
    _z(PLAYSTYLE_FEATURES, "even_residuals", _styles).removesuffix("FROM even_residuals)")
    + f"FROM even_residuals WHERE {_EVEN})",
)
_PCA = ["scaled_style", "matrix", "powers", "eigen", "component_points"]
for _name in _PCA[1:]:
    _needs, _sql = TABLES[_name]
    _sql = re.sub(r"\b(" + "|".join(_PCA) + r")\b", r"even_\1", _sql)
    TABLES[f"even_{_name}"] = (
        [f"even_{n}" for n in _needs],
        _sql + f" WHERE {_EVEN}" if _name == "matrix" else _sql,
    )

ORACLE_SQL: dict[str, str] = {
    "match_features": with_tables(
        ["rates"],
        "SELECT player_id, match_id, drop_attempts, unforced_errors, dink_errors, uses_stacking,"
        " total_winners, " + rounded(["match_duration_mins", *RATE_PREFIXES]) + " FROM rates",
    ),
    "player_profiles": with_tables(
        ["profiles"],
        f"SELECT player_id, match_count, {rounded(PROFILE_COLUMNS)} FROM profiles",
    ),
    "skill_scores": with_tables(["scored"], "SELECT player_id, skill_score FROM scored"),
    "skill_tiers": with_tables(["scored"], "SELECT player_id, skill_score, skill_tier FROM scored"),
    "skill_tiers_with_missing": with_tables(
        ["scored_with_missing"], "SELECT player_id, skill_score, skill_tier FROM scored_with_missing"
    ),
    "one_group_selection": with_tables(
        ["style_runs"],
        "SELECT grp AS skill_group, seed, k, clusters, selected, round(silhouette, 6) + 0.0 AS silhouette,"
        " round(cost, 6) + 0.0 AS cost FROM style_runs WHERE grp = 'Higher-Performance'",
    ),
    "new_player_scores": with_tables(
        ["even_scored", "even_scaled"],
        f"""SELECT player_id, skill_score, {rounded(SKILL_FEATURES)},
  CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS integer) AS cluster
FROM (SELECT *, {_distance(-0.5)} AS d0, {_distance(0.0)} AS d1, {_distance(0.5)} AS d2 FROM even_scaled)
JOIN even_scored USING (player_id)""",
    ),
    "new_player_components": with_tables(
        ["even_component_points"],
        """SELECT player_id, component, round(score, 6) + 0.0 AS score
FROM (SELECT player_id, unnest(x) AS score, unnest(range(1, len(x) + 1))::INTEGER AS component
  FROM even_component_points)""",
    ),
    "skill_summary": with_tables(
        ["scored"],
        f"""SELECT count(*) AS players, {r("avg(skill_score)", "average_skill_score")},
  {r("min(skill_score)", "minimum_skill_score")}, {r("max(skill_score)", "maximum_skill_score")}
FROM scored""",
    ),
    "tier_counts": with_tables(
        ["scored"],
        """SELECT tiers.skill_tier, count(scored.player_id) AS players
FROM (VALUES ('Beginner'), ('Intermediate'), ('Professional')) tiers(skill_tier)
LEFT JOIN scored ON scored.skill_tier = tiers.skill_tier GROUP BY tiers.skill_tier""",
    ),
    "skill_profile_samples": with_tables(
        ["scored"],
        f"""SELECT player_id, skill_tier, {rounded(["skill_score", *_METRICS])}
FROM scored ORDER BY player_id LIMIT 10""",
    ),
    "ml_features": with_tables(["ml"], f"SELECT player_id, {rounded(SKILL_FEATURES)} FROM ml"),
    "oriented_features": with_tables(
        ["oriented"], f"SELECT player_id, {rounded(SKILL_FEATURES)} FROM oriented"
    ),
    "orientation_report": with_tables(
        ["ml", "oriented"],
        rows(
            DIRECTION_FEATURES,
            f"""SELECT ml.player_id, '{{c}}' AS feature, round(ml.{{c}}, {DIGITS}) + 0.0 AS original,
  round(oriented.{{c}}, {DIGITS}) + 0.0 AS oriented
FROM ml JOIN oriented USING (player_id) WHERE ml.player_id = (SELECT min(player_id) FROM ml)""",
        ),
    ),
    "feature_information": with_tables(
        ["ml"],
        rows(
            SKILL_FEATURES,
            "SELECT '{c}' AS feature, CASE WHEN '{c}' LIKE '%_mean' THEN 'MEAN' ELSE 'CONSISTENCY' END"
            " AS kind, count(*) AS players FROM ml",
        ),
    ),
    "feature_summary": with_tables(
        ["ml"],
        rows(
            SKILL_FEATURES,
            f"""SELECT '{{c}}' AS feature, {r("avg({c})", "mean")}, {r("stddev_samp({c})", "std")},
  {r("min({c})", "min")}, {r("max({c})", "max")} FROM ml""",
        ),
    ),
    "scaled_features": with_tables(
        ["scaled"], f"SELECT player_id, {rounded(SKILL_FEATURES)} FROM scaled"
    ),
    "scaler_parameters": with_tables(
        ["oriented"],
        rows(
            SKILL_FEATURES,
            f"""SELECT '{{c}}' AS feature, {r("avg({c})", "mean")},
  {r("CASE WHEN stddev_pop({c}) < 1e-12 THEN 1.0 ELSE stddev_pop({c}) END", "scale")} FROM oriented""",
        ),
    ),
    "scaling_summary": with_tables(
        ["scaled"],
        rows(
            SKILL_FEATURES,
            f"""SELECT '{{c}}' AS feature, {r("avg({c})", "mean")}, {r("stddev_samp({c})", "std")}
FROM scaled""",
        ),
    ),
    "clustering_input": with_tables(
        ["clustering"],
        f"SELECT player_id, {rounded(['skill_score', *SKILL_FEATURES])} FROM clustering",
    ),
    "clustering_input_summary": with_tables(
        ["clustering"],
        rows(
            SKILL_FEATURES,
            f"SELECT count(*) AS players, {len(SKILL_FEATURES)} AS features, '{{c}}' AS feature"
            " FROM clustering",
        ),
    ),
    "clustering_samples": with_tables(
        ["clustering"],
        f"""SELECT player_id, {rounded(["skill_score", *SKILL_FEATURES])}
FROM clustering ORDER BY player_id LIMIT 5""",
    ),
    "skill_k_selection": with_tables(
        ["skill_runs"],
        f"SELECT seed, k, clusters, selected, {rounded(_RUN_COLUMNS)} FROM skill_runs",
    ),
    "skill_clusters": with_tables(
        ["skill_runs", "skill_labels"],
        """SELECT label AS skill_cluster, count(*) AS players
FROM skill_labels JOIN skill_runs USING (grp, seed, k) WHERE selected GROUP BY label""",
    ),
    "playstyle_components": with_tables(
        ["component_points"],
        """SELECT player_id, component, round(score, 6) + 0.0 AS score
FROM (SELECT player_id, unnest(x) AS score, unnest(range(1, len(x) + 1))::INTEGER AS component
  FROM component_points)""",
    ),
    "playstyle_loadings": with_tables(
        ["eigen", "matrix"],
        f"""SELECT component, ['{"', '".join(PLAYSTYLE_FEATURES)}'][i] AS feature, round(v[i], 6) + 0.0 AS loading,
  round(means[i], 6) + 0.0 AS mean, round(share, 6) + 0.0 AS explained_share
FROM (SELECT component, v, share, means, unnest(range(1, {_N + 1})) AS i FROM eigen, matrix WHERE kept)""",
    ),
    "playstyle_k_selection": with_tables(
        ["style_runs"],
        "SELECT grp AS skill_group, seed, k, clusters, selected, round(silhouette, 6) + 0.0 AS silhouette,"
        " round(cost, 6) + 0.0 AS cost FROM style_runs",
    ),
    "playstyle_stability": with_tables(
        ["stable_chosen", "stable_agreement"],
        """SELECT grp AS skill_group, seed, k, k_differs, round(silhouette, 6) + 0.0 AS silhouette,
  round(ari, 6) + 0.0 AS ari, runs, most_common_k, most_common_count,
  round(average_silhouette, 6) + 0.0 AS average_silhouette, round(silhouette_std, 6) + 0.0 AS silhouette_std
FROM stable_chosen LEFT JOIN stable_agreement USING (grp, seed)
JOIN (SELECT grp, count(*) AS runs, avg(silhouette) AS average_silhouette,
    stddev_pop(silhouette) AS silhouette_std FROM stable_chosen GROUP BY grp) USING (grp)
JOIN (SELECT grp, k AS most_common_k, n AS most_common_count
  FROM (SELECT grp, k, count(*) AS n, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, k) AS place
    FROM stable_chosen GROUP BY grp, k) WHERE place = 1) USING (grp)""",
    ),
    "player_archetypes": with_tables(
        ["found_final"],
        f"""SELECT player_id, skill_group, skill_cluster, playstyle_cluster, playstyle_archetype,
  {rounded(["skill_score", *PLAYSTYLE_FEATURES])} FROM found_final""",
    ),
    "playstyle_clusters": with_tables(
        ["style_runs", "style_labels"],
        """SELECT grp AS skill_group, label AS playstyle_cluster, count(*) AS players
FROM style_labels JOIN style_runs USING (grp, seed, k) WHERE selected GROUP BY grp, label""",
    ),
    "nearest_centre": with_tables(
        ["scaled"],
        f"""SELECT CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS integer)
    AS cluster, count(*) AS players, {each(SKILL_FEATURES, r("avg({c})", "{c}"))}
FROM (SELECT *, {_distance(-0.5)} AS d0, {_distance(0.0)} AS d1, {_distance(0.5)} AS d2 FROM scaled)
GROUP BY 1""",
    ),
    "skill_group_names": with_tables(
        ["nation"],
        "\nUNION ALL\n".join(
            f"SELECT {n} AS clusters, skill_cluster, skill_group FROM ("
            + _labels(n).replace("{source}", "nation")
            + ")"
            for n in (2, 3, 4)
        ),
    ),
    "skill_groups_applied": with_tables(["grouped"], f"SELECT player_id, {_GROUPED} FROM grouped"),
    "skill_cluster_profiles": with_tables(
        ["ml", "scored", "nation"],
        f"""SELECT CAST(nation % 2 AS integer) AS skill_cluster, count(*) AS players,
  {r("avg(skill_score)", "average_skill_score")},
  {each(SKILL_FEATURES, r("avg(ml.{c})", "{c}"))}
FROM ml JOIN scored USING (player_id) JOIN nation USING (player_id) GROUP BY 1""",
    ),
    "skill_group_summary": with_tables(
        ["grouped"],
        f"""SELECT skill_cluster, skill_group, count(player_id) AS players,
  {r("avg(skill_score)", "average_skill_score")}, {r("min(skill_score)", "minimum_skill_score")},
  {r("max(skill_score)", "maximum_skill_score")}
FROM grouped GROUP BY skill_cluster, skill_group""",
    ),
    "silhouette_scores": with_tables(
        ["scaled", "nation"],
        "SELECT * FROM (WITH labelled AS MATERIALIZED (SELECT scaled.*, CAST(nation % 3 AS integer)"
        " AS by_nation, CAST(winner_rate_mean > 0 AS integer) AS by_winners"
        " FROM scaled JOIN nation USING (player_id))\n"
        + _silhouette("by_nation") + "\nUNION ALL\n" + _silhouette("by_winners") + ")",
    ),
    "adjusted_rand": with_tables(
        ["scaled", "nation"],
        f"""SELECT skill_cluster, {r('''CASE WHEN (in_a + in_b) / 2.0 - in_a * in_b / everything = 0 THEN 1.0
    ELSE (both_in - in_a * in_b / everything) / ((in_a + in_b) / 2.0 - in_a * in_b / everything) END''', "ari")}
FROM (SELECT skill_cluster, sum({_pairs("n")}) AS both_in, {_pairs("sum(n)")} AS everything
    FROM cells GROUP BY skill_cluster)
JOIN (SELECT skill_cluster, sum({_pairs("n")}) AS in_a
    FROM (SELECT skill_cluster, a, sum(n) AS n FROM cells GROUP BY ALL) GROUP BY skill_cluster) USING (skill_cluster)
JOIN (SELECT skill_cluster, sum({_pairs("n")}) AS in_b
    FROM (SELECT skill_cluster, b, sum(n) AS n FROM cells GROUP BY ALL) GROUP BY skill_cluster) USING (skill_cluster)""",
    ).replace(
        "\nSELECT skill_cluster, round",
        """,
cells AS MATERIALIZED (
SELECT CAST(nation % 2 AS integer) AS skill_cluster, CAST(winner_rate_mean > 0 AS integer) AS a,
  CAST(winner_rate_mean > 0.5 AS integer) + CAST(aggression_mean > 0 AS integer) AS b, count(*) AS n
FROM scaled JOIN nation USING (player_id) GROUP BY ALL
)
SELECT skill_cluster, round""",
    ),
    "playstyle_features": with_tables(
        ["style"], f"SELECT player_id, {rounded(PLAYSTYLE_FEATURES)} FROM style"
    ),
    "residualized_features": with_tables(
        ["residuals"],
        f"""SELECT player_id, skill_cluster, skill_group,
  {rounded(["skill_score", *PLAYSTYLE_FEATURES])} FROM residuals""",
    ),
    "scaled_playstyle": with_tables(
        ["scaled_style"], f"SELECT player_id, {rounded(PLAYSTYLE_FEATURES)} FROM scaled_style"
    ),
    "playstyle_covariance": with_tables(
        ["scaled_style"],
        "\nUNION ALL\n".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'covar_pop({a}, {b})', 'covariance')}"
            " FROM scaled_style"
            for i, a in enumerate(PLAYSTYLE_FEATURES)
            for b in PLAYSTYLE_FEATURES[i:]
        ),
    ),
    "playstyle_clustering_input": with_tables(
        ["scaled_style"],
        f"""SELECT player_id, skill_cluster, skill_group,
  {rounded(["skill_score", *PLAYSTYLE_FEATURES])} FROM scaled_style""",
    ),
    "playstyle_centroids": with_tables(
        ["raw_centroids"],
        f"SELECT skill_group, playstyle_cluster, {rounded(PLAYSTYLE_FEATURES)} FROM raw_centroids",
    ),
    "playstyle_cluster_profiles": with_tables(
        ["raw_centroids", "styled"],
        f"""SELECT skill_group, playstyle_cluster, players, average_skill_score,
  {rounded(PLAYSTYLE_FEATURES)}
FROM raw_centroids JOIN (SELECT skill_group, playstyle_cluster, count(*) AS players,
    {r("avg(skill_score)", "average_skill_score")} FROM styled GROUP BY ALL)
  USING (skill_group, playstyle_cluster)""",
    ),
    "scaled_centroids": with_tables(
        ["centroids"],
        f"SELECT skill_group, playstyle_cluster, {rounded(PLAYSTYLE_FEATURES)} FROM centroids",
    ),
    "playstyle_traits": with_tables(
        ["evidence"],
        """SELECT skill_group, playstyle_cluster, position, label, feature, family, direction, z
FROM evidence WHERE family <> 'identity'""",
    ),
    "archetype_names": with_tables(
        ["archetypes"], "SELECT skill_group, playstyle_cluster, playstyle_archetype FROM archetypes"
    ),
    "archetypes_applied": with_tables(
        ["styled", "archetypes", "evidence"],
        """SELECT player_id, skill_group, playstyle_cluster, playstyle_archetype, position, label,
  feature, family, direction, z
FROM styled JOIN archetypes USING (skill_group, playstyle_cluster)
JOIN evidence USING (skill_group, playstyle_cluster)""",
    ),
    "archetype_summary": with_tables(
        ["styled", "archetypes"],
        f"""SELECT skill_group, playstyle_cluster, playstyle_archetype, count(*) AS players,
  {r("avg(skill_score)", "average_skill_score")}
FROM styled JOIN archetypes USING (skill_group, playstyle_cluster) GROUP BY ALL""",
    ),
    "archetype_evidence": with_tables(
        ["raw_centroids", "archetypes"],
        f"""SELECT skill_group, playstyle_cluster, playstyle_archetype, {rounded(EVIDENCE_FEATURES)}
FROM raw_centroids JOIN archetypes USING (skill_group, playstyle_cluster)""",
    ),
    "final_profiles": with_tables(
        ["final"],
        f"""SELECT player_id, skill_group, skill_cluster, playstyle_cluster, playstyle_archetype,
  {rounded(["skill_score", *PLAYSTYLE_FEATURES])} FROM final""",
    ),
    "final_profile_samples": with_tables(
        ["final"],
        f"""SELECT player_id, skill_group, skill_cluster, playstyle_cluster, playstyle_archetype,
  {rounded(["skill_score", *FINAL_REPORT_FEATURES])} FROM final ORDER BY player_id LIMIT 20""",
    ),
}

# Queries that come to a result of another one by another way.
ORACLE_SQL |= {
    "player_profiles_appended": ORACLE_SQL["player_profiles"],
    "scaler_parameters_merged": ORACLE_SQL["scaler_parameters"],
    "clustering_input_bucketed": ORACLE_SQL["clustering_input"],
    "skill_group_names_ranked": ORACLE_SQL["skill_group_names"],
    "playstyle_k_selection_by_group": ORACLE_SQL["playstyle_k_selection"],
    "nearest_of_many": with_tables(
        ["scaled"],
        f"""SELECT a.player_id, arg_min(b.player_id, ({" + ".join(f"(a.{c} - b.{c}) ** 2" for c in SKILL_FEATURES)}, b.player_id)) AS cluster
FROM scaled a, scaled b WHERE b.player_id % 7 = 0 GROUP BY a.player_id""",
    ),
    "missing_columns": f"""SELECT feature FROM (SELECT unnest({["c_custkey", *SKILL_FEATURES]}) AS feature)
WHERE feature NOT IN (SELECT unnest(['c_custkey', 'aggression_mean']) WHERE (SELECT count(*) FROM customer) >= 0)""",
    "small_groups": """SELECT c_nationkey || '/' || floor(c_acctbal / 1000)::BIGINT AS skill_group, count(*) AS players
FROM customer GROUP BY 1 HAVING count(*) < 3""",
}
