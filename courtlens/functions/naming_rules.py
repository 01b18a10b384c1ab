"""Vocabulary and rules that turn a cluster's z centroid into words, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtlens.functions.expressions import round_half_even
from courtlens.schema import TRAITS_TYPE

# ---- Fixed values: names ----------------------------------------------------

DEVELOPING = "Developing / Lower-Performance"
INTERMEDIATE = "Intermediate-Performance"
HIGHER = "Higher-Performance"

# skill group -> word that opens an archetype name
GROUP_PREFIXES = {
    DEVELOPING: "Developing",
    HIGHER: "Advanced",
}

# (feature, family, word for a low value, word for a high value), in order of precedence
TRAITS = [
    ("drop_efficiency_mean", "precision", None, "Precise"),
    ("error_to_winner_ratio", "precision", "Clean", None),
    ("aggression_std", "consistency", "Steady", "Unpredictable"),
    ("drop_efficiency_std", "consistency", "Reliable", "Inconsistent"),
    ("winner_rate_std", "consistency", "Consistent", "Streaky"),
    ("general_error_rate_std", "consistency", "Composed", "Unpredictable"),
    ("dink_error_rate_std", "consistency", "Solid-Net", "Unpredictable"),
]

# (feature, noun for a low value, noun for a high value), in order of precedence
IDENTITIES = [
    ("drop_preference_rate_mean", "Driver", "Dropper"),
    ("net_game_preference_rate_mean", "Power Player", "Net Player"),
]
DEFAULT_IDENTITY = "All-Court Player"

# Smallest |z| worth a word.
MEANINGFUL_EFFECT = 0.2

# -----------------------------------------------------------------------------

FAMILIES = len({family for _, family, _, _ in TRAITS})
_ENTRY = TRAITS_TYPE.elementType.simpleString()


def group_prefix(skill_group: Column) -> Column:
    """Opening word of a name; groups without a fixed word keep a shortened label."""
    shortened = F.replace(
        F.replace(skill_group, F.lit("-Performance"), F.lit("")),
        F.lit("Performance Group"),
        F.lit("Group"),
    )
    prefix = F
    for label, word in GROUP_PREFIXES.items():
        prefix = prefix.when(skill_group == label, word)
    return prefix.otherwise(shortened)


def _direction(z: Column) -> Column:
    return F.when(z >= 0, "above").otherwise("below")


def _evidence(label: Column, feature: Column, family: str, z: Column) -> Column:
    return F.struct(
        label.alias("label"),
        feature.alias("feature"),
        F.lit(family).alias("family"),
        _direction(z).alias("direction"),
        z.alias("z"),
    )


def ranked_traits() -> Column:
    """All traits that have a word on their side, strongest first, unrounded z.

    Structs compare field by field, so ordering by (-|z|, precedence) is a plain array sort.
    """
    candidates = []
    for position, (feature, family, low, high) in enumerate(TRAITS):
        z = F.col(feature)
        word = F.when(z >= 0, F.lit(high)).when(z < 0, F.lit(low))
        candidates.append(
            F.struct(
                (-F.abs(z)).alias("rank"),
                F.lit(position).alias("position"),
                _evidence(word, F.lit(feature), family, z).alias("trait"),
            )
        )
    worded = F.filter(F.array(*candidates), lambda c: c["trait"]["label"].isNotNull())
    return F.transform(F.array_sort(worded), lambda c: c["trait"])


def choose_traits(max_traits: int = 2) -> Column:
    """The strongest meaningful trait per family, at most ``max_traits``; z to 3 decimals."""
    meaningful = F.filter(ranked_traits(), lambda t: F.abs(t["z"]) >= MEANINGFUL_EFFECT)
    first_per_family = F.filter(
        meaningful,
        lambda t, i: ~F.exists(F.slice(meaningful, 1, i), lambda s: s["family"] == t["family"]),
    )
    return F.transform(
        F.slice(first_per_family, 1, max_traits),
        lambda t: t.withField("z", round_half_even(t["z"], 3)),
    ).cast(f"array<{_ENTRY}>")


def pick_identity() -> Column:
    """Evidence entry of the noun: the identity feature with the larger |z|, if meaningful."""
    candidates = []
    for position, (feature, low, high) in enumerate(IDENTITIES):
        z = F.col(feature)
        noun = F.when(z >= 0, high).otherwise(low)
        candidates.append(
            F.struct(
                (-F.abs(z)).alias("rank"),
                F.lit(position).alias("position"),
                _evidence(noun, F.lit(feature), "identity", z).alias("identity"),
            )
        )
    meaningful = F.array_sort(
        F.filter(F.array(*candidates), lambda c: -c["rank"] >= MEANINGFUL_EFFECT)
    )
    fallback = _evidence(
        F.lit(DEFAULT_IDENTITY), F.lit(None).cast("string"), "identity", F.lit(0.0)
    )
    strongest = F.get(meaningful, F.lit(0))["identity"]
    chosen = F.coalesce(strongest, fallback)
    return chosen.withField("z", round_half_even(chosen["z"], 3)).cast(_ENTRY)


def describe_name(max_traits: int = 2) -> Column:
    """All evidence of a name: its traits, then its noun."""
    return F.concat(choose_traits(max_traits), F.array(pick_identity()))


def archetype_name(skill_group: Column, evidence: Column) -> Column:
    """"{prefix} {traits} {noun}" from the evidence entries."""
    words = F.transform(evidence, lambda e: e["label"])
    return F.concat_ws(" ", group_prefix(skill_group), words)
