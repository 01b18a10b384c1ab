"""Registered queries against their SQL on the smallest tables, and the shape of their plans."""

import os

import pytest
from check_oracle import compare, duck

import __spark_entry__ as entry
from registry.oracle import ORACLE_SQL
from registry.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profiles_need_two_key_shuffles_and_read_only_used_columns(spark):
    from courtlens.operators.profiles import aggregate_player_profiles
    from courtlens.sources.order_logs import match_logs

    spark.catalog.clearCache()
    text = plan(aggregate_player_profiles(match_logs(spark, SF)))
    assert "l_extendedprice" not in text and "o_totalprice" not in text
    assert "partial_avg" in text and "partial_stddev_samp" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_global_statistics_are_subqueries_not_joins(spark, micro_logs):
    from courtlens.operators.features import create_ml_features, scale_ml_features
    from courtlens.operators.profiles import aggregate_player_profiles
    from courtlens.operators.skill import build_skill_model

    profiles = aggregate_player_profiles(micro_logs)
    for df in (build_skill_model(profiles), scale_ml_features(create_ml_features(profiles))[0]):
        text = plan(df)
        assert "Subquery" in text and "Join" not in text and "Window" not in text


def test_small_tables_are_broadcast_and_players_not_shuffled(spark, micro_logs):
    from pyspark.sql import functions as F

    from courtlens.operators.features import residualize_playstyle_features

    players = spark.range(100).select(
        F.col("id").cast("string").alias("player_id"),
        F.when(F.col("id") % 3 > 0, "most").otherwise("rest").alias("skill_group"),
        F.rand(1).alias("skill_score"),
        F.rand(2).alias("aggression_mean"),
    )
    text = plan(residualize_playstyle_features(players, ["aggression_mean"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
