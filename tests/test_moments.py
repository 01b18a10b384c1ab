import numpy as np
import pytest
from pyspark.sql import functions as F

from courtlens.operators import features, naming, selection
from courtlens.operators.components import fit_components
from courtlens.operators.fitted import residual_lines
from courtlens.operators.moments import (
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
from courtlens.operators.profiles import aggregate_player_profiles
from courtlens.sources.player_tables import drop_player_table, save_by_player

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) @ np.array([[1, 0.5, 0], [0, 1, 2], [0, 0, 0.1]]) + [1e7, -3, 0.5]
    rows = [(i, *map(float, r), "gh"[i % 2] if i < 380 else "few" if i < 382 else None) for i, r in enumerate(x)]
    rows.append((1000, None, 1.0, 1.0, "g"))
    return spark.createDataFrame(rows, "player_id int, a double, b double, c double, skill_group string").repartition(3)


def near(rows, keys, want, digits=1e-8):
    got = {tuple(r[k] for k in keys): r.asDict() for r in rows.collect()}
    other = {tuple(r[k] for k in keys): r.asDict() for r in want.collect()}
    assert set(got) == set(other) and got
    for key, row in other.items():
        for c, value in row.items():
            if isinstance(value, float):
                assert got[key][c] == pytest.approx(value, rel=digits, abs=digits), (key, c)
            else:
                assert got[key][c] == value


def test_profiles_of_halves_are_profiles_of_the_whole(spark, micro_logs):
    whole = aggregate_player_profiles(micro_logs)
    parts = [micro_logs.filter(F.col("match_id").isin(*some)) for some in (["m1", "m3"], ["m2", "m5", "m7"], ["m4", "m6"])]
    merged = merge_player_states(*map(player_states, parts))
    near(profiles_of_states(merged), ["player_id"], whole, 1e-12)
    assert profiles_of_states(merged).columns == whole.columns and profiles_of_states(merged).dtypes == whole.dtypes
    # Missing durations leave no trace, whichever part they are in; an empty part changes nothing.
    near(profiles_of_states(merge_player_states(merged, player_states(micro_logs.limit(0)))), ["player_id"], whole, 1e-12)


def test_states_far_from_zero_keep_their_digits(spark):
    from courtlens.schema import MATCH_LOG_SCHEMA

    rows = [("p", f"m{i}", 1.0, 1, 1, 1, 10**9 + i, 0, 0, 0, False) for i in range(6)]
    logs = spark.createDataFrame(rows, MATCH_LOG_SCHEMA)
    halves = [logs.filter(F.col("match_id") < "m3"), logs.filter(F.col("match_id") >= "m3")]
    (got,) = profiles_of_states(merge_player_states(*map(player_states, halves))).select("winner_rate_std").collect()
    assert got[0] == pytest.approx(np.std(np.arange(6), ddof=1), rel=1e-9)


def test_merged_fits_equal_a_full_fit(numbers):
    parts = [numbers.filter(F.col("player_id") % 3 == i) for i in range(3)]
    merged = merge_fit_states(*[fit_states(p, COLUMNS) for p in parts])
    full = numbers.dropna(subset=COLUMNS)
    near(scaler_of_states(merged), ["feature"], features.standardize(full.select(*COLUMNS), COLUMNS)[1])
    got, want = components_of_states(merged, 0.99), fit_components(full, 0.99, COLUMNS)
    assert got.loadings == pytest.approx(want.loadings, abs=1e-8) and got.shares == pytest.approx(want.shares, abs=1e-8)
    assert got.means == pytest.approx(want.means)


def test_what_is_taken_back_is_as_if_it_had_not_been(numbers):
    some, rest = numbers.filter("player_id % 5 = 0"), numbers.filter("player_id % 5 <> 0")
    whole = fit_states(numbers, COLUMNS, "skill_group")
    near(
        take_back(whole, fit_states(some, COLUMNS, "skill_group")).select("grp", "n"),
        ["grp"],
        fit_states(rest, COLUMNS, "skill_group").select("grp", "n"),
    )
    left = take_back(whole, fit_states(some, COLUMNS, "skill_group"))
    want = fit_states(rest, COLUMNS, "skill_group")
    a, b = ({r["grp"]: r for r in f.collect()} for f in (left, want))
    for g in a:
        assert a[g]["means"] == pytest.approx(b[g]["means"], rel=1e-12)
        assert a[g]["moments"] == pytest.approx(b[g]["moments"], rel=1e-7, abs=1e-7)
    # A group whose rows all leave is gone; one that loses none is as it was.
    gone = take_back(whole, fit_states(numbers.filter("skill_group = 'h'"), COLUMNS, "skill_group"))
    assert {r["grp"] for r in gone.collect()} == {"g", "few"}


def test_lines(numbers):
    full = numbers.dropna(subset=COLUMNS)
    parts = [full.filter(F.col("player_id") % 2 == i) for i in range(2)]
    merged = merge_fit_states(*[fit_states(p, COLUMNS, "skill_group") for p in parts])
    got = {(r["grp"], r["feature"]): r for r in lines_of_states(merged, "b").collect()}
    assert set(got) == {(g, f) for g in "gh" for f in "ac"}
    data = full.toPandas()
    for (g, f), r in got.items():
        mine = data[data.skill_group == g]
        slope, offset = np.polyfit(mine.b, mine[f] - mine[f].mean(), 1)
        assert r["slope"] == pytest.approx(slope, rel=1e-8)
        assert r["mean"] == pytest.approx(mine[f].mean()) and r["centre"] == pytest.approx(mine.b.mean())


def test_states_of_other_columns_do_not_merge(numbers):
    with pytest.raises(Exception, match="different columns"):
        merge_fit_states(fit_states(numbers, ["a"]), fit_states(numbers, ["b"])).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_player_tables_are_joined_without_a_shuffle(spark):
    from courtlens.schema import SKILL_FEATURES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        players = spark.range(500).withColumnRenamed("id", "player_id")
        scores = players.withColumn("skill_score", F.col("player_id") * 0.1)
        scaled = players.select("player_id", *[(F.col("player_id") + i).cast("double").alias(f) for i, f in enumerate(SKILL_FEATURES)])
        left, right = save_by_player(scores, "test_scores", 4), save_by_player(scaled, "test_scaled", 4)
        data = selection.prepare_clustering_data(left, right)
        assert "Exchange" not in plan(data) and data.count() == 500
        assert "Exchange" in plan(selection.prepare_clustering_data(scores, scaled))
        states = [player_states(spark.createDataFrame([], LOGS)) for _ in range(2)]
        stored = [save_by_player(s, f"test_states_{i}", 4) for i, s in enumerate(states)]
        assert "Exchange" not in plan(profiles_of_states(merge_player_states(*stored)))
        # The check itself only sends counts.
        repeated = save_by_player(scaled.unionByName(scaled.limit(3)), "test_repeated", 4)
        with pytest.raises(ValueError, match="twice in the scaled"):
            selection.prepare_clustering_data(left, repeated)
        for name, table in (("test_scores", left), ("test_scaled", right), ("test_repeated", repeated)):
            drop_player_table(table, name)
        assert not spark.catalog.tableExists("test_scores")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LOGS = (
    "player_id string, match_id string, match_duration_mins double, drop_attempts bigint, drop_successes bigint, "
    "drive_attempts bigint, clean_winners bigint, dink_winners bigint, unforced_errors bigint, dink_errors bigint, "
    "uses_stacking boolean"
)


@pytest.mark.parametrize("clusters", [1, 2, 3, 4, 300])
def test_ranking_in_spark_gives_the_same_names(spark, clusters):
    players = spark.range(900).select(
        "id", (F.col("id") % clusters).cast("int").alias("skill_cluster"), ((F.col("id") * 7919) % 101).cast("double").alias("skill_score")
    ).withColumn("skill_score", F.col("skill_score") + (F.col("skill_cluster") * 37) % 11)
    got = naming.rank_skill_clusters(players)
    want = naming.interpret_skill_clusters(players)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.dtypes == want.dtypes
    gap = players.withColumn("skill_score", F.when(F.col("id") > 0, F.col("skill_score")))
    with pytest.raises(Exception, match="no 'skill_score'"):
        naming.rank_skill_clusters(gap).collect()


def test_small_groups(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)], "skill_group string")
    assert [tuple(r) for r in selection.small_groups(df).collect()] == [("b", 2)]


def test_lines_equal_those_of_the_residuals(spark, numbers):
    full = numbers.dropna(subset=COLUMNS).withColumnRenamed("b", "skill_score")
    states = fit_states(full, ["a", "c", "skill_score"], "skill_group")
    lines = residual_lines(full, ["a", "c"])
    assert {r["skill_group"] for r in lines.collect()} >= {r["grp"] for r in lines_of_states(states, "skill_score").collect()}
