import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clustering import XY, blobs, frame

from courtlens.operators.group_sweep import sweep_groups
from courtlens.operators.selection import cluster_playstyles, sweep_k


@pytest.fixture(scope="module")
def players(spark):
    x, _ = blobs([(0, 0), (6, 0), (0, 7), (30, 30), (36, 30)], n=24, spread=0.8, seed=2)
    group = ["a"] * 72 + ["b"] * 48
    x, group = np.concatenate([x, np.ones((5, 2)), [[1.0, 2.0]], [[3.0, 4.0], [5.0, 6.0]]]), group + ["same"] * 5 + ["one"] + [None] * 2
    return frame(spark, x, skill_group=group).repartition(3)


def by_key(rows):
    return {(r["grp"], r["seed"], r["k"]): r for r in rows.collect()}


def test_models_are_those_fitted_side_by_side(players):
    sweep = sweep_k(players, XY, "skill_group", 2, 4, [1, 2], n_init=4, min_rows=3, skip_small=True)
    for local in (1000, 60, 0):
        got = by_key(sweep_groups(players, XY, "skill_group", 2, 4, [1, 2], n_init=4, local_points=local).models)
        assert set(got) == {(g, s, k) for g, s, k in sweep.models}
        for (g, s, k), model in sweep.models.items():
            row = got[(g, s, k)]
            assert np.array(row["centres"]) == pytest.approx(model.centres, abs=1e-9)
            clusters, value = sweep.silhouettes[(g, s, k)]
            assert row["clusters"] == clusters and row["cost"] == pytest.approx(model.cost, abs=1e-9)
            assert row["silhouette"] == (None if value is None else pytest.approx(value, abs=1e-6))
            assert row["selected"] == (sweep.chosen(s).get(g) == k)


def test_assignment(players):
    groups = sweep_groups(players, XY, "skill_group", 2, 4, n_init=4)
    got = {r["player_id"]: r["playstyle_cluster"] for r in groups.assign(players).collect()}
    sweep = sweep_k(players, XY, "skill_group", 2, 4, n_init=4, min_rows=3, skip_small=True)
    clustered, _, _ = cluster_playstyles(players, sweep.chosen(42), 42, XY, sweep)
    assert got == {r["player_id"]: r["playstyle_cluster"] for r in clustered.collect()}


def test_given_starts(players):
    def starts(group):
        return {(group, k, 42): [[float(i), 0.0] for i in range(k)] for k in (2, 3)}

    rows = [by_key(sweep_groups(players, XY, "skill_group", 2, 3, max_iter=3, starts=starts, local_points=n).models) for n in (1000, 10)]
    assert set(rows[0]) == set(rows[1])
    for key, row in rows[0].items():
        assert np.array(row["centres"]) == pytest.approx(np.array(rows[1][key]["centres"]), abs=1e-9)


def test_fifty_thousand_groups_stay_off_the_driver(spark, monkeypatch):
    n = 50_000
    df = spark.range(4 * n).select(
        F.col("id").cast("string").alias("player_id"),
        (F.col("id") % n).cast("string").alias("skill_group"),
        (F.floor(F.col("id") / n) * 10.0 + F.col("id") % 7).alias("x"),
        F.when(F.col("id") < 2 * n, 0.0).otherwise(100.0).alias("y"),
    )
    seen = []
    for name in ("collect", "toArrow", "toPandas"):
        real = getattr(type(df), name)

        def counted(self, *args, real=real, **kwargs):
            out = real(self, *args, **kwargs)
            seen.append(out.num_rows if hasattr(out, "num_rows") else len(out))
            return out

        monkeypatch.setattr(type(df), name, counted)
    sweep = sweep_groups(df, XY, "skill_group", 2, 2, n_init=1, max_iter=4)
    labelled = sweep.assign(df)
    split = labelled.groupBy("skill_group").agg(
        F.countDistinct("playstyle_cluster").alias("clusters"),
        F.countDistinct("playstyle_cluster", "y").alias("pairs"),
    )
    bad = split.filter("clusters <> 2 OR pairs <> 2").count()
    # One look at up to 10,001 rows decides whether the models can be broadcast.
    assert sum(seen) <= 10_001 + 10
    assert sweep.models.count() == n and bad < n // 20
