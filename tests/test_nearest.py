import numpy as np
import pytest
from pyspark.sql import functions as F

from courtlens.functions.expressions import feature_array, nearest_index
from courtlens.operators import nearest
from courtlens.operators.nearest import assign_nearest

AXES = ["x", "y", "z"]


def table(spark, values, key):
    rows = [(i, *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{key} bigint, x double, y double, z double")


def brute(points, centres):
    d = np.sqrt(sum((points[:, j, None] - centres[None, :, j]) ** 2 for j in range(3)))
    return d.argmin(axis=1).tolist()


@pytest.mark.parametrize("pivots, per_task", [(None, 200_000), (1, 50), (40, 7)])
def test_equals_the_comparison_with_all(spark, monkeypatch, pivots, per_task):
    monkeypatch.setattr(nearest, "POINTS_PER_TASK", per_task)
    rng = np.random.default_rng(1)
    centres = np.concatenate([rng.normal(size=(300, 3)), rng.normal(5, 0.1, size=(100, 3)), np.zeros((3, 3))])
    points = np.concatenate([rng.normal(1, 2, size=(400, 3)), np.zeros((200, 3)), centres[:20]])
    df = table(spark, points, "player_id").repartition(4)
    got = assign_nearest(df, AXES, table(spark, centres, "cluster").repartition(3), "near", pivots)
    assert got.columns == [*df.columns, "near"]
    assert [r["near"] for r in got.orderBy("player_id").collect()] == brute(points, centres)


def test_equals_nearest_index(spark):
    rng = np.random.default_rng(2)
    centres, points = rng.normal(size=(9, 3)), rng.normal(size=(200, 3))
    df = table(spark, points, "player_id")
    listed = F.array(*[F.array(*map(F.lit, c)) for c in centres.tolist()])
    got = assign_nearest(df, AXES, table(spark, centres, "cluster"), "near").withColumn("want", nearest_index(feature_array(AXES), listed))
    assert got.filter("near <> want").count() == 0 and got.count() == 200


def test_points_meet_few_cells():
    rng = np.random.default_rng(3)
    centres = rng.uniform(size=(100_000, 2))
    pivots = centres[:316]
    d = np.sqrt(((centres[:, None] - pivots[None]) ** 2).sum(2))
    cell, reach = d.argmin(1), d.min(1)
    radii = np.array([reach[cell == c].max() for c in range(316)])
    x = rng.uniform(size=(500, 2))
    near = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    own = near.argmin(1)
    best = np.array([np.sqrt(((centres[cell == c] - p) ** 2).sum(1)).min() for c, p in zip(own, x)])
    point, other = nearest.other_cells(x, own, best, pivots, radii)
    assert len(point) < 500 * 2
    exact = np.array([np.sqrt(((centres - p) ** 2).sum(1)).argmin() for p in x])
    met = set(zip(point.tolist(), other.tolist())) | set(enumerate(own.tolist()))
    assert all((i, cell[c]) in met for i, c in enumerate(exact))


def test_a_hundred_thousand_centres_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        centres = spark.range(100_000).select(
            F.col("id").alias("cluster"), (F.col("id") % 317).cast("double").alias("x"),
            F.floor(F.col("id") / 317).cast("double").alias("y"), F.lit(0.0).alias("z"),
        )
        points = spark.range(3_000).select(
            F.col("id").alias("player_id"), ((F.col("id") * 7919) % 317 + 0.2).alias("x"),
            ((F.col("id") * 104_729) % 315 - 0.3).alias("y"), F.lit(0.1).alias("z"),
        )
        got = assign_nearest(points, AXES, centres, "near")
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in text
        want = F.round("x") + 317 * F.round("y")
        assert got.filter((F.col("near") != want) & (F.col("y") > 0)).count() == 0 and got.count() == 3_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_features_and_no_centres(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, None, 1.0, 1.0), (3, float("nan"), 1.0, 1.0)], "player_id int, x double, y double, z double")
    centres = table(spark, [[0, 0, 0]], "cluster")
    assert {r["player_id"]: r["near"] for r in assign_nearest(df, AXES, centres, "near").collect()} == {1: 0, 2: None, 3: None}
    assert {r["near"] for r in assign_nearest(df, AXES, centres.limit(0), "near").collect()} == {None}
    assert assign_nearest(df.limit(0), AXES, centres, "near").collect() == []
