import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from courtlens.operators import kmeans, lloyd_bounds, selection, silhouette as silhouette_module
from courtlens.operators.agreement import adjusted_rand_index
from courtlens.operators.kmeans import assign_clusters, fit_kmeans
from courtlens.operators.points import ALL, fold_points, pack_points
from courtlens.operators.selection import (
    cluster_playstyles,
    cluster_skill_groups,
    playstyle_stability,
    prepare_clustering_data,
    select_playstyle_k,
    select_skill_k,
    sweep_k,
)
from courtlens.operators.silhouette import silhouette
from courtlens.schema import SKILL_FEATURES
from registry import queries

XY = ["x", "y"]


def frame(spark, points, names=XY, **extra):
    columns = [np.asarray(points, dtype=float)[:, i].tolist() for i in range(len(names))]
    rows = list(zip([f"p{i:04d}" for i in range(len(points))], *columns, *extra.values()))
    types = ", ".join(
        f"{k} {'string' if isinstance(v[0], str) or v[0] is None else 'int'}" for k, v in extra.items()
    )
    schema = "player_id string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, schema + (", " + types if types else ""))


def blobs(centres, n=30, spread=0.3, seed=0):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(c, spread, size=(n, len(c))) for c in centres])
    return points, np.repeat(np.arange(len(centres)), n)


def fit(df, features, ks, group_col=None, seeds=(42,), **options):
    points = pack_points(df, features, group_col)
    try:
        return fit_kmeans(points, ks, list(seeds), **options), points
    finally:
        points.release()


def cost(x, centres):
    return ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def lloyd(x, k, restarts, seed=0):
    rng = np.random.default_rng(seed)
    best = np.inf
    for _ in range(restarts):
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(200):
            nearest = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[nearest == j].mean(0) if (nearest == j).any() else c[j] for j in range(k)])
        best = min(best, cost(x, c))
    return best


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        mates = labels == own
        if mates.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, mates].sum() / (mates.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


def test_separable_blobs_are_recovered(spark):
    x, truth = blobs([(0, 0), (10, 0), (0, 10)])
    df = frame(spark, x, truth=truth.tolist())
    (model,), _ = fit(df, XY, {ALL: [3]})
    got = assign_clusters(df, XY, [model], "cluster")
    assert adjusted_rand_index(got, "cluster", "truth").first().ari == 1.0
    assert model.cost == pytest.approx(cost(x, model.centres))
    # canonical order: by first feature, then the next
    assert [tuple(c) for c in model.centres] == sorted(tuple(c) for c in model.centres)


def test_costs_and_fixpoints_without_structure(spark):
    x = np.random.default_rng(5).normal(size=(400, 3))
    models, _ = fit(frame(spark, x, ["x", "y", "z"]), ["x", "y", "z"], {ALL: [2, 3, 4, 5]}, tol=0.0)
    assert [m.k for m in models] == [2, 3, 4, 5]
    for m in models:
        assert m.cost == pytest.approx(cost(x, m.centres))
        nearest = ((x[:, None] - m.centres[None]) ** 2).sum(2).argmin(1)
        means = np.array([x[nearest == j].mean(0) for j in range(m.k)])
        assert np.allclose(means, m.centres)
        assert m.cost <= 1.01 * lloyd(x, m.k, 20)


def test_result_does_not_depend_on_partitioning(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(300, 2))
    df = frame(spark, x)
    (one,), _ = fit(df.coalesce(1), XY, {ALL: [4]})
    monkeypatch.setattr("courtlens.operators.points.POINTS_PER_TASK", 20)
    monkeypatch.setattr(kmeans, "CHUNK_CELLS", 64)
    packed = pack_points(df.repartition(7), XY)
    assert packed.frame.select(F.spark_partition_id()).distinct().count() > 1
    packed.release()
    (many,), _ = fit(df.repartition(7), XY, {ALL: [4]})
    assert np.allclose(one.centres, many.centres) and one.cost == pytest.approx(many.cost)


def test_groups_are_fitted_side_by_side(spark, monkeypatch):
    a, _ = blobs([(0, 0), (8, 8)], seed=1)
    b, _ = blobs([(0, 5), (5, 0), (9, 9)], seed=2)
    df = frame(spark, np.concatenate([a, b]), team=["a"] * len(a) + ["b"] * len(b))
    models, _ = fit(df, XY, {"a": [2], "b": [2, 3]}, "team", seeds=[1, 2])
    assert [(m.group, m.k, m.seed) for m in models] == [
        ("a", 2, 1), ("a", 2, 2), ("b", 2, 1), ("b", 2, 2), ("b", 3, 1), ("b", 3, 2)
    ]
    assert models[0].cost == pytest.approx(cost(a, models[0].centres))
    assert models[4].cost == pytest.approx(cost(b, models[4].centres))
    monkeypatch.setattr(kmeans, "BATCH_CENTRES", 1)  # one group at a time
    again, _ = fit(df, XY, {"a": [2], "b": [2, 3]}, "team", seeds=[1, 2])
    assert [m.cost for m in again] == pytest.approx([m.cost for m in models])


def test_copies_are_folded_and_counted(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([np.tile([[1.0, 1.0]], (200, 1)), rng.normal(size=(100, 2)), [[-0.0, 0.0]], [[0.0, -0.0]]])
    (model,), points = fit(frame(spark, x), XY, {ALL: [3]})
    assert points.groups[ALL].rows == 302 and points.groups[ALL].distinct == 102
    assert model.cost == pytest.approx(cost(x, model.centres))
    assert points.groups[ALL].mean_variance == pytest.approx(x.var(0).mean())


def test_fewer_distinct_points_than_clusters(spark):
    x = np.array([[0.0, 0.0]] * 5 + [[1.0, 1.0]] * 4)
    (model,), _ = fit(frame(spark, x), XY, {ALL: [4]})
    assert len(model.centres) == 2 and model.cost == 0.0


def test_emptied_centre_moves_to_the_farthest_point(spark):
    # Two far starts on one side leave the third centre without points after an update.
    x = np.array([[0.0, 0.0], [0.1, 0.0], [0.2, 0.0], [50.0, 0.0], [50.1, 0.0]])
    points = pack_points(frame(spark, x), XY)
    centre = points.groups[ALL].centre
    runs = [kmeans._Run(ALL, 3, 1, 0, np.array([[0.0, 0.0], [0.05, 0.0], [900.0, 0.0]]) - centre)]
    (spot,) = kmeans._Passes(points, [ALL]).draw(runs, [1], step=0, farthest=True)
    points.release()
    assert (spot + centre).tolist() == [[pytest.approx(50.1), 0.0]]


@pytest.mark.parametrize(("block", "column", "dense"), [(1024, 10**6, 512), (40, 35, 512), (40, 35, 2)])
def test_silhouette_matches_definition(spark, monkeypatch, block, column, dense):
    monkeypatch.setattr(silhouette_module, "MAX_BLOCK", block)
    monkeypatch.setattr(silhouette_module, "MAX_COLUMN", column)
    monkeypatch.setattr(silhouette_module, "DENSE_CLUSTERS", dense)
    monkeypatch.setattr(silhouette_module, "TILE", 17)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 2))
    x[:70] = x[0]  # a third of all points are copies
    three, two = rng.integers(0, 3, 200), (x[:, 0] > 0).astype(int) * 4
    three[190] = 9  # a cluster of one
    team = ["u" if i % 3 else "v" for i in range(200)]
    df = frame(spark, x, three=three.tolist(), two=two.tolist(), team=team)
    got = {(r.team, r.labeling): r for r in silhouette(df, XY, ["three", "two"], "team").collect()}
    for t in "uv":
        mask = np.array(team) == t
        for name, labels in (("three", three), ("two", two)):
            want = brute_silhouette(x[mask], labels[mask])
            assert got[(t, name)].silhouette == pytest.approx(want, abs=1e-9)
            assert got[(t, name)].clusters == len(set(labels[mask]))
    whole = silhouette(df, XY, ["two"]).first()
    assert whole.silhouette == pytest.approx(brute_silhouette(x, two), abs=1e-9)


def test_silhouette_far_from_zero(spark):
    x, truth = blobs([(0, 0), (2, 1)], n=60, spread=0.9)
    far = x + 1e8
    df = frame(spark, far, truth=truth.tolist())
    got = silhouette(df, XY, ["truth"]).first().silhouette
    assert got == pytest.approx(brute_silhouette(far, truth), abs=1e-9)
    (model,), points = fit(df, XY, {ALL: [2]})
    assert len(model.centres) == 2 and model.cost == pytest.approx(cost(far, model.centres), rel=1e-6)
    assert points.groups[ALL].mean_variance == pytest.approx(far.var(0).mean(), rel=1e-6)
    assert assign_clusters(df, XY, [model], "cluster").select("cluster").distinct().count() == 2


def test_more_clusters_than_fit_in_one_table(spark):
    """50,100 clusters: nothing raises, and pairs of close points score as the definition says."""
    n = 50_100
    x = spark.range(n).select(F.col("id").cast("int").alias("label"), (F.col("id") * 10.0).alias("x"))
    pairs = x.filter("label < 100").withColumn("x", F.col("x") + 1.0)
    row = silhouette(x.unionByName(pairs), ["x"], ["label"]).first()
    # A pair's distance is 1; the next cluster is 9, 9.5 or 10 away, or a pair's mean of these.
    def score(i, second):
        at = 10.0 * i + second
        others = [(abs(at - 10.0 * j) + (abs(at - 10.0 * j - 1) if j < 100 else abs(at - 10.0 * j))) / 2 for j in (i - 1, i + 1) if j >= 0]
        return 1 - 1 / min(others)

    want = sum(score(i, s) for i in range(100) for s in (0.0, 1.0)) / (n + 100)
    assert row.clusters == n and row.silhouette == pytest.approx(want, abs=1e-9)


def test_a_point_travels_once_per_row_and_column(spark):
    points = pack_points(frame(spark, np.random.default_rng(1).normal(size=(500, 2)), team=["a", "b"] * 250), XY, "team")
    labelled = points.frame.withColumn("labels", F.array(F.lit(0)))
    grids = silhouette_module.plan_grid({"a": 250, "b": 250}, {"a": 3, "b": 900}, tasks=40)
    copies = silhouette_module.cell_copies(labelled, points.axes, grids).cache()
    assert copies.count() == sum(250 * (g.rows + g.columns) for g in grids.values())
    assert grids["a"].rows > 1 and grids["a"].columns > 1 and grids["b"].columns == 1
    # Each cell pairs one row block with one column: all pairs of a group meet once.
    met = copies.filter("role = 0").alias("x").join(copies.filter("role = 1").alias("y"), "cell")
    assert met.count() == 2 * 250 * 250
    points.release()
    # A larger group gets cells by the square root of the tasks, not a copy per task.
    big = silhouette_module.plan_grid({"all": 5_000_000}, {"all": 70}, tasks=2000)["all"]
    assert big.rows * big.columns >= 2000 and big.rows + big.columns < 150


def test_players_all_alike_are_one_style(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, np.concatenate([rng.normal(size=(12, 2)), np.ones((6, 2))]), skill_group=["a"] * 12 + ["same"] * 6)
    data, best, sweep = select_playstyle_k(df, features=XY)
    assert set(best) == {"a"}
    clustered, _, _ = cluster_playstyles(data, best, features=XY, sweep=sweep)
    assert clustered.filter("skill_group = 'same' and playstyle_cluster = 0").count() == 6


def test_given_starts_are_plain_lloyd_steps(spark):
    x, _ = blobs([(0, 0), (3, 0), (0, 3)], n=40, spread=1.0)
    starts = {(ALL, 2, 7): [[5.0, 5.0], [-1.0, 0.0]], (ALL, 3, 7): x[:3].tolist()}
    models, _ = fit(frame(spark, x), XY, {ALL: [2, 3]}, seeds=[7], starts=starts, max_iter=4, tol=0.0)
    for m in models:
        c = np.array(starts[(ALL, m.k, 7)])
        for _ in range(4):
            nearest = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[nearest == j].mean(0) for j in range(m.k)])
        assert np.allclose(sorted(map(tuple, c)), m.centres)
    with pytest.raises(ValueError, match="starting centres"):
        fit(frame(spark, x), XY, {ALL: [4]}, starts=starts)


def test_models_are_batched_by_k_and_seed(spark, monkeypatch):
    x, _ = blobs([(0, 0), (8, 8)], seed=1)
    df = frame(spark, x)
    together, _ = fit(df, XY, {ALL: [2, 3]}, seeds=[1, 2])
    monkeypatch.setattr(kmeans, "BATCH_CENTRES", 1)
    apart, _ = fit(df, XY, {ALL: [2, 3]}, seeds=[1, 2])
    assert [(m.k, m.seed) for m in apart] == [(2, 1), (2, 2), (3, 1), (3, 2)]
    assert [m.cost for m in apart] == pytest.approx([m.cost for m in together])


def test_silhouette_of_one_cluster_is_missing(spark):
    df = frame(spark, np.random.default_rng(9).normal(size=(10, 2)), one=[0] * 10)
    row = silhouette(df, XY, ["one"]).first()
    assert row.clusters == 1 and row.silhouette is None


def test_squared_silhouette_is_opt_in_and_different(spark):
    x, truth = blobs([(0, 0), (3, 0)], n=20, spread=0.8)
    df = frame(spark, x, truth=truth.tolist())
    exact = silhouette(df, XY, ["truth"]).first().silhouette
    squared = silhouette(df, XY, ["truth"], metric="squared_euclidean").first().silhouette
    assert exact == pytest.approx(brute_silhouette(x, truth)) and squared > exact
    with pytest.raises(ValueError, match="manhattan"):
        silhouette(df, XY, ["truth"], metric="manhattan")


def pair_counting(a, b):
    same_a, same_b = a[:, None] == a[None], b[:, None] == b[None]
    upper = np.triu(np.ones((len(a), len(a)), bool), 1)
    both, in_a, in_b = ((same_a & same_b)[upper].sum(), same_a[upper].sum(), same_b[upper].sum())
    expected = in_a * in_b / upper.sum()
    return (both - expected) / ((in_a + in_b) / 2 - expected)


def test_adjusted_rand(spark):
    rng = np.random.default_rng(10)
    a, b = rng.integers(0, 3, 80), rng.integers(0, 4, 80)
    df = frame(spark, np.zeros((80, 2)), a=a.tolist(), b=b.tolist(), one=[1] * 80)
    assert adjusted_rand_index(df, "a", "b").first().ari == pytest.approx(pair_counting(a, b))
    assert adjusted_rand_index(df, "b", "a").first().ari == pytest.approx(pair_counting(a, b))
    assert adjusted_rand_index(df, "a", "a").first().ari == 1.0
    assert adjusted_rand_index(df, "one", "one").first().ari == 1.0
    assert adjusted_rand_index(df, "a", "one").first().ari == 0.0


def skill_frame(spark, n=24):
    x, truth = blobs([[0] * 10, [6] * 10, [-6] * 10], n=n)
    scores = frame(spark, np.column_stack([truth * 10.0]), ["skill_score"])
    return scores, frame(spark, x, SKILL_FEATURES), truth


def test_skill_k_selection_and_clusters(spark):
    scores, features, truth = skill_frame(spark)
    data = prepare_clustering_data(scores, features)
    best_k, sweep = select_skill_k(data)
    assert best_k == 3
    results = {r.k: r for r in sweep.results(data).collect()}
    assert sorted(results) == [2, 3, 4, 5] and [k for k, r in results.items() if r.selected] == [3]
    clustered, _ = cluster_skill_groups(data, best_k, sweep=sweep)
    assert adjusted_rand_index(clustered, "skill_cluster", "skill_score").first().ari == 1.0
    refitted, _ = cluster_skill_groups(data, best_k)
    assert sorted(map(tuple, refitted.select("player_id", "skill_cluster").collect())) == sorted(
        map(tuple, clustered.select("player_id", "skill_cluster").collect())
    )
    x = np.array([[r[f] for f in SKILL_FEATURES] for r in data.collect()])
    labels = {r.player_id: r.skill_cluster for r in clustered.collect()}
    order = np.array([labels[r.player_id] for r in data.collect()])
    assert results[3].silhouette == pytest.approx(brute_silhouette(x, order))


def test_highest_silhouette_wins_and_ties_go_to_small_k(spark):
    _, features, _ = skill_frame(spark, n=4)
    sweep = sweep_k(features, SKILL_FEATURES)
    sweep.silhouettes = {(ALL, 42, 2): (2, 0.5), (ALL, 42, 3): (3, 0.7), (ALL, 42, 4): (4, 0.7), (ALL, 42, 5): (1, None)}
    assert sweep.best_k(ALL, 42) == 3


def test_too_few_players(spark):
    _, features, _ = skill_frame(spark)
    with pytest.raises(ValueError, match="Too few players"):
        select_skill_k(features.limit(2).withColumn("skill_score", F.lit(1.0)))
    small = frame(spark, np.random.default_rng(0).normal(size=(9, 2)), skill_group=["big"] * 7 + ["small"] * 2)
    with pytest.raises(ValueError, match="'small'"):
        select_playstyle_k(small, features=XY)
    data, best, sweep = select_playstyle_k(small, features=XY, skip_small=True)
    assert set(best) == {"big"}
    clustered, _, sizes = cluster_playstyles(data, best, features=XY, sweep=sweep)
    assert clustered.filter("skill_group = 'small' and playstyle_cluster = 0").count() == 2
    assert sum(r.players for r in sizes.collect()) == 9


def test_playstyles_are_clustered_inside_groups(spark):
    a, la = blobs([(0, 0), (9, 9)], seed=3)
    b, lb = blobs([(0, 0), (9, 0), (0, 9)], seed=4)
    df = frame(
        spark, np.concatenate([a, b, [[5.0, 5.0]]]),
        truth=[*la.tolist(), *lb.tolist(), 0], skill_group=["a"] * len(a) + ["b"] * len(b) + [None],
    )
    data, best, sweep = select_playstyle_k(df, features=XY)
    assert best == {"a": 2, "b": 3}
    clustered, models, sizes = cluster_playstyles(data, best, features=XY, sweep=sweep)
    grouped = clustered.filter("skill_group is not null")
    scores = adjusted_rand_index(grouped, "truth", "playstyle_cluster", ["skill_group"]).collect()
    assert [r.ari for r in scores] == [1.0, 1.0]
    assert clustered.filter("playstyle_cluster is null").count() == 1
    one, best_one, _ = select_playstyle_k(df, "a", features=XY)
    assert best_one == {"a": 2} and one.count() == len(a)


def test_stability_on_clear_structure(spark):
    a, _ = blobs([(0, 0), (9, 9)], seed=5)
    b, _ = blobs([(0, 0), (9, 0), (0, 9)], seed=6)
    df = frame(spark, np.concatenate([a, b]), skill_group=["a"] * len(a) + ["b"] * len(b))
    runs, summary = playstyle_stability(df, features=XY, n_init=4)
    rows = runs.collect()
    assert len(rows) == 10
    for r in rows:
        assert not r.k_differs and r.ari == (None if r.seed == 1 else 1.0)
    votes = {r.skill_group: r for r in summary.collect()}
    assert (votes["a"].most_common_k, votes["b"].most_common_k) == (2, 3)
    assert votes["a"].most_common_count == votes["a"].runs == 5
    assert votes["b"].silhouette_std == pytest.approx(0.0, abs=1e-9)


def test_input_checks(spark):
    scores, features, _ = skill_frame(spark)
    with pytest.raises(ValueError, match="winner_rate_mean"):
        prepare_clustering_data(scores, features.drop("winner_rate_mean"))
    with pytest.raises(ValueError, match="skill profiles lack: player_id"):
        prepare_clustering_data(scores.drop("player_id"), features)
    with pytest.raises(ValueError, match="twice in the skill profiles"):
        prepare_clustering_data(scores.union(scores.limit(1)), features)
    with pytest.raises(ValueError, match="twice in the scaled features"):
        prepare_clustering_data(scores, features.union(features.limit(1)))
    with pytest.raises(ValueError, match="no scaled features"):
        prepare_clustering_data(scores, features.filter("player_id <> 'p0003'"))
    # players that only have features vanish silently
    assert prepare_clustering_data(scores.filter("player_id <> 'p0003'"), features).count() == 71


@pytest.mark.parametrize("k", [2, 7])
def test_steps_with_bounds_have_the_centres_of_plain_steps(spark, k):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal(c, 1.0, size=(150, 2)) for c in ([0, 0], [4, 0], [0, 5])])
    df = frame(spark, np.concatenate([x, x[:40]]), team=["a", "b"] * 245).repartition(5)
    ks = {"a": [k, k + 1], "b": [k]}
    plain, _ = fit(df, XY, ks, "team", seeds=(1, 2), n_init=3, carry_bounds=False)
    carried, _ = fit(df, XY, ks, "team", seeds=(1, 2), n_init=3, carry_bounds=True)
    assert [(m.group, m.k, m.seed) for m in plain] == [(m.group, m.k, m.seed) for m in carried]
    for a, b in zip(plain, carried):
        # Restarts that end alike may differ in the last digit of their cost, so either may win.
        assert a.centres == pytest.approx(b.centres, abs=1e-8)
        assert a.cost == pytest.approx(b.cost, rel=1e-9)


def test_steps_with_bounds_refill_emptied_centres(spark):
    x = np.concatenate([np.random.default_rng(0).normal(0, 1, size=(60, 2)), [[40.0, 40.0]]])
    starts = {(ALL, 3, 1): [[0.0, 0.0], [500.0, 0.0], [0.5, 0.5]]}
    models = [
        fit(frame(spark, x), XY, {ALL: [3]}, seeds=(1,), starts=starts, carry_bounds=carry)[0][0]
        for carry in (False, True)
    ]
    assert models[0].centres == pytest.approx(models[1].centres, abs=1e-9) and len(models[1].centres) == 3
    assert models[0].iterations == models[1].iterations


def test_settled_points_cost_one_comparison():
    rng = np.random.default_rng(5)
    x, labels_of = blobs([(8 * i, 8 * j) for i in range(8) for j in range(8)], n=40)
    centres = np.array([x[labels_of == c].mean(0) for c in range(64)])[None] + 0.3
    labels, upper, lower = (a.reshape(-1, 1) for a in lloyd_bounds.measured(x, np.broadcast_to(centres, (len(x), 64, 2))))
    spent = []
    for _ in range(4):
        moved = centres + rng.normal(0, 0.05, centres.shape)
        shifts = np.sqrt(((moved - centres) ** 2).sum(2))
        labels, upper, lower = lloyd_bounds.settle(x, labels, upper, lower, moved, shifts, spent.append)
        centres = moved
        want, least, other = lloyd_bounds.measured(x, np.broadcast_to(centres, (len(x), 64, 2)))
        assert (labels[:, 0] == want).all()
        assert (upper[:, 0] >= least - 1e-12).all() and (lower[:, 0] <= other + 1e-12).all()
    assert sum(spent) < 0.02 * 4 * len(x) * 64


def test_clusters_that_bounds_rule_out_cost_no_distances():
    x, labels = blobs([(10 * i, 10 * j) for i in range(6) for j in range(6)], n=20, seed=3)
    centres = np.array([x[labels == c].mean(0) for c in range(36)])
    variances = np.array([((x[labels == c] - centres[c]) ** 2).sum(1).mean() for c in range(36)])
    needed = silhouette_module.needed_clusters(x, labels, centres, variances)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    means = np.array([d[:, labels == c].mean(1) for c in range(36)]).T
    means[np.arange(len(x)), labels] = np.inf
    # Its own cluster and the nearest other are always among those that a point asks for.
    assert needed[np.arange(len(x)), labels].all() and needed[np.arange(len(x)), means.argmin(1)].all()
    assert needed.sum(1).mean() < 8
    apart = silhouette_module.needed_clusters(x, np.where(labels == 3, -1, labels), centres, np.where(np.arange(36) == 5, np.nan, variances))
    assert not apart[labels == 3].any() and not apart[:, 5].any()

    # The kernel itself, on one cell of all points.
    n, rows = len(x), []
    spent = []
    kernel = silhouette_module._cell_kernel({"g": [(0, 0, 36)]}, {"g": 36}, 2, spent.append)
    for role, ids, at, weight, label in (
        (-1, np.arange(36), centres, variances, np.zeros(36)),
        (0, np.arange(n), x, np.ones(n), labels),
        (1, np.arange(n), x, np.ones(n), labels),
    ):
        rows.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), role, np.int32)), pa.array(np.zeros(len(ids), np.int32)),
                    pa.array(["g"] * len(ids)), pa.array(ids), pa.array(at[:, 0]), pa.array(at[:, 1]),
                    pa.array(np.asarray(weight, float)), pa.array([[int(v)] for v in label], pa.list_(pa.int32())),
                ],
                ["role", "block", "grp", "id", "x0", "x1", "weight", "labels"],
            )
        )
    out = list(kernel(iter(rows)))
    assert sum(spent) < n * n / 2
    sums = np.concatenate([np.asarray(b.column("sums").flatten()).reshape(-1, 36) for b in out])[1:]
    exact = np.array([d[:, labels == c].sum(1) for c in range(36)]).T
    asked = np.isfinite(sums)
    # A point's distance to itself is the root of a rounding error.
    assert sums[asked] == pytest.approx(exact[asked], abs=1e-5) and (asked == needed).all()


def test_silhouette_of_a_sample(spark):
    x, labels = blobs([(0, 0), (5, 0), (0, 6)], n=900, spread=1.0, seed=8)
    df = frame(spark, x, team=["a", "b", "b"] * 900).withColumn("label", F.lit(0))
    df = df.withColumn("label", F.when(F.col("x") > 2.5, 1).when(F.col("y") > 3, 2).otherwise(0))
    whole = {r.team: r.silhouette for r in silhouette(df, XY, ["label"], "team").collect()}
    some = silhouette(df, XY, ["label"], "team", sample_size=400)
    part = {r.team: r.silhouette for r in some.collect()}
    again = silhouette(df.repartition(7), XY, ["label"], "team", sample_size=400).collect()
    assert part == pytest.approx({r.team: r.silhouette for r in again}, abs=1e-9)
    for team, value in whole.items():
        assert part[team] != value and part[team] == pytest.approx(value, abs=0.05)
    every = silhouette(df, XY, ["label"], "team", sample_size=10_000).collect()
    assert {r.team: r.silhouette for r in every} == pytest.approx(whole)


def test_stability_query_fits_twenty_restarts_until_they_settle(spark, monkeypatch):
    x = np.random.default_rng(17).normal(size=(240, 2))
    df = frame(spark, x, skill_group=["a", "b"] * 120)
    monkeypatch.setattr(queries, "_component_input", lambda spark, sf_dir: (df, XY))
    fits = []

    def counted(points, ks, seeds, **options):
        models = fit_kmeans(points, ks, seeds, **options)
        fits.append((options, models))
        return models

    monkeypatch.setattr(selection, "fit_kmeans", counted)
    rows = queries.playstyle_stability(spark, "").collect()
    ((options, models),) = fits
    assert options["starts"] is None and (options["n_init"], options["max_iter"]) == (20, 300)
    assert sorted((r.skill_group, r.seed) for r in rows) == [(g, s) for g in "ab" for s in (1, 7, 21, 42, 100)]
    assert len(models) == 2 * 5 * 4 and max(m.iterations for m in models) > 3
    for m in models:
        mine = x["ab".index(m.group) :: 2]
        assert cost(mine, m.centres) <= 1.05 * lloyd(mine, m.k, 20)


def test_draws_do_not_go_by_the_last_digits(spark):
    rng = np.random.default_rng(23)
    x = rng.normal(size=(400, 2))
    noisy = x * (1 + 1e-13 * rng.normal(size=x.shape))
    one, other = (fit(frame(spark, points), XY, {ALL: [8]}, n_init=1)[0][0] for points in (x, noisy))
    assert np.abs(one.centres - other.centres).max() < 1e-9


def test_points_of_equal_digits_draw_apart(spark):
    x = np.repeat(np.random.default_rng(29).normal(size=(40, 2)), 10, axis=0)
    x[0], x[10:20, 0] = 0.0, 0.0
    x = x * (1 + 1e-12 * np.arange(len(x))[:, None])
    rows = fold_points(frame(spark, x), XY, None).collect()
    assert len({(r.x0, r.x1) for r in rows}) == len({r.hash for r in rows}) == len(rows)
    (model,), _ = fit(frame(spark, x), XY, {ALL: [12]}, n_init=20)
    assert len(model.centres) == 12 and cost(x, model.centres) <= 1.1 * lloyd(x, 12, 20)


@pytest.mark.parametrize("k", [1, 3, 127, 128, 300])
def test_nearest_of_any_number_of_centres(k):
    rng = np.random.default_rng(k)
    x, centres = rng.normal(size=(50, 3)), rng.normal(size=(4, k, 3))
    centres[1, -1] = centres[1, 0]  # of equal centres the first
    nearest = kmeans._nearest(x, centres)
    want = ((x[:, None, None] - centres[None]) ** 2).sum(3).argmin(2)
    assert nearest.shape == (50, 4) and (nearest == want).all()
    assert nearest.dtype.itemsize == (1 if k <= 128 else 2)


def test_points_cross_to_python_in_blocks(spark, monkeypatch):
    x = np.random.default_rng(31).normal(size=(600, 2))
    df = frame(spark, np.concatenate([x, x[:100]]), team=["a", "b", "b"] * 200 + ["a", "b", "b", "b"] * 25).coalesce(1)
    ks, sent = {"a": [2, 5], "b": [3]}, []
    keep = kmeans._Passes.keep_blocks

    def counted(passes):
        keep(passes)
        sent.append(passes.blocks.count())

    monkeypatch.setattr(kmeans._Passes, "keep_blocks", counted)
    monkeypatch.setattr(kmeans, "BLOCK_POINTS", 64)
    blocks, points = fit(df, XY, ks, "team", n_init=3)
    distinct = [points.groups[g].distinct for g in "ab"]
    assert sent and sum(distinct) // 64 <= sent[0] <= sum(distinct) // 64 + 2 * 8
    monkeypatch.setattr(kmeans, "BLOCKS_FROM_STEPS", 10**6)
    rows, _ = fit(df, XY, ks, "team", n_init=3)
    assert len(sent) == 1 and [(m.group, m.k) for m in blocks] == [(m.group, m.k) for m in rows]
    for one, other in zip(blocks, rows):
        assert one.iterations == other.iterations and np.abs(one.centres - other.centres).max() < 1e-9
