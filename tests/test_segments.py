from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from peerbench.operators import quality
from peerbench.plans import segments
from peerbench.workspace import workspace

F5 = segments.FEATURES


@pytest.fixture(scope="module")
def w(spark):
    return workspace(spark, SMOKE_DIR)


def frame(spark, rows):
    return spark.createDataFrame(rows, "cluster_id int, " + ", ".join(f"{f} double" for f in F5))


def test_naming_rule(spark):
    means = frame(spark, [
        (0, 80.11, 142.209, 1.0, 1.465, 3.165), (1, 32.561, 142.422, 1.0, -0.381, 2.448),
        (2, 32.331, 142.302, 1.0, -0.394, 3.852), (3, 1.79, 1389.575, 1.0, -0.073, 3.162),
        (4, 962.428, 8.414, 1.0, 1.007, 3.14), (5, 5982.666, 1.739, 1.0, 1.416, 3.479)])
    names = {r["cluster_id"]: r["cluster_name"] for r in segments.name_clusters(means).collect()}
    assert names == {0: "Outlier Billers", 5: "Premium Specialists", 3: "Community Providers",
                     1: "Standard Practice", 2: "Standard Practice", 4: "Standard Practice"}
    tied = frame(spark, [(1, 1.0, 1.0, 1.0, -2.0, 1.0), (0, 1.0, 1.0, 1.0, 2.0, 1.0)])
    assert {r["cluster_id"]: r["cluster_name"] for r in segments.name_clusters(tied).collect()} == {
        0: "Outlier Billers", 1: "Premium Specialists"}


def test_impute_and_scale(spark):
    df = frame(spark, [(0, 1.0, 1.0, 3.0, None, 1.0), (0, 2.0, 1.0, 3.0, 4.0, 2.0), (0, 6.0, 1.0, 3.0, 8.0, 3.0)])
    done = segments.impute_median(df)
    assert sorted(r["avg_z"] for r in done.collect()) == [4.0, 6.0, 8.0]
    scaled = segments.scale(done).toPandas()
    assert scaled["total_volume"].eq(0).all()
    want = (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])
    assert sorted(scaled["net_per_unit"]) == pytest.approx(sorted(want))


def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    labels = rng.integers(0, 3, 60)
    labels[0] = 9  # a cluster of one
    df = spark.createDataFrame(
        [(i, int(c), *map(float, p)) for i, (c, p) in enumerate(zip(labels, x))],
        "entity_id long, cluster_id int, " + ", ".join(f"{f} double" for f in F5))
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(60) != i)
        if not same.any():
            scores.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, labels == k].mean() for k in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    got = {r["label"]: r for r in segments.silhouette(df.withColumn("one", F.lit(1)), ["cluster_id", "one"]).collect()}
    assert got["cluster_id"]["row_count"] == 60 and got["cluster_id"]["silhouette"] == pytest.approx(np.mean(scores), abs=1e-9)
    assert got["one"]["silhouette"] == 0 and got["one"]["clusters"] == 1


def test_k_means_segments(spark, w):
    search = w.k_search.orderBy("k").collect()
    assert [r["k"] for r in search] == list(range(2, 9)) and sum(r["chosen"] for r in search) == 1
    best = max(search, key=lambda r: r["silhouette"])
    assert best["chosen"] == 1 and search[-1]["inertia"] < search[0]["inertia"]
    assert w.clustered.count() == w.star.entities.count()
    assert w.clustered.select("cluster_id").distinct().count() == best["k"]
    star = w.segmented_star
    assert star.segments.count() == w.star.segments.count()
    verdict = quality.cluster_coverage(star.segments).first()
    assert verdict["coverage"] == 1 and verdict["unknown_names"] == 0
    assert w.star.segments.filter("cluster_id is not null").isEmpty()  # the old table is left alone
    missing = quality.missing_values(
        star.segments.select("cluster_name"),
        spark.createDataFrame([(n,) for n in quality.CLUSTER_NAMES], "cluster_name string"))
    assert missing.isEmpty()


def lloyd(x, centres, steps):
    """Plain K-Means from given centres."""
    for step in range(steps + 1):
        d = ((x[:, None] - centres[None]) ** 2).sum(2)
        at = d.argmin(1)
        moved = np.array([x[at == i].mean(0) if (at == i).any() else c for i, c in enumerate(centres)])
        if ((moved - centres) ** 2).sum() < 1e-4 or step == steps:
            return centres, d.min(1).sum()
        centres = moved


def test_nearest_holds_one_distance_per_row_and_point():
    rng = np.random.default_rng(5)
    x, centres = rng.normal(size=(3000, 5)), rng.normal(size=(200, 5))
    centres[7] = centres[3]  # the first of equals
    tracemalloc.start()
    at, d = segments._nearest(x, centres)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    plain = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (at == plain.argmin(1)).all() and (d == plain.min(1)).all() and 7 not in at
    assert most < 4 * 2048 * 200 * 8


def points(spark, x):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "entity_id long, " + ", ".join(f"{f} double" for f in F5)).repartition(3)


def test_shared_scans_equal_plain_k_means(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.4, (90, 5)) for c in (-3, 0, 3)])
    data = points(spark, x)
    scans = []
    moved = segments._moved
    monkeypatch.setattr(segments, "_moved", lambda rows, models: scans.append(len(models)) or moved(rows, models))
    runs = [(k, seed) for k in (1, 2, 3, 5) for seed in (1, 2)]
    fits = segments.fit_kmeans(data, runs, 20)
    starts = segments.candidates(data)
    assert [(m.k, m.seed) for m in fits] == runs and len(starts[0]) >= 5
    for m in fits:
        centres, cost = lloyd(x, np.array(segments._start(*starts, m.k, m.seed)), 20)
        assert np.array(m.centres) == pytest.approx(centres, abs=1e-9) and m.cost == pytest.approx(cost)
    assert len(scans) <= 21 and scans[0] == len(runs) and scans == sorted(scans, reverse=True)
    assert segments.cheapest(m for m in fits if m.k == 3).cost < 1.1 * 5 * 0.16 * len(x)


def test_starts_are_repeatable_and_cover_the_rows(spark):
    x = np.random.default_rng(2).normal(size=(900, 5))
    first, n = segments.candidates(points(spark, x), number=40)
    again = segments.candidates(points(spark, x).repartition(5), number=40)
    assert (first == again[0]).all() and (n == again[1]).all() and n.sum() == 900
    assert {tuple(p) for p in first} <= {tuple(map(float, p)) for p in x} and 60 < len(first) < 110


def test_equal_rows_and_no_rows(spark):
    same = points(spark, np.ones((20, 5)))
    search = segments.k_search(same, ks=(2, 3), inits=1).collect()
    assert [r["inertia"] for r in search] == [0, 0] and [r["chosen"] for r in search] == [1, 0]
    assert {r["cluster_id"] for r in segments.assign_kmeans(same, 3, inits=1).collect()} == {0}
    with pytest.raises(ValueError, match="no rows"):
        segments.k_search(same.limit(0))


def test_projection(w):
    points = segments.projection(w.clustered).toPandas()
    x = w.clustered.select("entity_id", *F5).toPandas().set_index("entity_id").loc[points["entity_id"]].to_numpy()
    values, vectors = np.linalg.eigh(np.cov(x.T))
    top = vectors[:, ::-1][:, :2]
    top = top * np.sign(top[np.abs(top).argmax(axis=0), [0, 1]])
    assert points[["pc1", "pc2"]].to_numpy() == pytest.approx(x @ top, abs=1e-6)
    assert points["explained1"][0] == pytest.approx(values[-1] / values.sum())


def test_importance(w):
    rows = {r["feature"]: r for r in segments.importance(w.nearest).collect()}
    assert set(rows) == set(F5) and {r["row_count"] for r in rows.values()} == {w.star.entities.count()}
    assert sum(r["forest_importance"] for r in rows.values()) == pytest.approx(1.0)
    assert all(r["mean_abs_shapley"] >= 0 for r in rows.values())
    ranked = sorted(F5, key=lambda f: -rows[f]["mean_abs_shapley"])
    assert rows[ranked[0]]["forest_importance"] > rows[ranked[-1]]["forest_importance"]


def test_importance_of_two_clusters(spark):
    spark.range(1).observe(Observation(), F.count(F.lit(1))).collect()  # as the medians do, which gives the session its observations
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(
        [(i, i % 2, float(i % 2), *map(float, p)) for i, p in enumerate(rng.normal(size=(60, 4)))],
        "entity_id long, cluster_id int, " + ", ".join(f"{f} double" for f in F5))
    rows = segments.importance(df).collect()
    assert rows[0]["feature"] == F5[0] and {r["row_count"] for r in rows} == {60}
    assert sum(r["forest_importance"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["mean_abs_shapley"] > 10 * rows[1]["mean_abs_shapley"]


def test_nearest_centroid_takes_the_lowest_id_on_a_tie(spark):
    df = frame(spark, [(0, 0.0, 0.0, 0.0, 0.0, 0.0)]).drop("cluster_id")
    points = [(1.0, 0, 0, 0, 0), (-1.0, 0, 0, 0, 0)]
    assert segments.assign_nearest(df, points).first()["cluster_id"] == 0
    assert segments.assign_nearest(df, points[::-1]).select(F.max("cluster_id")).first()[0] == 0
