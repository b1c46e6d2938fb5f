"""Segmentation of entities: features, K-Means, names, projection and feature attribution."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.labels import performance_tier
from peerbench.functions.numbers import ratio, round_stable
from peerbench.operators.ranks import exact_quantiles
from peerbench.operators.star import Star
from peerbench.session import materialize, setting

FEATURES = ("net_per_unit", "total_volume", "item_diversity", "avg_z", "avg_gross_net_ratio")


def features(star: Star) -> DataFrame:
    """One row per entity: the five clustering features and the mean net amount."""
    sums = star.rollup.select("entity_id", *[
        ratio(F.col(f"sum_{m}"), F.col(f"n_{m}")).alias(name) for m, name in (
            ("net_per_unit", "net_per_unit"), ("net_z", "avg_z"), ("gross_net_ratio", "avg_gross_net_ratio"),
            ("net", "avg_net"))])
    return (
        star.entities.select("entity_id", F.col("total_volume").cast("double").alias("total_volume"))
        .join(sums, "entity_id", "left")
        .join(star.segments.select("entity_id", F.col("item_diversity").cast("double").alias("item_diversity")),
              "entity_id", "left")
        .select("entity_id", *FEATURES, "avg_net")
    )


def impute_median(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Replace nulls by the exact median of their column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns
    ])).alias("f")).select("f.*")
    medians = materialize(exact_quantiles(long, ["feature"], "x", {"median": 0.5}), "medians")
    one = medians.agg(F.struct(*[
        F.max(F.when(F.col("feature") == c, F.col("median"))).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), one[c]) for c in columns})


def scale(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Zero mean and unit population variance; a constant column becomes 0."""
    stats = materialize(df.agg(*[
        a.alias(n) for c in columns for a, n in ((F.avg(c), f"m_{c}"), (F.stddev_pop(c), f"s_{c}"))]), "scale")
    one = stats.select(F.struct(*stats.columns)).scalar()
    return df.withColumns({
        c: F.coalesce(ratio(F.col(c) - one[f"m_{c}"], one[f"s_{c}"]), F.lit(0.0)) for c in columns})


def scaled_features(feats: DataFrame) -> DataFrame:
    """Imputed and scaled features per entity, stored because the training reads them many times."""
    return materialize(scale(impute_median(feats)), "scaled")


def with_vector(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(scaled)


@dataclass
class Fit:
    """A K-Means model of ``k`` centres that began with the start ``seed``."""

    k: int
    seed: int
    centres: list[list[float]]
    cost: float = float("inf")
    done: bool = False


def _x() -> list[Column]:
    return [F.col(c).cast("double") for c in FEATURES]


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    """The features of a batch, one row each."""
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES])


def _nearest(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest point, the first of equals, and the squared distance from it, some thousand rows at a time."""
    at, d = np.zeros(len(x), np.int64), np.zeros(len(x))
    for lo in range(0, len(x), 2048):
        # feature by feature, the rows along the inner axis: half the time of one array of all differences
        part = np.zeros((len(points), len(x[lo : lo + 2048])))
        for column, value in zip(x[lo : lo + 2048].T, points.T):
            apart = column[None] - value[:, None]
            apart *= apart
            part += apart
        at[lo : lo + 2048] = part.argmin(0)
        d[lo : lo + 2048] = part.min(0)
    return at, d


#: Starting points drawn evenly, and again as many of the rows that these leave far away (on average).
POINTS = 256


def candidates(scaled: DataFrame, seed: int = 42, number: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Points that models of any k can start from, and how many rows are nearest to each.

    ``number`` rows evenly and then rows with a chance in proportion to their squared distance from those. A row's luck is
    a digest of its id and values, so a rerun draws the same rows; what is drawn does not grow with the table.
    """
    luck = F.pmod(F.xxhash64("entity_id", *FEATURES, F.lit(seed)), F.lit(2**40)) / F.lit(float(2**40))
    rows = scaled.select(*[c.alias(f) for c, f in zip(_x(), FEATURES)], luck.alias("luck"))
    fields = ", ".join(f"{c} double" for c in FEATURES)
    first = np.unique(np.array(rows.orderBy("luck", *FEATURES).limit(number).select(*FEATURES).collect()).reshape(-1, len(FEATURES)), axis=0)
    if not len(first):
        return first, np.zeros(0)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(float(_nearest(_columns(batch), first)[1].sum()) for batch in batches)
        yield pa.RecordBatch.from_pydict({"total": [total]})

    total = rows.mapInArrow(far, "total double").agg(F.sum("total")).first()[0]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _columns(batch)
            # the complement, since the smallest of these numbers chose the first points
            taken = 1 - batch.column("luck").to_numpy() < _nearest(x, first)[1] * number / total
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x[taken].T], list(FEATURES))

    more = np.array(rows.mapInArrow(drawn, fields).collect()).reshape(-1, len(FEATURES)) if total else first[:0]
    points = np.unique(np.concatenate([first, more]), axis=0)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(points), np.int64)
        for batch in batches:
            n += np.bincount(_nearest(_columns(batch), points)[0], minlength=len(points))
        yield pa.RecordBatch.from_pydict({"i": np.flatnonzero(n), "n": n[n > 0]})

    n = np.zeros(len(points))
    for r in rows.mapInArrow(counted, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        n[r["i"]] = r["n"]
    return points, n


def _start(points: np.ndarray, n: np.ndarray, k: int, seed: int) -> list[list[float]]:
    """k centres: points drawn with a chance in proportion to their rows and squared distance from those before, then
    moved until they are the means of the points nearest to them."""
    rng, chosen = np.random.default_rng([seed, k]), []
    weights = n.copy()
    for _ in range(min(k, len(points))):
        if not weights.sum():
            weights = np.array([float(not any((p == c).all() for c in chosen)) for p in points])
        chosen.append(points[rng.choice(len(points), p=weights / weights.sum())])
        weights = n * _nearest(points, np.array(chosen))[1]
    centres = np.array(chosen + chosen[-1:] * (k - len(chosen)))
    for _ in range(100):
        at = _nearest(points, centres)[0]
        size = np.bincount(at, n, k)
        sums = np.stack([np.bincount(at, n * column, k) for column in points.T], 1)
        moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        if (moved == centres).all():
            break
        centres = moved
    return centres.tolist()


def _moved(rows: DataFrame, models: Sequence[Fit]) -> DataFrame:
    """model, centre, n, cost and the sum of every feature over the rows nearest to a centre, for all models in one scan.

    A task holds one sum per (model, centre) and hands these on at its end. Distances of a batch of rows to a hundred
    centres are one array operation; as expressions they take ten times as long.
    """
    centres = [np.array(m.centres) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(c), 2 + c.shape[1])) for c in centres]
        for batch in batches:
            x = _columns(batch)
            for c, total in zip(centres, totals):
                at, d = _nearest(x, c)
                for j, weights in enumerate((None, d, *x.T)):
                    total[:, j] += np.bincount(at, weights, len(c))
        table = np.concatenate(totals)
        model = np.repeat(np.arange(len(centres)), [len(c) for c in centres]).astype(np.int32)
        centre = np.concatenate([np.arange(len(c)) for c in centres]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(centre), *map(pa.array, np.ascontiguousarray(table.T))], names)

    names = ["model", "centre", "n", "cost", *FEATURES]
    parts = rows.mapInArrow(run, "model int, centre int, " + ", ".join(f"{c} double" for c in names[2:]))
    # the sums are few, so one task adds them up
    return parts.repartition(1).groupBy("model", "centre").agg(*[F.sum(c).alias(c) for c in names[2:]]).where("n > 0")


def fit_kmeans(scaled: DataFrame, runs: Sequence[tuple[int, int]], max_iter: int) -> list[Fit]:
    """A model per (k, seed). One scan moves the centres of all models that have not settled.

    A model has settled when all its centres together move by less than 0.01, on features of unit variance.
    """
    points, n = candidates(scaled)
    if not len(points):
        raise ValueError("there are no rows to cluster")
    fits = [Fit(k, seed, _start(points, n, k, seed)) for k, seed in runs]
    rows = scaled.select(*[c.alias(f) for c, f in zip(_x(), FEATURES)])
    for step in range(max_iter + 1):
        active = [m for m in fits if not m.done]
        if not active:
            break
        found: dict[int, list] = {}
        # the plan of a scan is the same each time and needs no second look
        with setting(scaled.sparkSession, "spark.sql.adaptive.enabled", "false"):
            for r in _moved(rows, active).collect():  # a row per model and centre
                found.setdefault(r["model"], []).append(r)
        for number, model in enumerate(active):
            model.cost = sum(r["cost"] for r in found[number])
            moved = [list(c) for c in model.centres]
            for r in found[number]:
                moved[r["centre"]] = [r[f] / r["n"] for f in FEATURES]
            shift = sum((a - b) ** 2 for c, d in zip(moved, model.centres) for a, b in zip(c, d))
            if shift < 1e-4 or step == max_iter:
                model.done = True  # its cost belongs to the centres it has
            else:
                model.centres = moved
    return fits


def cheapest(fits: Iterable[Fit]) -> Fit:
    return min(fits, key=lambda m: (m.cost, m.seed))


def nearest_centre(centres: Sequence[Sequence[float]]) -> Column:
    """The index of the nearest centre, the lowest on a tie."""
    return F.array_min(F.array(*[
        F.struct(sum(((c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(_x(), point)), F.lit(0.0)).alias("distance"), F.lit(i).alias("id"))
        for i, point in enumerate(centres)]))["id"]


def k_search(scaled: DataFrame, ks: Iterable[int] = range(2, 9), inits: int = 3, max_iter: int = 50) -> DataFrame:
    """Inertia and silhouette for every k over all rows; the best silhouette, lowest k first, is chosen."""
    ks = list(ks)
    fitted = fit_kmeans(scaled, [(k, seed) for k in ks for seed in range(42, 42 + inits)], max_iter)
    best = {k: cheapest(fitted[i * inits:(i + 1) * inits]) for i, k in enumerate(ks)}
    labelled = scaled.withColumns({f"k{k}": nearest_centre(model.centres) for k, model in best.items()})
    scores = {r["label"]: r["silhouette"] for r in silhouette(labelled, [f"k{k}" for k in ks]).collect()}  # a row per k
    rows = [(k, float(m.cost), float(scores[f"k{k}"])) for k, m in best.items()]
    chosen = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return scaled.sparkSession.createDataFrame(
        [(k, cost, score, int(k == chosen)) for k, cost, score in rows],
        "k int, inertia double, silhouette double, chosen int")


def assign_kmeans(scaled: DataFrame, k: int, inits: int = 5, max_iter: int = 200) -> DataFrame:
    """The scaled features with the cluster of every entity, by the cheapest of several runs."""
    model = cheapest(fit_kmeans(scaled, [(k, seed) for seed in range(42, 42 + inits)], max_iter))
    return materialize(scaled.withColumn("cluster_id", nearest_centre(model.centres)), "clusters")


def assign_nearest(scaled: DataFrame, centroids: Sequence[Sequence[float]]) -> DataFrame:
    """The scaled features with the nearest of the given centroids, the lowest id on a tie."""
    return scaled.withColumn("cluster_id", nearest_centre(centroids))


def centroids(labelled: DataFrame) -> DataFrame:
    """Mean of every feature per cluster."""
    return labelled.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in FEATURES])


def name_clusters(means: DataFrame) -> DataFrame:
    """cluster_id, cluster_name: greedy naming by the most telling centroid.

    The largest absolute z-score first, of the rest the largest net per unit, of the rest the
    largest volume; all others share one name. Ties go to the lowest id.
    """
    means = materialize(means, "centroids")  # one row per cluster

    def leader(frame: DataFrame, measure):
        return frame.agg(F.min_by("cluster_id", F.struct(-measure, "cluster_id"))).scalar()

    billers = leader(means, F.abs("avg_z"))
    rest = means.filter(F.col("cluster_id") != billers)
    premium = leader(rest, F.col("net_per_unit"))
    rest = rest.filter(F.col("cluster_id") != premium)
    community = leader(rest, F.col("total_volume"))
    return means.select(
        "cluster_id",
        F.when(F.col("cluster_id") == billers, "Outlier Billers")
        .when(F.col("cluster_id") == premium, "Premium Specialists")
        .when(F.col("cluster_id") == community, "Community Providers")
        .otherwise("Standard Practice").alias("cluster_name"))


def with_clusters(feats: DataFrame, labelled: DataFrame) -> DataFrame:
    """Unscaled features of every labelled entity with its cluster id."""
    return feats.join(labelled.select("entity_id", "cluster_id"), "entity_id")


def label_entities(feats: DataFrame, labelled: DataFrame) -> DataFrame:
    """Unscaled features of every labelled entity with cluster id and name."""
    raw = with_clusters(feats, labelled)
    names = materialize(name_clusters(centroids(raw)), "names")
    return raw.join(names, "cluster_id", "left").withColumn("cluster_name", F.coalesce("cluster_name", F.lit("Unknown")))


def cluster_summary(named: DataFrame) -> DataFrame:
    """Mean of every feature per cluster, three decimals."""
    return named.groupBy("cluster_id", "cluster_name").agg(
        *[round_stable(F.avg(c), 3).alias(c) for c in FEATURES])


def tiers(feats: DataFrame) -> DataFrame:
    """Performance tier of every entity by its mean z-score."""
    return feats.select("entity_id", performance_tier("avg_z").alias("performance_tier"))


def updated_segments(star: Star, named: DataFrame) -> DataFrame:
    """The segments table with cluster and tier of every labelled entity."""
    update = named.select(
        "entity_id", "cluster_id", "cluster_name", performance_tier("avg_z").alias("performance_tier"))
    return (
        star.segments.select("entity_id", "item_diversity", "avg_z").join(update, "entity_id", "left")
        .select("entity_id", "item_diversity", "avg_z", "cluster_id", "cluster_name", "performance_tier")
    )


def with_segments(star: Star, named: DataFrame) -> Star:
    """A star whose segments table is rebuilt at a new place; the old one is left alone."""
    return star.with_segments(materialize(updated_segments(star, named), "segments"))


def projection(labelled: DataFrame) -> DataFrame:
    """Two principal components per entity and the variance they explain.

    The sign of a component is fixed by making its largest loading positive.
    """
    vectors = with_vector(labelled)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()  # features x 2
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    pc = vector_to_array("pc")
    explained = [float(v) for v in model.explainedVariance.toArray()]
    return model.transform(vectors).select(
        "entity_id", "cluster_id",
        *[(pc[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(2)],
        *[F.lit(explained[i]).alias(f"explained{i + 1}") for i in range(2)])


def projected_centroids(points: DataFrame) -> DataFrame:
    """Mean position of every cluster in the projection."""
    return points.groupBy("cluster_id").agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"))


def silhouette(labelled: DataFrame, columns: Sequence[str] = ("cluster_id",)) -> DataFrame:
    """label, rows, clusters and mean silhouette by squared Euclidean distance for each label column, over all rows.

    The mean squared distance of a row to a cluster follows from the cluster's count, sums and sum of squares, so one
    aggregation and one pass over the rows give the values of all label columns.
    """
    labels = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("int").alias("id")) for c in columns]))
    x = F.array(*[F.col(f).cast("double") for f in FEATURES])
    rows = labelled.select(labels.alias("l"), x.alias("x")).select("l.label", "l.id", "x", _dot(F.col("x"), F.col("x")).alias("xx"))
    sums = [F.sum(F.col("x")[j]).alias(f"s{j}") for j in range(len(FEATURES))]
    per = rows.groupBy("label", "id").agg(F.count(F.lit(1)).alias("n"), F.sum("xx").alias("q"), *sums)
    packed = F.struct("id", "n", "q", F.array(*[f"s{j}" for j in range(len(FEATURES))]).alias("s"))
    clusters = materialize(per.groupBy("label").agg(F.collect_list(packed).alias("clusters")), "clusters")  # k structs a label

    def total(c):
        return c["n"] * F.col("xx") + c["q"] - 2 * _dot(F.col("x"), c["s"])

    own = F.filter("clusters", lambda c: c["id"] == F.col("id"))[0]
    others = F.filter("clusters", lambda c: c["id"] != F.col("id"))
    measured = rows.join(clusters, "label").select(
        "label", F.size("clusters").alias("k"), own["n"].alias("n"), ratio(total(own), own["n"] - 1).alias("a"),
        F.array_min(F.transform(others, lambda c: total(c) / c["n"])).alias("b"))
    score = F.when((F.col("n") == 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(ratio(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return measured.groupBy("label").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("k").alias("clusters"), F.avg(score).alias("silhouette"))


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, d: s + d)


def importance(labelled: DataFrame, seed: int = 42) -> DataFrame:
    """How much each feature decides the cluster: forest importance and mean absolute Shapley value of all entities.

    Five features make 32 coalitions, so the values are exact: an entity takes the features of the coalition from itself
    and the others from the mean entity, which is the background, and the forest's probability is weighted by the
    Shapley coefficient of the coalition.
    """
    trained = with_vector(labelled).withColumn("label", F.col("cluster_id").cast("double"))
    # the copy lacks the training summary, which for two classes holds the session and can't be sent to tasks
    forest = RandomForestClassifier(numTrees=30, maxDepth=6, seed=seed).fit(trained).copy()
    n = len(FEATURES)

    mean = materialize(labelled.agg(F.array(*[F.avg(f) for f in FEATURES]).alias("mean")), "mean").select("mean").scalar()
    mixed = (
        labelled.select("entity_id", F.array(*FEATURES).alias("x"), mean.alias("mean"))
        .withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(2**n - 1))))
        .select("entity_id", "mask", array_to_vector(F.array(*[
            F.when(F.col("mask").bitwiseAND(1 << j) != 0, F.col("x")[j]).otherwise(F.col("mean")[j])
            for j in range(n)])).alias("features"))
    )
    values = (
        forest.transform(mixed)
        .select("entity_id", "mask", F.posexplode(vector_to_array("probability")).alias("class", "p"))
        .withColumnRenamed("p", "v")
    )

    def coefficient(j: int, mask: int) -> float:
        inside = bool(mask & (1 << j))
        others = bin(mask).count("1") - inside
        weight = factorial(others) * factorial(n - others - 1) / factorial(n)
        return weight if inside else -weight

    def contribution(j: int):
        table = F.array(*[F.lit(coefficient(j, mask)) for mask in range(2**n)])
        return F.sum(F.get(table, F.col("mask")) * F.col("v"))

    shares = values.groupBy("entity_id", "class").agg(*[contribution(j).alias(f"phi{j}") for j in range(n)])
    means = shares.agg(
        F.count_if(F.col("class") == 0).alias("row_count"), *[F.avg(F.abs(f"phi{j}")).alias(f"phi{j}") for j in range(n)])
    rows = F.array(*[
        F.struct(F.lit(FEATURES[j]).alias("feature"),
                 F.lit(float(forest.featureImportances[j])).alias("forest_importance"),
                 F.col(f"phi{j}").alias("mean_abs_shapley"), F.col("row_count").alias("row_count"))
        for j in range(n)])
    return means.select(F.explode(rows).alias("r")).select("r.*").orderBy(F.desc("mean_abs_shapley"))
