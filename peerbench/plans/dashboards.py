"""Aggregates behind the dashboard pages and the reporting measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.labels import outlier_side
from peerbench.functions.numbers import ratio, round_stable
from peerbench.operators.star import Star
from peerbench.plans import queries as q


def peer_variation(star: Star, more_than: int = 10, limit: int = 30) -> DataFrame:
    """Variation per peer group for the dashboard, costliest first."""
    return q.named_agg(
        star.rollup.groupBy("peer_group"),
        entity_count=q.entity_count(), avg_net=round_stable(q.mean_of("net"), 2),
        variation_ratio=round_stable(q.rollup_ratio(), 1),
    ).filter(F.col("entity_count") > more_than).orderBy(F.desc("avg_net"), "peer_group").limit(limit)


def kpis(star: Star) -> DataFrame:
    """Entities, item rows, outlier rows and the mean variation ratio, in one row."""
    return q.side_by_side(
        star.entities.agg(F.count_distinct("entity_id").alias("total_entities")),
        star.items.agg(F.count(F.lit(1)).alias("total_items")),
        star.measures.agg(F.count_if(F.col("is_outlier") == 1).alias("total_outliers")),
        q.peer_figures(star).agg(round_stable(F.avg("variation_ratio"), 1).alias("avg_variation_ratio")),
    )


def geo(star: Star) -> DataFrame:
    """Mean net amount and entities per place, costliest first."""
    return q.named_agg(
        star.rollup.groupBy("place", "region"),
        avg_net=round_stable(q.mean_of("net"), 2), entity_count=q.entity_count(),
    ).orderBy(F.desc("avg_net"), "place", "region")


def clusters(star: Star) -> DataFrame:
    """Entities and mean z-score per named cluster."""
    return q.named_agg(
        star.segments.filter("cluster_name is not null").groupBy("cluster_name"),
        entity_count=F.count(F.lit(1)), avg_z=round_stable(F.avg("avg_z"), 3))


def top_outliers(star: Star, limit: int = 50) -> DataFrame:
    """The most extreme outlier rows with their side."""
    return q.most_extreme(q.outlier_rows(star), limit).select(
        "entity_name", "peer_group", "place", round_stable("net", 2).alias("net"),
        round_stable("net_z", 2).alias("z_score"), outlier_side("net_z").alias("side"))


def overview(star: Star) -> DataFrame:
    """Report cards over all peer groups: entities, mean ratio, outlier rows."""
    return q.side_by_side(
        q.peer_figures(star).agg(
            F.sum("entity_count").alias("total_entities"),
            round_stable(F.avg("variation_ratio"), 2).alias("avg_variation_ratio")),
        q.outlier_rows(star).agg(F.count(F.lit(1)).alias("total_outliers")),
    )


def top_peers_by_cost(star: Star, top: int = 10) -> DataFrame:
    """The peer groups with the highest mean net amount."""
    return (
        q.peer_variation(star).select("peer_group", "avg_net")
        .orderBy(F.desc("avg_net"), "peer_group").limit(top)
    )


def peer_vs_all(star: Star) -> DataFrame:
    """Variation ratio of each peer group against the mean of all ratios."""
    listed = q.peer_figures(star).select("peer_group", "variation_ratio")
    mean = listed.agg(F.avg("variation_ratio")).scalar()
    return listed.select(
        "peer_group", "variation_ratio", round_stable(mean, 2).alias("mean_ratio"),
        F.when(F.col("variation_ratio") > mean, "above").otherwise("below").alias("position"))


def region_means(star: Star) -> DataFrame:
    """Unweighted mean of the place-and-peer means per region."""
    return q.place_figures(star).groupBy("region").agg(round_stable(F.avg("place_avg"), 2).alias("region_avg"))


def region_compare(star: Star) -> DataFrame:
    """Mean of means, entities and costliest place-and-peer mean per region, highest first."""
    return q.named_agg(
        q.place_figures(star).groupBy("region"),
        region_avg=round_stable(F.avg("place_avg"), 2), entity_count=F.sum("entity_count"), top_avg=F.max("place_avg"),
    ).orderBy(F.desc("region_avg"), "region")


def cluster_by_region(star: Star) -> DataFrame:
    """Entities per cluster and region with the share of the cluster in all entities."""
    named = star.segments.filter("cluster_name is not null").select("entity_id", "cluster_name")
    counts = (
        star.entities.select("entity_id", "region").join(named, "entity_id")
        .groupBy("cluster_name", "region").agg(F.count(F.lit(1)).alias("entity_count"))
    )
    total = named.agg(F.count(F.lit(1))).scalar()
    per_cluster = named.groupBy("cluster_name").agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(per_cluster, "cluster_name").select(
        "cluster_name", "region", "entity_count",
        round_stable(ratio(F.col("_n"), total), 4).alias("cluster_share"))


def outlier_mix(star: Star) -> DataFrame:
    """All outlier rows by peer group and type, as a share of all entities, with their mean score."""
    entities = star.entities.agg(F.count(F.lit(1))).scalar()
    rows = q.outlier_rows(star).select(
        "peer_group", q.outlier_type("net_z").alias("outlier_type"), round_stable("net_z", 2).alias("z_score"))
    return rows.groupBy("peer_group", "outlier_type").agg(
        F.count(F.lit(1)).alias("outlier_count"),
        round_stable(ratio(F.count(F.lit(1)), entities) * 100, 4).alias("pct_of_entities"),
        round_stable(F.avg("z_score"), 3).alias("avg_z"))


def dashboard(star: Star) -> dict[str, DataFrame]:
    """All frames of the dashboard by name."""
    return {
        "kpis": kpis(star), "peer_variation": peer_variation(star), "geographic": geo(star),
        "clusters": clusters(star), "top_outliers": top_outliers(star),
    }
