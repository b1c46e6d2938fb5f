"""The six analytical queries over the star and the summary over their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.labels import outlier_type
from peerbench.functions.numbers import ratio, round_stable
from peerbench.operators.ranks import exact_ntile, histogram, ntile_cuts
from peerbench.operators.star import Star
from peerbench.session import materialize




def mean_of(name: str):
    """Mean of a measure over the rows that entity rollups stand for."""
    return ratio(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def rollup_spread():
    """Mean, largest and smallest net amount of grouped rollups, two decimals."""
    return {
        "avg_net": round_stable(mean_of("net"), 2),
        "max_net": round_stable(F.max("max_net"), 2),
        "min_net": round_stable(F.min("min_net"), 2),
    }


def rollup_ratio():
    """Largest over smallest net amount of grouped rollups, null if the smallest is zero."""
    return ratio(F.max("max_net"), F.min("min_net"))


def named_agg(grouped, **columns) -> DataFrame:
    return grouped.agg(*[c.alias(name) for name, c in columns.items()])


def entity_count():
    """A rollup has one row per entity."""
    return F.count(F.lit(1))


def peer_figures(star: Star) -> DataFrame:
    """Cost variation of every peer group, in no order."""
    return named_agg(
        star.rollup.groupBy("peer_group"),
        entity_count=entity_count(), **rollup_spread(),
        variation_ratio=round_stable(rollup_ratio(), 1), avg_z=round_stable(mean_of("net_z"), 3),
    )


def peer_variation(star: Star, more_than: int = 20) -> DataFrame:
    """Cost variation per peer group of enough entities, widest ratio first."""
    return peer_figures(star).filter(F.col("entity_count") > more_than).orderBy(F.desc("variation_ratio"), "peer_group")


def place_figures(star: Star) -> DataFrame:
    """Mean net amount per place, region and peer group, in no order."""
    return named_agg(
        star.rollup.groupBy("place", "region", "peer_group"),
        place_avg=round_stable(mean_of("net"), 2), entity_count=entity_count(),
    )


def geographic(star: Star) -> DataFrame:
    """Mean net amount per place, region and peer group, highest first."""
    return place_figures(star).orderBy(F.desc("place_avg"), "place", "region", "peer_group")


def volume_cost(star: Star) -> DataFrame:
    """Cost per volume tier and peer group; the volume of an entity counts once per measure row."""
    return named_agg(
        star.rollup.groupBy("volume_tier", "peer_group"),
        avg_net=round_stable(mean_of("net"), 2), avg_net_per_unit=round_stable(mean_of("net_per_unit"), 2),
        entity_count=entity_count(), total_volume_served=F.sum(F.col("total_volume") * F.col("n_rows")),
    ).orderBy("peer_group", "avg_net", "volume_tier")


def outlier_rows(star: Star) -> DataFrame:
    """Measures flagged as outliers with their entity."""
    return star.merged.filter("is_outlier = 1")


def outlier_counts():
    """Outlier rows of either type, over all rows that are aggregated."""
    kind = outlier_type("net_z")
    return [F.count_if(kind == "Expensive Outlier").alias("expensive"), F.count_if(kind == "Cheap Outlier").alias("cheap")]


def most_extreme(rows: DataFrame, limit: int) -> DataFrame:
    """Top rows by absolute z-score, ties by entity and item."""
    return rows.orderBy(F.desc(F.abs("net_z")), "entity_id", "item_code").limit(limit)


def outliers(star: Star, limit: int = 100) -> DataFrame:
    """The most extreme outlier rows with their type."""
    return most_extreme(outlier_rows(star), limit).select(
        "entity_name", "peer_group", "place", "locality",
        round_stable("net", 2).alias("net"), round_stable("net_z", 2).alias("z_score"),
        round_stable("gross_net_ratio", 2).alias("gross_net_ratio"), "volume_tier",
        outlier_type("net_z").alias("outlier_type"),
    )


def item_spread(star: Star, more_than: int = 10, limit: int = 20) -> DataFrame:
    """Items with the widest range of net amounts.

    Items and measures are counted per (entity, item) before they meet, so that repeated pairs
    weigh as often as the join would repeat them without being multiplied out.
    """
    pair = ["entity_id", "item_code"]
    items = star.items.groupBy(*pair, "item_desc").agg(F.count(F.lit(1)).alias("times"))
    measures = star.measures.join(star.entities.select("entity_id"), "entity_id", "left_semi").groupBy(*pair).agg(
        F.sum("net").alias("sum_net"), F.count("net").alias("n_net"),
        F.max("net").alias("max_net"), F.min("net").alias("min_net"))
    return named_agg(
        items.join(measures, pair).groupBy("item_desc"),
        entities=F.count_distinct("entity_id"),
        avg_net=round_stable(
            ratio(F.sum(F.col("sum_net") * F.col("times")), F.sum(F.col("n_net") * F.col("times"))), 2),
        max_net=round_stable(F.max("max_net"), 2),
        min_net=round_stable(F.min("min_net"), 2),
        net_spread=round_stable(F.max("max_net") - F.min("min_net"), 2),
    ).filter(F.col("entities") > more_than).orderBy(F.desc("net_spread"), "item_desc").limit(limit)


def _quartiles(pairs: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Quartile of every row within its item.

    Equal amounts are ordered by a digest of entity and measured item: evenly spread, so that a
    long run of equal amounts is cut without sorting it in one task.
    """
    rows = pairs.withColumn("tie", F.md5(F.concat_ws("|", F.col("entity_id").cast("string"), "measure_code")))
    return (
        exact_ntile(rows, "item_code", "net", "tie", 4, "net_quartile", cuts)
        .select("item_desc", "entity_name", "peer_group", "place", round_stable("net", 2).alias("net"),
                "total_volume", "net_quartile", "tie")
        .orderBy("item_desc", "net", "tie").drop("tie")
    )


def item_quartiles(star: Star) -> DataFrame:
    """Every item row with every measure of its entity (joined on the entity alone).

    The cuts are found before the rows are multiplied out: an entity's amounts are counted by bin, the bins of all
    entities with an item are added up as often as they have it, and only amounts in the bins of the cuts meet the
    items. The pairs themselves are made once, on their way into the result, and are not stored.
    """
    measures = star.measures.select("entity_id", F.col("item_code").alias("measure_code"), "net")
    items = star.items.select("entity_id", "item_code", "item_desc")
    known = star.entities.groupBy("entity_id").agg(F.count(F.lit(1)).alias("rows"))
    times = items.groupBy("entity_id", "item_code").agg(F.count(F.lit(1)).alias("times")).join(known, "entity_id").select(
        "entity_id", "item_code", (F.col("times") * F.col("rows")).alias("times"))
    bins = histogram(measures, ["entity_id"], "net")
    counts = times.join(bins, "entity_id").groupBy("item_code", "bin").agg(
        F.sum(F.col("n") * F.col("times")).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    weighted = times.join(measures.select("entity_id", "net"), "entity_id")
    cuts = ntile_cuts(weighted, "item_code", "net", 4, counts, "times")
    return _quartiles(items.join(measures, "entity_id").join(_who(star), "entity_id"), cuts)


def item_quartiles_strict(star: Star) -> DataFrame:
    """Every item row with its own measure (joined on entity and item)."""
    measures = star.measures.select("entity_id", "item_code", "net")
    items = star.items.select("entity_id", "item_code", "item_desc")
    rows = items.join(measures, ["entity_id", "item_code"]).withColumn("measure_code", F.col("item_code"))
    return _quartiles(materialize(rows.join(_who(star), "entity_id"), "item-measures"))


def _who(star: Star) -> DataFrame:
    return star.entities.select("entity_id", "entity_name", "peer_group", "place", "total_volume")


def summary(star: Star) -> DataFrame:
    """One row: headline figures of the variation, outlier and item queries."""
    variation = peer_variation(star).agg(
        F.min_by("peer_group", F.struct(-F.col("variation_ratio"), "peer_group")).alias("top_peer"),
        F.max("variation_ratio").alias("top_ratio"),
        round_stable(F.avg("variation_ratio"), 1).alias("mean_ratio"))
    extreme = outlier_rows(star).agg(*outlier_counts())
    widest = item_spread(star, limit=1).agg(
        F.first("item_desc").alias("widest_item"), F.first("net_spread").alias("widest_spread"))
    return side_by_side(variation, extreme, widest)


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames as one row, the others read as scalar subqueries."""
    out = first
    for other in others:
        one = other.select(F.struct(*other.columns)).scalar()
        out = out.select("*", *[one[c].alias(c) for c in other.columns])
    return out


REGISTRY: dict[str, Callable[[Star], DataFrame]] = {
    "q1_peer_variation": peer_variation,
    "q2_geographic": geographic,
    "q3_volume_cost": volume_cost,
    "q4_outliers": outliers,
    "q5_items": item_spread,
    "q6_item_quartiles": item_quartiles,
}


def run_all(star: Star) -> dict[str, DataFrame]:
    """Every registered query by name; a failing one raises."""
    return {name: query(star) for name, query in REGISTRY.items()}
