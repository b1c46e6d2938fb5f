"""Facts behind the narrative, one row each, and the sentences over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio, round_stable
from peerbench.functions.strings import money, percent
from peerbench.operators.star import Star
from peerbench.plans import queries as q


def _best(columns, by):
    """The row that comes first under ``by``, as a struct."""
    return F.min_by(F.struct(*columns), F.struct(*by))


def peer_facts(star: Star) -> DataFrame:
    """Peers with the widest and narrowest ratio, the mean, and entities far above the mean."""
    listed = q.peer_figures(star)
    mean = listed.agg(F.avg("variation_ratio")).scalar()
    shape = ["peer_group", "variation_ratio"]
    return (
        listed.agg(
            _best(shape, [-F.col("variation_ratio"), "peer_group"]).alias("top"),
            F.max_by(F.struct(*shape), F.struct(-F.col("variation_ratio"), "peer_group")).alias("bottom"),
            F.avg("variation_ratio").alias("mean"),
            F.coalesce(F.sum(F.when(F.col("variation_ratio") > mean * 1.5, F.col("entity_count"))), F.lit(0))
            .alias("entities_in_wide_peers"))
        .select(
            F.col("top.peer_group").alias("top_peer"), F.col("top.variation_ratio").alias("top_ratio"),
            F.col("bottom.peer_group").alias("bottom_peer"), F.col("bottom.variation_ratio").alias("bottom_ratio"),
            round_stable("mean", 2).alias("mean_ratio"), "entities_in_wide_peers")
    )


def geo_facts(star: Star) -> DataFrame:
    """Costliest and cheapest region by the mean of means, their gap, and the costliest place."""
    groups = q.place_figures(star)
    regions = groups.groupBy("region").agg(F.avg("place_avg").alias("mean"))
    ends = regions.agg(
        _best(["region", "mean"], [-F.col("mean"), "region"]).alias("top"),
        _best(["region", "mean"], ["mean", "region"]).alias("low"))
    place = groups.agg(
        _best(["place", "place_avg"], [-F.col("place_avg"), "place", "region", "peer_group"]).alias("place"))
    return q.side_by_side(ends, place).select(
        F.col("top.region").alias("top_region"), round_stable("top.mean", 2).alias("top_region_avg"),
        F.col("low.region").alias("low_region"), round_stable("low.mean", 2).alias("low_region_avg"),
        round_stable(ratio(F.col("top.mean") - F.col("low.mean"), F.col("low.mean")), 4).alias("gap"),
        F.col("place.place").alias("top_place"), F.col("place.place_avg").alias("top_place_avg"))


def outlier_facts(star: Star) -> DataFrame:
    """Sides and mean severity of all outlier rows and the most extreme of them.

    ``illustrative_extra`` is a made-up figure of the narrative, not a measurement.
    """
    rows = q.outlier_rows(star).withColumn("z", round_stable("net_z", 2))
    first = _best(["entity_name", "peer_group", "place", "z"], [-F.abs("net_z"), "entity_id", "item_code"])
    return rows.agg(
        *q.outlier_counts(),
        first.alias("top"), round_stable(F.avg(F.abs("z")), 2).alias("mean_abs_z"),
    ).select(
        "expensive", "cheap", F.col("top.entity_name").alias("top_entity"),
        F.col("top.peer_group").alias("top_peer"), F.col("top.place").alias("top_place"),
        F.col("top.z").alias("top_z"), "mean_abs_z",
        round_stable(F.abs("top.z") * 500 + 200, 2).alias("illustrative_extra"))


def overall_facts(star: Star) -> DataFrame:
    """Headline figures of the other fact rows."""
    listed = q.peer_figures(star).agg(
        F.count(F.lit(1)).alias("peers"), round_stable(F.avg("variation_ratio"), 2).alias("mean_ratio"))
    outliers = q.outlier_rows(star).agg(F.count(F.lit(1)).alias("total_outliers"))
    regions = q.place_figures(star).groupBy("region").agg(F.avg("place_avg").alias("mean")).agg(
        round_stable(F.when(F.count(F.lit(1)) >= 2, ratio(F.max("mean") - F.min("mean"), F.min("mean"))), 4)
        .alias("region_spread"))
    return q.side_by_side(listed, outliers, regions)


def context_rows(star: Star, peers: int = 5, places: int = 5, outliers: int = 5) -> DataFrame:
    """The leading rows of the variation, geographic and outlier queries as one text table."""
    def lines(section: str, df: DataFrame, n: int, *columns):
        return df.limit(n).select(
            F.lit(section).alias("section"),
            F.concat_ws(" | ", *columns).alias("line"))

    def two(name: str):
        return F.format_string("%.2f", name)

    return (
        lines("PEER VARIATION", q.peer_variation(star), peers,
              "peer_group", F.col("entity_count").cast("string"), two("avg_net"), two("variation_ratio"))
        .unionByName(lines("GEOGRAPHIC", q.geographic(star), places,
                           "place", "region", "peer_group", two("place_avg")))
        .unionByName(lines("OUTLIERS", q.outliers(star), outliers,
                           "entity_name", "peer_group", "place", two("net"), two("z_score")))
    )


def peer_sentence(facts: DataFrame) -> DataFrame:
    """One sentence over ``peer_facts``."""
    return facts.select(F.format_string(
        "%s shows a %.1fx variation ratio against a mean of %.1fx, while %s is the steadiest at %.1fx; "
        "%,d entities belong to peer groups far above the mean.",
        "top_peer", "top_ratio", "mean_ratio", "bottom_peer", "bottom_ratio", "entities_in_wide_peers").alias("text"))


def geo_sentence(facts: DataFrame) -> DataFrame:
    """One sentence over ``geo_facts``."""
    return facts.select(F.format_string(
        "Entities in %s cost %s more on average than those in %s; the costliest place is %s at a mean of %s.",
        "top_region", percent(F.col("gap")), "low_region", "top_place", money(F.col("top_place_avg"))).alias("text"))


def outlier_sentence(facts: DataFrame) -> DataFrame:
    """One sentence over ``outlier_facts``."""
    return facts.select(F.format_string(
        "Of all outlier rows %d are expensive and %d cheap; the most extreme is %s in %s (%s) with a z-score "
        "of %.1f, against a mean distance of %.1f.",
        "expensive", "cheap", "top_entity", "top_peer", "top_place", "top_z", "mean_abs_z").alias("text"))


def overall_sentence(facts: DataFrame) -> DataFrame:
    """One sentence over ``overall_facts``."""
    return facts.select(F.format_string(
        "Across %d peer groups the mean variation ratio is %.1fx, the regions differ by %s, and %d rows are outliers.",
        "peers", "mean_ratio", F.coalesce(percent(F.col("region_spread")), F.lit("N/A")), "total_outliers").alias("text"))
