"""The data behind the exploratory charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import round_stable
from peerbench.operators.ranks import exact_quantiles, histogram, merge_histograms
from peerbench.operators.sampling import fixed_sample
from peerbench.operators.star import Star
from peerbench.plans.queries import entity_count, mean_of, named_agg, rollup_ratio, side_by_side
from peerbench.session import materialize, together


def peer_measures(star: Star) -> DataFrame:
    """Measure rows with peer group, place, region and volume of their entity."""
    return star.merged.select(
        "entity_id", "item_code", "peer_group", "place", "region", "total_volume",
        "net", "net_z", "gross_net_ratio", "is_outlier")


def summary(star: Star) -> DataFrame:
    """Rows, entities, peers, places, and the distribution of the net amount, in one row."""
    counts = star.rollup.agg(
        F.sum("n_rows").alias("rows"), entity_count().alias("entities"),
        F.count_distinct("peer_group").alias("peers"), F.count_distinct("place").alias("places"),
        F.sum("n_outliers").alias("_outliers"))
    net = exact_quantiles(star.measures, [], "net", {"median": 0.5}, extras=[
        F.avg("net").alias("mean"), F.stddev_samp("net").alias("sd")])
    return side_by_side(counts, net).select(
        "rows", "entities", "peers", "places",
        round_stable("mean", 2).alias("mean_net"), round_stable("median", 2).alias("median_net"),
        round_stable("sd", 2).alias("sd_net"),
        round_stable(F.col("_outliers") / F.col("rows"), 4).alias("outlier_fraction"))


def box_stats(star: Star, top: int = 10) -> DataFrame:
    """Box-plot figures per (peer group, outlier flag) of the peers with the largest deviation.

    Whiskers are the outermost values within 1.5 interquartile ranges of the box; what lies
    beyond is counted as fliers. Peers come in descending order of their median.
    """
    rows = peer_measures(star).where("peer_group is not null")
    spread = rows.groupBy("peer_group").agg(F.stddev_samp("net").alias("sd"))
    widest = materialize(spread.filter("sd is not null").orderBy(F.desc("sd"), "peer_group").limit(top).select("peer_group"), "widest")
    kept = rows.join(widest, "peer_group", "left_semi").where("is_outlier is not null")
    every = rows.join(widest, "peer_group", "left_semi")
    # one scan counts for both groupings
    bins = materialize(histogram(every, ["peer_group", "is_outlier"], "net"), "bins")
    medians, boxes = together(
        rows.sparkSession,
        lambda: materialize(exact_quantiles(every, ["peer_group"], "net", {"peer_median": 0.5}, counts=merge_histograms(bins, ["peer_group"])), "medians"),
        lambda: materialize(exact_quantiles(
            kept, ["peer_group", "is_outlier"], "net", {"q1": 0.25, "median": 0.5, "q3": 0.75}, counts=bins.where("is_outlier is not null")), "boxes"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("net") >= F.col("q1") - reach) & (F.col("net") <= F.col("q3") + reach)
    whiskers = named_agg(
        kept.join(boxes, ["peer_group", "is_outlier"]).groupBy("peer_group", "is_outlier"),
        rows=F.count(F.lit(1)),
        low_whisker=F.min(F.when(inside, F.col("net"))), high_whisker=F.max(F.when(inside, F.col("net"))),
        fliers=F.count_if(~inside),
    )
    figures = ("q1", "median", "q3", "low_whisker", "high_whisker", "peer_median")
    return (
        boxes.join(whiskers, ["peer_group", "is_outlier"]).join(medians, "peer_group")
        .orderBy(F.desc("peer_median"), "peer_group", "is_outlier")
        .select("peer_group", "is_outlier", "rows", "fliers", *[round_stable(c, 2).alias(c) for c in figures])
    )


def place_mean(star: Star) -> DataFrame:
    """Mean net amount per place with its region, cheapest first."""
    return named_agg(star.rollup.groupBy("place", "region"), avg_net=round_stable(mean_of("net"), 2)).orderBy(
        "avg_net", "place", "region")


def top_peers(star: Star, order: Column, top: int) -> DataFrame:
    """Names of the peer groups that lead by an aggregate of the entity rollups."""
    return (
        star.rollup.groupBy("peer_group").agg(order.alias("_by")).filter("_by is not null")
        .orderBy(F.desc("_by"), "peer_group").limit(top).select("peer_group")
    )


def volume_scatter(star: Star, top: int = 8, points: int = 5000, seed: int = 42) -> DataFrame:
    """A sample of measure rows of the most frequent peers: volume, net amount and dot size."""
    kept = peer_measures(star).join(top_peers(star, F.sum("n_rows"), top), "peer_group", "left_semi")
    size = F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.col("gross_net_ratio"))) * 5
    return fixed_sample(kept, ["entity_id", "item_code"], points, seed).select(
        "entity_id", "item_code", "peer_group", "total_volume",
        round_stable("net", 2).alias("net"),
        round_stable(F.when(F.col("gross_net_ratio").isNotNull(), size), 3).alias("dot_size"))


def z_histogram(star: Star, bins: int = 80, reach: float = 6.0) -> DataFrame:
    """Equal-width histogram of the z-scores within the reach; empty bins are kept.

    Edges run from the smallest to the largest score; the last bin includes its right edge. The
    count of all outlier rows, trimmed or not, is repeated on every bin.
    """
    scores = star.measures.filter(F.col("net_z").between(-reach, reach)).select("net_z")
    span = scores.agg(F.struct(F.min("net_z").alias("low"), F.max("net_z").alias("high"))).scalar()
    width = (span["high"] - span["low"]) / bins
    at = F.least(F.floor((F.col("net_z") - span["low"]) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    counted = scores.groupBy(F.coalesce(at, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    flagged = star.measures.agg(F.count_if(F.col("is_outlier") == 1)).scalar()
    every = star.entities.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        round_stable(span["low"] + F.col("bin") * width, 4).alias("low_edge"),
        round_stable(span["low"] + (F.col("bin") + 1) * width, 4).alias("high_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        flagged.alias("outlier_rows"),
    ).orderBy("bin")


def variation_top(star: Star, top: int = 15) -> DataFrame:
    """The peers with the widest ratio of largest to smallest net amount, ascending."""
    widest = (
        star.rollup.groupBy("peer_group").agg(
            F.when(F.min("min_net") > 0, rollup_ratio()).alias("ratio"))
        .filter("ratio is not null").orderBy(F.desc("ratio"), "peer_group").limit(top)
    )
    return widest.select("peer_group", round_stable("ratio", 2).alias("variation_ratio")).orderBy(
        "variation_ratio", "peer_group")


def region_pivot(star: Star, regions: list[str], top: int | None = 5) -> DataFrame:
    """Mean net amount of the costliest peers (or of all) in the given regions, one column per region."""
    kept = star.rollup.filter(F.col("region").isin(regions))
    if top is not None:
        kept = kept.join(top_peers(star, mean_of("net"), top), "peer_group", "left_semi")
    wide = kept.groupBy("peer_group").pivot("region", regions).agg(round_stable(mean_of("net"), 2))
    return wide.fillna(0.0, subset=regions).orderBy("peer_group")
