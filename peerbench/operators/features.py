"""Derived columns of the service lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerbench.functions.labels import volume_tier
from peerbench.functions.numbers import flag, ratio, round_stable
from peerbench.functions.strings import title_case
from peerbench.operators.ranks import exact_quantiles
from peerbench.session import materialize, together

QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def add_ratios(df: DataFrame) -> DataFrame:
    """Net per unit of volume and gross over net, four decimals."""
    return df.withColumns({
        "net_per_unit": round_stable(ratio(F.col("net"), F.col("volume")), 4),
        "gross_net_ratio": round_stable(ratio(F.col("gross"), F.col("net")), 4),
    })


def volume_edges(df: DataFrame) -> DataFrame:
    """One row ``q0..q4``: quartile edges of the volume over the whole table."""
    edges = exact_quantiles(
        df, [], "volume", QUARTILES,
        extras=[F.min("volume").alias("q0"), F.max("volume").alias("q4")],
    )
    return materialize(edges, "edges")


def add_volume_tier(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Label every row by the quartile of its volume."""
    one = edges.select(F.struct("q0", *QUARTILES, "q4")).scalar()
    return df.withColumn("volume_tier", volume_tier("volume", one))


def peer_stats(df: DataFrame, value: str = "net") -> DataFrame:
    """Mean, sample standard deviation and 75th percentile of the value per peer group."""
    stats = exact_quantiles(
        df, ["peer_group"], value, {"peer_p75": 0.75},
        extras=[F.avg(value).alias("peer_mean"), F.stddev_samp(value).alias("peer_sd")],
    )
    return materialize(stats, "peer-stats")


def add_zscore(df: DataFrame, stats: DataFrame, value: str = "net") -> DataFrame:
    """Attach the peer statistics and the z-score, four decimals; no spread gives no score."""
    z = ratio(F.col(value) - F.col("peer_mean"), F.col("peer_sd"))
    return df.join(stats, "peer_group", "left").withColumn("net_z", round_stable(z, 4))


def add_zscore_window(df: DataFrame, value: str = "net") -> DataFrame:
    """The same score by a window over the peer group, for groups that one task can sort."""
    peers = Window.partitionBy("peer_group")
    z = ratio(F.col(value) - F.avg(value).over(peers), F.stddev_samp(value).over(peers))
    return df.withColumn("net_z", round_stable(z, 4))


def add_high_cost(df: DataFrame) -> DataFrame:
    return df.withColumn("is_high_cost", flag(F.col("net") > F.col("peer_p75")))


def add_outlier_flag(df: DataFrame) -> DataFrame:
    """1 where the rounded z-score lies strictly beyond two."""
    return df.withColumn("is_outlier", flag(F.abs("net_z") > 2))


def add_region(df: DataFrame, places: DataFrame) -> DataFrame:
    """Look up the region of the place, ``Unknown`` where there is none."""
    found = df.drop("region").join(places.select("place", "region"), "place", "left")
    return found.withColumn("region", F.coalesce("region", F.lit("Unknown")))


def add_entity_name(df: DataFrame) -> DataFrame:
    """Display name of the entity; null if either part is null."""
    if "last_name" in df.columns and "first_name" in df.columns:
        name = F.concat(F.lit("Dr. "), title_case("last_name"), F.lit(" "), title_case("first_name"))
    else:
        name = F.lit("Dr. Unknown")
    return df.withColumn("entity_name", name)


def enrich(cleaned: DataFrame, places: DataFrame) -> DataFrame:
    """All derived columns of cleaned lines.

    ``cleaned`` is read several times, so pass a stored table or a filter over one. The statistics are small tables written
    beforehand, so the lines themselves are only read and projected: no shuffle of the lines unless the peer groups
    outgrow a broadcast.
    """
    edges, stats = together(
        cleaned.sparkSession, lambda: volume_edges(cleaned), lambda: peer_stats(cleaned))
    return (
        cleaned.transform(add_ratios)
        .transform(add_volume_tier, edges)
        .transform(add_zscore, stats)
        .transform(add_high_cost)
        .transform(add_outlier_flag)
        .transform(add_region, places)
        .transform(add_entity_name)
    )
