"""Checks that run after a refresh or once a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import round_stable
from peerbench.operators.star import Star
from peerbench.plans.queries import most_extreme, outlier_rows


def outlier_alert(star: Star, threshold: int = 200) -> DataFrame:
    """Number and mean severity of the outlier rows, and whether they call for an alert."""
    return (
        star.measures.filter("is_outlier = 1")
        .agg(F.count(F.lit(1)).alias("outlier_count"), round_stable(F.avg(F.abs("net_z")), 2).alias("avg_severity"))
        .withColumn("threshold", F.lit(threshold).cast("int"))
        .withColumn("fires", (F.col("outlier_count") > threshold).cast("int"))
    )


def alert_rows(star: Star, limit: int = 10) -> DataFrame:
    """The rows an alert lists."""
    return most_extreme(outlier_rows(star), limit).select(
        "entity_name", "peer_group", "place", round_stable("net", 2).alias("net"),
        round_stable("net_z", 2).alias("z_score"))


def refresh_gate(star: Star, more_than: int = 1000) -> DataFrame:
    """Whether a refresh brought enough entities, with the counts to report."""
    measures = star.measures.agg(F.count(F.lit(1))).scalar()
    return (
        star.entities.agg(F.count(F.lit(1)).alias("entity_count"))
        .withColumn("measure_count", measures)
        .withColumn("status", F.when(F.col("entity_count") > more_than, "OK").otherwise("FAIL"))
    )
