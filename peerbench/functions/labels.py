"""Case expressions that turn a measure into a label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def outlier_type(z: Column | str) -> Column:
    """Side of the outlier by its z-score, null between -2 and 2."""
    z = F.col(z) if isinstance(z, str) else z
    return F.when(z > 2, F.lit("Expensive Outlier")).when(z < -2, F.lit("Cheap Outlier"))


def outlier_side(z: Column | str) -> Column:
    """Two-way spelling for the dashboard: whatever is not expensive is cheap."""
    z = F.col(z) if isinstance(z, str) else z
    return F.when(z > 2, F.lit("Expensive")).otherwise(F.lit("Cheap"))


def performance_tier(z: Column | str) -> Column:
    """Five cost tiers over the mean z-score of an entity."""
    z = F.col(z) if isinstance(z, str) else z
    return (
        F.when(z.isNull(), "Unknown")
        .when(z > 1.5, "High Cost")
        .when(z > 0.5, "Above Average")
        .when(z > -0.5, "Average")
        .when(z > -1.5, "Below Average")
        .otherwise("Low Cost")
    )


def volume_tier(volume: Column | str, edges: Column) -> Column:
    """Quartile label for right-closed edges ``q0..q4``; collapsed edges make every row Medium."""
    v = F.col(volume) if isinstance(volume, str) else volume
    cuts = [edges[f"q{i}"] for i in range(5)]
    collapsed = F.size(F.array_distinct(F.array(*cuts))) < 5
    return (
        F.when(collapsed, "Medium")
        .when(v <= cuts[1], "Low")
        .when(v <= cuts[2], "Medium")
        .when(v <= cuts[3], "High")
        .otherwise("Very High")
    )
