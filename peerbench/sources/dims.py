"""Constant lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Region of every state.
STATE_REGION = {
    "CT": "Northeast", "ME": "Northeast", "MA": "Northeast", "NH": "Northeast", "NJ": "Northeast",
    "NY": "Northeast", "PA": "Northeast", "RI": "Northeast", "VT": "Northeast",
    "AL": "Southeast", "AR": "Southeast", "DE": "Southeast", "FL": "Southeast", "GA": "Southeast",
    "KY": "Southeast", "LA": "Southeast", "MD": "Southeast", "MS": "Southeast", "NC": "Southeast",
    "SC": "Southeast", "TN": "Southeast", "VA": "Southeast", "WV": "Southeast",
    "IL": "Midwest", "IN": "Midwest", "IA": "Midwest", "KS": "Midwest", "MI": "Midwest", "MN": "Midwest",
    "MO": "Midwest", "NE": "Midwest", "ND": "Midwest", "OH": "Midwest", "SD": "Midwest", "WI": "Midwest",
    "AZ": "Southwest", "NM": "Southwest", "OK": "Southwest", "TX": "Southwest",
    "AK": "West", "CA": "West", "CO": "West", "HI": "West", "ID": "West", "MT": "West", "NV": "West",
    "OR": "West", "UT": "West", "WA": "West", "WY": "West",
}


def state_regions(spark: SparkSession) -> DataFrame:
    """place, region: the 50 states."""
    return spark.createDataFrame(list(STATE_REGION.items()), "place string, region string")
