"""Raw rows drawn from the documented distributions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.roles import RAW_COLUMNS
from peerbench.sources.dims import STATE_REGION

# Cost multiplier of every region.
REGION_MULTIPLIERS = {"Northeast": 1.20, "Southeast": 0.95, "Midwest": 0.90, "Southwest": 1.05, "West": 1.15}

# Population weight of every state.
STATE_WEIGHTS = {
    "CA": 10, "TX": 9, "FL": 8, "NY": 7, "PA": 5, "IL": 5, "OH": 4, "GA": 4, "NC": 4, "MI": 4, "NJ": 4,
    "VA": 3, "WA": 3, "AZ": 3, "TN": 3, "MA": 3, "IN": 3, "MO": 3, "MD": 3, "WI": 3,
    "CO": 2, "MN": 2, "SC": 2, "AL": 2, "LA": 2, "KY": 2, "OR": 2, "OK": 2, "CT": 2, "UT": 2,
    "IA": 1, "NV": 1, "AR": 1, "MS": 1, "KS": 1, "NM": 1, "NE": 1, "WV": 1, "ID": 1, "HI": 1, "NH": 1,
    "ME": 1, "RI": 1, "MT": 1, "DE": 1, "SD": 1, "ND": 1, "AK": 1, "VT": 1, "WY": 1,
}

# Mean and standard deviation of the net amount of every peer group.
PEER_COSTS = {
    "Cardiology": (3200, 1800), "Orthopedic Surgery": (4500, 2500), "Oncology": (5200, 3000),
    "Psychiatry": (800, 400), "Family Medicine": (350, 200), "Internal Medicine": (550, 300),
    "Neurology": (1800, 1000), "Dermatology": (650, 350), "Gastroenterology": (2100, 1200),
    "Pulmonology": (1500, 900), "Endocrinology": (900, 500), "Rheumatology": (1200, 700),
    "Urology": (2200, 1300), "Ophthalmology": (1100, 600), "Otolaryngology": (1600, 900),
    "Nephrology": (1700, 1000), "Hematology": (3800, 2200), "Infectious Disease": (1400, 800),
    "Geriatrics": (700, 400), "Allergy/Immunology": (750, 400), "Physical Medicine": (1000, 600),
    "Radiology": (1300, 700), "Pathology": (2400, 1400), "Anesthesiology": (3500, 2000),
    "Emergency Medicine": (1800, 1100), "Obstetrics/Gynecology": (1200, 700), "Pediatrics": (400, 220),
    "Vascular Surgery": (3900, 2200), "Thoracic Surgery": (6200, 3500), "Colorectal Surgery": (4100, 2300),
}

ITEMS_PER_PEER = 8
CITIES_PER_STATE = 5


def _uniform(seed: int, label: str) -> Column:
    """A number in [0, 1) that depends on seed, label and row id alone, so a rerun task repeats it."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(label), "id"), F.lit(2**53)) / F.lit(float(2**53))


def _normal(seed: int, label: str) -> Column:
    """A standard normal number by the Box-Muller transform."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _uniform(seed, label + " radius")))
    return radius * F.cos(F.lit(2.0 * pi) * _uniform(seed, label + " angle"))


def _draw(seed: int, label: str, n: int) -> Column:
    return F.floor(_uniform(seed, label) * n).cast("int")


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def synthesize_for(keys: DataFrame, seed: int = 42) -> DataFrame:
    """One raw row per id of ``keys`` (column ``id``): a pure projection without a shuffle.

    Peer groups take turns, states are drawn by weight, volumes are lognormal within 1..5000, and
    the net amount is a normal number with a floor of 10, times the multiplier of the region and a
    lognormal noise.
    """
    peers = list(PEER_COSTS)
    weighted = [state for state, weight in STATE_WEIGHTS.items() for _ in range(weight)]
    at = F.pmod("id", F.lit(len(peers))).cast("int")
    drawn = keys.select(
        "id", at.alias("peer"), _draw(seed, "state", len(weighted)).alias("spot"),
        _draw(seed, "item", ITEMS_PER_PEER).alias("item"),
        F.least(F.lit(5000), F.greatest(F.lit(1), F.floor(F.exp(4.5 + 1.2 * _normal(seed, "volume"))).cast("int")))
        .alias("volume"),
    )
    base = F.greatest(F.lit(10.0), _pick([float(m) for m, _ in PEER_COSTS.values()], F.col("peer"))
                      + _pick([float(s) for _, s in PEER_COSTS.values()], F.col("peer")) * _normal(seed, "cost"))
    multiplier = _pick([REGION_MULTIPLIERS[STATE_REGION[s]] for s in weighted], F.col("spot"))
    net = F.greatest(F.lit(10.0), F.round(base * multiplier * F.exp(0.3 * _normal(seed, "noise")), 2))
    priced = drawn.withColumn("net", net)
    peer = _pick(peers, F.col("peer"))
    columns = {
        "npi": (F.lit(1_000_000_000) + F.col("id")).cast("string"),
        "provider_last_name": F.format_string("Last%02d", _draw(seed, "last name", 50)),
        "provider_first_name": F.format_string("First%02d", _draw(seed, "first name", 50)),
        "provider_specialty": peer,
        "provider_state": _pick(weighted, F.col("spot")),
        "provider_city": F.concat(_pick(weighted, F.col("spot")), F.lit(" City "),
                                  (_draw(seed, "city", CITIES_PER_STATE) + 1).cast("string")),
        "provider_zip": (F.lit(10_000) + _draw(seed, "zip", 90_000)).cast("string"),
        "hcpcs_code": F.format_string("%05d", F.col("peer") * ITEMS_PER_PEER + F.col("item") + 1),
        "hcpcs_description": F.concat(peer, F.lit(" item "), (F.col("item") + 1).cast("string")),
        "total_beneficiaries": F.col("volume"),
        "total_services": F.floor(F.col("volume") * (1.1 + 2.4 * _uniform(seed, "services"))).cast("int"),
        "avg_submitted_charge": F.round(F.col("net") * (1.8 + 2.7 * _uniform(seed, "charge")), 2),
        "avg_medicare_payment": F.col("net"),
        "avg_beneficiary_age": F.least(F.lit(95.0), F.greatest(
            F.lit(40.0), F.round(68.0 + 8.0 * _normal(seed, "age"), 1))),
    }
    return priced.select(*[columns[c].alias(c) for c in RAW_COLUMNS])


def synthesize(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``n`` raw rows with unique ids."""
    return synthesize_for(spark.range(n), seed)
