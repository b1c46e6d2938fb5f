"""Names of the raw columns and of the roles they play."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 14 columns of the raw file, in file order.
RAW_COLUMNS = (
    "npi", "provider_last_name", "provider_first_name", "provider_specialty", "provider_state",
    "provider_city", "provider_zip", "hcpcs_code", "hcpcs_description", "total_beneficiaries",
    "total_services", "avg_submitted_charge", "avg_medicare_payment", "avg_beneficiary_age",
)


@dataclass(frozen=True)
class Roles:
    """Which raw column plays which role; the defaults are those of the raw file."""

    entity_id: str = "npi"
    last_name: str = "provider_last_name"
    first_name: str = "provider_first_name"
    peer_group: str = "provider_specialty"
    place: str = "provider_state"
    locality: str = "provider_city"
    item_code: str = "hcpcs_code"
    item_desc: str = "hcpcs_description"
    volume: str = "total_beneficiaries"
    services: str = "total_services"
    gross: str = "avg_submitted_charge"
    net: str = "avg_medicare_payment"
    age: str = "avg_beneficiary_age"

    def rename(self, df):
        """Rename the raw columns that are present to their roles; others stay as they are."""
        return df.withColumnsRenamed({raw: role for role, raw in vars(self).items() if raw in df.columns})


CRITICAL = ("entity_id", "peer_group", "net")
NUMERIC = ("volume", "services", "gross", "net", "age")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def star_schemas(id_type: T.DataType = T.StringType()) -> dict[str, T.StructType]:
    """The pinned schemas of the four star tables."""
    s, i, n, d = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
    return {
        "entities": _struct(("entity_id", id_type), ("entity_name", s), ("peer_group", s), ("place", s),
                            ("locality", s), ("region", s), ("total_volume", n), ("volume_tier", s)),
        "items": _struct(("entity_id", id_type), ("item_code", s), ("item_desc", s), ("services", d)),
        "measures": _struct(("entity_id", id_type), ("item_code", s), ("gross", d), ("net", d),
                            ("net_per_unit", d), ("gross_net_ratio", d), ("net_z", d), ("is_outlier", i)),
        "segments": _struct(("entity_id", id_type), ("item_diversity", n), ("avg_z", d), ("cluster_id", i),
                            ("cluster_name", s), ("performance_tier", s)),
    }
