"""Data-quality checks: each is an aggregate, together they form one report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import flag, round_stable
from peerbench.operators.star import Star


def duplicates(df: DataFrame, keys: tuple[str, ...] = ("entity_id", "item_code")) -> DataFrame:
    """Rows that repeat a key beyond its first occurrence."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_more")).agg(
        F.coalesce(F.sum("_more"), F.lit(0)).alias("duplicate_rows"))


def repeated_ids(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """Ids that are not unique."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("repeated_ids"))


def orphans(star: Star) -> DataFrame:
    """Rows of each table whose entity is missing."""
    out = None
    for name in ("items", "measures", "segments"):
        lost = getattr(star, name).join(star.entities, "entity_id", "left_anti").agg(
            F.count(F.lit(1)).alias("orphan_rows")).select(F.lit(name).alias("table_name"), "orphan_rows")
        out = lost if out is None else out.unionByName(lost)
    return out


def outlier_flag_errors(star: Star) -> DataFrame:
    """Flagged rows within two deviations and unflagged rows beyond them."""
    beyond = flag(F.abs("net_z") > 2)
    return star.measures.agg(
        F.count_if((F.col("is_outlier") == 1) & (beyond == 0)).alias("wrongly_flagged"),
        F.count_if((F.col("is_outlier") == 0) & (beyond == 1)).alias("wrongly_unflagged"))


def ratio_checks(star: Star) -> DataFrame:
    """Gross below net, non-positive net per unit, and the share of ratios below 0.99."""
    return star.measures.agg(
        F.count_if(F.col("gross") < F.col("net")).alias("gross_below_net"),
        F.count_if(F.col("net_per_unit") <= 0).alias("unit_not_positive"),
        round_stable(F.avg((F.col("gross_net_ratio") < 0.99).cast("int")), 6).alias("low_ratio_share"))


def quality_report(scored: DataFrame, places_expected: int, peers_expected: int) -> DataFrame:
    """check, observed, threshold, severity, passed: reported, never blocking.

    The expected numbers of places and peer groups come from the dimensions the caller knows.

    Grouped counts come from one pass per (entity, item), whose result is small per task.
    """
    pairs = scored.groupBy("entity_id", "item_code").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("net") < 0).alias("negative"),
        F.sum("net_z").alias("z_sum"), F.count("net_z").alias("z_n"),
        F.count_if(F.isnan("net_z") | (F.abs("net_z") == float("inf"))).alias("z_bad"),
        F.max("net").alias("net_max"), F.sum("is_outlier").alias("outliers"))
    totals = pairs.agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum("negative").alias("negative"),
        (F.sum("z_sum") / F.nullif(F.sum("z_n"), F.lit(0))).alias("z_mean"), F.sum("z_bad").alias("z_bad"),
        F.max("net_max").alias("net_max"), F.count_distinct("entity_id").alias("entities"),
        F.sum("outliers").alias("outliers"), (F.sum("n") - F.sum("z_n")).alias("z_null"))
    kinds = scored.groupBy("place", "peer_group").agg(F.count(F.lit(1))).agg(
        F.count_distinct("place").alias("places"), F.count_distinct("peer_group").alias("peers"))
    one = kinds.select(F.struct("places", "peers")).scalar()

    def row(check, observed, threshold, severity, passed):
        return F.struct(
            F.lit(check).alias("check_name"), round_stable(observed, 4).alias("observed"),
            F.lit(threshold).cast("double").alias("threshold"), F.lit(severity).alias("severity"),
            flag(passed).alias("passed"))

    yes = F.lit(True)
    rows = F.array(
        row("duplicate_pairs", F.col("duplicates"), 0.0, "WARNING", F.col("duplicates") == 0),
        row("negative_net", F.col("negative"), 0.0, "ERROR", F.col("negative") == 0),
        row("mean_z", F.abs("z_mean"), 0.5, "WARNING", F.abs("z_mean") <= 0.5),
        row("z_not_finite", F.col("z_bad"), 0.0, "ERROR", F.col("z_bad") == 0),
        row("max_net", F.col("net_max"), 1e6, "WARNING", F.col("net_max") <= 1e6),
        row("places_covered", F.col("places"), float(places_expected), "INFO", F.col("places") >= places_expected),
        row("peers_covered", F.col("peers"), float(peers_expected), "INFO", F.col("peers") >= peers_expected),
        row("total_rows", F.col("rows"), None, "INFO", yes),
        row("distinct_entities", F.col("entities"), None, "INFO", yes),
        row("outlier_rows", F.col("outliers"), None, "INFO", yes),
        row("missing_z", F.col("z_null"), None, "INFO", yes),
    )
    return (
        totals.withColumns({"places": one["places"], "peers": one["peers"]})
        .select(F.explode(rows).alias("r")).select("r.*")
    )


def passed(report: DataFrame) -> DataFrame:
    """Overall verdict: no failed warning or error."""
    bad = (F.col("passed") == 0) & F.col("severity").isin("WARNING", "ERROR")
    return report.agg((F.count_if(bad) == 0).cast("int").alias("all_passed"))


def missing_values(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected values (one column) that do not occur."""
    return expected.distinct().join(actual.distinct(), expected.columns, "left_anti")


# The names a cluster may bear.
CLUSTER_NAMES = ("Outlier Billers", "Premium Specialists", "Community Providers", "Standard Practice")


def cluster_coverage(segments: DataFrame) -> DataFrame:
    """Share of entities with a cluster, unknown names, number of clusters, and the verdict."""
    return segments.agg(
        round_stable(F.count("cluster_id") / F.count(F.lit(1)), 4).alias("coverage"),
        F.count_if(~F.col("cluster_name").isin(*CLUSTER_NAMES)).alias("unknown_names"),
        F.count_distinct("cluster_id").alias("clusters"),
    ).withColumn("passed", flag(
        (F.col("coverage") >= 0.95) & (F.col("unknown_names") == 0) & F.col("clusters").between(2, 6)))
