"""The given Parquet tables mapped onto the roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """place, region: one row per nation."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("place"), F.col("r_name").alias("region"))


def service_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, part type): the service lines every operator starts from.

    Lines meet their order and are aggregated per (order, part type) on the same exchange by order, so that each
    order counts once per group without a distinct count; a hot order is split by the join (which then costs
    one more shuffle). The customer's attributes are joined last: only keys and measures go through wide shuffles.
    """
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("place"))
    price = F.col("l_extendedprice")
    gross, net = price * (1 + F.col("l_tax")), price * (1 - F.col("l_discount"))
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey).join(orders, lineitem.l_orderkey == orders.o_orderkey)
    per_order = lines.groupBy("l_orderkey", "o_custkey", "p_type").agg(
        F.sum("l_quantity").alias("services"), F.sum(gross).alias("gross"), F.count(gross).alias("n_gross"),
        F.sum(net).alias("net"), F.count(net).alias("n_net"))
    grain = (
        per_order.groupBy(F.col("o_custkey").alias("entity_id"), F.col("p_type").alias("item_code"))
        .agg(
            F.count(F.lit(1)).alias("volume"),
            F.sum("services").alias("services"),
            (F.sum("gross") / F.nullif(F.sum("n_gross"), F.lit(0))).alias("gross"),
            (F.sum("net") / F.nullif(F.sum("n_net"), F.lit(0))).alias("net"),
        )
    )
    name = F.split("c_name", "#")
    people = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("entity_id"),
        name[0].alias("last_name"),
        name[1].alias("first_name"),
        F.col("c_mktsegment").alias("peer_group"),
        "place",
        F.concat_ws("/", "place", (F.col("c_custkey") % 5).cast("string")).alias("locality"),
    )
    return grain.join(people, "entity_id").withColumn("item_desc", F.concat(F.lower("item_code"), F.lit(" item")))


def damaged_text(lines: DataFrame) -> DataFrame:
    """The lines as a raw text file would hold them, with gaps and bad values where the data says so."""
    text = {c: F.col(c).cast("string") for c in ("entity_id", "services", "gross")}
    return lines.withColumns({
        **text,
        "peer_group": F.when((F.col("volume") == 1) & (F.col("services") > 45), "")
        .otherwise(F.concat(F.lit("  "), F.lower("peer_group"), F.lit(" "))),
        "net": F.when(F.col("volume") >= 10, "NA").when(F.col("gross") < 20000, "-1.0")
        .otherwise(F.col("net").cast("string")),
        "volume": F.when(F.col("services").between(48, 50), "abc").otherwise(F.col("volume").cast("string")),
    })


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed measures: who, which peer group, how much, when (with a time zone)."""
    return with_event_roles(read_table(spark, sf_dir, "events"))


def with_event_roles(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        F.col("event_type").alias("peer_group"),
        F.col("value").alias("net"),
        F.col("ts").cast("timestamp").alias("at"),
    )
