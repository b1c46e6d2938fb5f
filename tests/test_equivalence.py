"""Results do not depend on how rows are partitioned, and hot keys change nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from peerbench.operators import clean, features
from peerbench.operators.sampling import fixed_sample
from peerbench.operators.star import star_tables
from peerbench.plans import eda, profiles, queries
from peerbench.roles import Roles
from peerbench.sources import dims
from tests.synthetic import synthesize


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def lines(spark):
    """Synthetic lines where one peer group and one item hold more than a third of the rows."""
    raw = Roles().rename(synthesize(spark, 6000))
    hot = F.col("entity_id").cast("long") % 5 < 2
    return clean.clean(raw.withColumns({
        "peer_group": F.when(hot, "Hot Peer").otherwise(F.col("peer_group")),
        "item_code": F.when(hot, "99999").otherwise(F.col("item_code")),
        "net": F.when(hot & (F.col("volume") < 100), F.lit(500.0)).otherwise(F.col("net")),
    })).checkpoint()


@pytest.fixture(scope="module")
def star(spark, lines):
    return star_tables(features.enrich(lines, dims.state_regions(spark)).checkpoint())


def test_z_score_equals_the_window_form(lines):
    got = features.add_zscore(lines, features.peer_stats(lines)).select("entity_id", "net_z")
    w = Window.partitionBy("peer_group")
    z = (F.col("net") - F.avg("net").over(w)) / F.nullif(F.stddev_samp("net").over(w), F.lit(0.0))
    want = lines.select("entity_id", z.alias("w"))
    assert got.join(want, "entity_id").filter(F.abs(F.col("net_z") - F.col("w")) > 0.0001).isEmpty()


def test_partitioning_does_not_matter(spark, lines, star):
    other = star_tables(features.enrich(lines.repartition(16), dims.state_regions(spark)).checkpoint())
    single = star_tables(features.enrich(lines.coalesce(1), dims.state_regions(spark)).checkpoint())
    for query in (queries.peer_variation, queries.geographic, queries.volume_cost, queries.outliers,
                  queries.item_spread, queries.item_quartiles_strict, eda.z_histogram, profiles.peer_profile):
        assert same(query(star), query(other)), query
        assert same(query(star), query(single)), query


def test_hot_item_quartiles_equal_the_window(star):
    got = queries.item_quartiles_strict(star).groupBy("item_desc", "net_quartile").count()
    rows = star.items.join(star.measures, ["entity_id", "item_code"])
    want = rows.selectExpr(
        "item_desc", "ntile(4) over (partition by item_code order by net, md5(concat_ws('|', entity_id, item_code))) as net_quartile"
    ).groupBy("item_desc", "net_quartile").count()
    assert same(got, want)


def test_samples_are_stable(lines):
    a = fixed_sample(lines.repartition(3), ["entity_id"], 100, 1).select("entity_id")
    b = fixed_sample(lines.repartition(11), ["entity_id"], 100, 1).select("entity_id")
    assert a.count() == 100 and same(a, b)
    plain = lines.orderBy(F.md5(F.concat_ws("|", F.lit("1"), "entity_id"))).limit(100).select("entity_id")
    assert same(a, plain)
    assert fixed_sample(lines.limit(7).checkpoint(), ["entity_id"], 100, 1).count() == 7
    assert not same(a, fixed_sample(lines, ["entity_id"], 100, 2).select("entity_id"))


def test_lookups_by_key(star):
    one = star.entities.orderBy("entity_id").first()
    profile = profiles.entity_profile(star, one["entity_id"]).collect()
    assert len(profile) == 1 and profile[0]["cluster_name"] == "Unassigned"
    assert one["entity_name"] in profile[0]["summary"] and len(profile[0]["items"]) == 1
    assert profiles.entity_profile(star, "nobody").isEmpty()
    assert profiles.peer_profile(star, "Hot Peer").count() == 1
    assert profiles.entity_lookup(star, one["entity_id"]).count() == 1
    hot = profiles.outlier_list(star, peer_group="Hot Peer", place=one["place"].lower(), limit=200)
    assert hot.filter((F.col("peer_group") != "Hot Peer") | (F.col("place") != one["place"])).isEmpty()
    with pytest.raises(ValueError):
        profiles.outlier_list(star, limit=0)


def test_lookup_filter_reaches_the_scan(spark, star, tmp_path):
    from peerbench.operators.star import read_star, write_star
    stored = read_star(spark, write_star(star, str(tmp_path / "star")))
    plan = profiles.entity_lookup(stored, "1000000001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(entity_id,1000000001)") >= 2
