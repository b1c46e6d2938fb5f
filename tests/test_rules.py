"""The semantic rules on hand-sized frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from peerbench.functions.labels import outlier_side, outlier_type, performance_tier
from peerbench.functions.numbers import flag, ratio, round_stable, to_number
from peerbench.functions.strings import money, null_if_token, percent, title_case
from peerbench.operators import clean, features
from peerbench.operators.star import star_tables
from peerbench.plans import alerts, queries


def column(df, name):
    return [r[name] for r in df.collect()]


def nets(spark, *rows):
    return spark.createDataFrame(list(rows), "peer_group string, net double")


def scored(spark, rows):
    """Lines (entity, peer, place, item, volume, services, gross, net) taken through all steps."""
    lines = spark.createDataFrame(
        rows, "entity_id string, peer_group string, place string, item_code string, volume double, services double, "
        "gross double, net double"
    ).withColumns({"item_desc": F.concat(F.lower("item_code"), F.lit(" item")), "locality": F.lit("L"),
                   "last_name": F.lit("o'neil"), "first_name": F.lit("ann-marie")})
    places = spark.createDataFrame([("P", "North")], "place string, region string")
    return features.enrich(clean.clean(lines), places)


def test_peer_statistics_and_scores(spark):
    df = nets(spark, ("A", 10.0), ("A", 20.0), ("A", 30.0), ("A", 40.0), ("B", 7.0), ("C", 5.0), ("C", 5.0), ("C", 5.0))
    stats = {r["peer_group"]: r for r in features.peer_stats(df).collect()}
    assert stats["A"]["peer_mean"] == 25 and round(stats["A"]["peer_sd"], 4) == 12.9099
    assert stats["A"]["peer_p75"] == 32.5
    assert stats["B"]["peer_sd"] is None and stats["C"]["peer_sd"] == 0
    out = df.transform(features.add_zscore, features.peer_stats(df)).transform(features.add_high_cost)
    out = out.transform(features.add_outlier_flag).orderBy("peer_group", "net").collect()
    assert [r["net_z"] for r in out] == [-1.1619, -0.3873, 0.3873, 1.1619, None, None, None, None]
    assert [r["is_high_cost"] for r in out] == [0, 0, 0, 1, 0, 0, 0, 0]
    assert [r["is_outlier"] for r in out] == [0] * 8


def test_outlier_test_uses_the_rounded_score(spark):
    df = nets(spark, ("A", 2.00004), ("A", 2.00006), ("A", -2.00006), ("A", None))
    stats = spark.createDataFrame([("A", 0.0, 1.0, 0.0)], "peer_group string, peer_mean double, peer_sd double, peer_p75 double")
    out = df.transform(features.add_zscore, stats).transform(features.add_outlier_flag).collect()
    assert [(r["net_z"], r["is_outlier"]) for r in out] == [(2.0, 0), (2.0001, 1), (-2.0001, 1), (None, 0)]


@pytest.mark.parametrize("volumes,tiers", [
    ([1, 2, 3, 4, 5], ["Low", "Low", "Medium", "High", "Very High"]),
    ([1, 1, 1, 1, 2, 3], ["Medium"] * 6),
])
def test_volume_tiers(spark, volumes, tiers):
    df = spark.createDataFrame([(float(v),) for v in volumes], "volume double")
    out = features.add_volume_tier(df, features.volume_edges(df)).orderBy("volume")
    assert column(out, "volume_tier") == tiers


def test_dirty_numbers(spark):
    texts = [" 5 ", "abc", "NA", "nan", "", "1e3", "-1", "0", "1d", "2.5f", "inf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = column(df.select(to_number("t").alias("n")), "n")
    assert got == [5.0, None, None, None, None, 1000.0, -1.0, 0.0, None, None, None]


def test_cleaning_keeps_positive_rows_only(spark):
    rows = [("1", "a", "5", "1"), ("2", "a", "nan", "1"), ("3", "NA", "5", "1"), ("4", "a", "-1", "1"),
            ("5", "a", "5", "0"), ("6", "a", "5", "abc"), ("7", " na ", "1e3", "2"), (None, "a", "5", "1")]
    df = spark.createDataFrame(rows, "entity_id string, peer_group string, net string, volume string")
    out = clean.clean(df).orderBy("entity_id").collect()
    assert [(r["entity_id"], r["peer_group"], r["net"]) for r in out] == [("1", "A", 5.0), ("7", "Na", 1000.0)]
    # the tokens "nan" and "NA" and the missing id go first, the bad numbers later
    assert column(clean.drop_critical(clean.null_tokens(df)).orderBy("entity_id"), "entity_id") == ["1", "4", "5", "6", "7"]


def test_null_tokens_match_exactly(spark):
    df = spark.createDataFrame([("NA",), (" na ",), ("NaN",), ("none",), ("None",), ("00840",), ("",)], "t string")
    assert column(df.select(null_if_token("t").alias("t")), "t") == [None, " na ", None, "none", None, "00840", None]


def test_title_case(spark):
    df = spark.createDataFrame([(" allergy/immunology ",), ("O'BRIEN-mc2x",), (None,)], "peer_group string")
    assert column(clean.title_peer(df), "peer_group") == ["Allergy/Immunology", "O'Brien-Mc2X", None]
    assert column(df.select(title_case("peer_group").alias("t")), "t")[0] == " Allergy/Immunology "


def test_region_and_name(spark):
    df = spark.createDataFrame([("P",), ("ZZ",), (None,)], "place string")
    places = spark.createDataFrame([("P", "North")], "place string, region string")
    out = {r["place"]: r for r in features.add_entity_name(features.add_region(df, places)).collect()}
    assert out["P"]["region"] == "North" and out["ZZ"]["region"] == "Unknown" and out[None]["region"] == "Unknown"
    assert out["P"]["entity_name"] == "Dr. Unknown"
    named = spark.createDataFrame([("smith", "ANN"), (None, "ANN")], "last_name string, first_name string")
    assert column(features.add_entity_name(named), "entity_name") == ["Dr. Smith Ann", None]


def test_labels(spark):
    zs = [None, 1.51, 1.5, 0.5, -0.5, -1.5, 2.1, -2.1, 2.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double").select(
        performance_tier("z").alias("tier"), outlier_type("z").alias("kind"), outlier_side("z").alias("side"))
    assert column(df, "tier")[:6] == ["Unknown", "High Cost", "Above Average", "Average", "Below Average", "Low Cost"]
    assert column(df, "kind")[6:] == ["Expensive Outlier", "Cheap Outlier", None]
    assert column(df, "side")[6:] == ["Expensive", "Cheap", "Cheap"]


def test_numbers(spark):
    df = spark.range(1).select(
        round_stable(F.lit(-0.00001), 2).alias("zero"), round_stable(F.lit(1.005), 2).alias("up"),
        ratio(F.lit(1.0), F.lit(0.0)).alias("guarded"), flag(F.lit(None).cast("boolean")).alias("unknown"),
        money(F.lit(4764.6)).alias("big"), money(F.lit(12.34)).alias("small"), percent(F.lit(0.328)).alias("share"))
    r = df.first()
    assert (r["zero"], str(r["zero"])) == (0.0, "0.0")
    assert r["up"] == 1.01 and r["guarded"] is None and r["unknown"] == 0
    assert (r["big"], r["small"], r["share"]) == ("$4,765", "12.3", "32.8%")


def test_fan_out_of_a_two_item_entity(spark):
    rows = [("e1", "a", "P", "X", 4.0, 1.0, 2.0, 1.0), ("e1", "a", "P", "Y", 6.0, 1.0, 4.0, 3.0)]
    star = star_tables(scored(spark, rows))
    assert [r["total_volume"] for r in star.entities.collect()] == [10]
    assert sum(r["total_volume_served"] for r in queries.volume_cost(star).collect()) == 20
    assert queries.item_quartiles(star).count() == 4
    assert queries.item_quartiles_strict(star).count() == 2
    item = {r["item_desc"]: r for r in queries.item_spread(star, more_than=0).collect()}
    assert item["x item"]["avg_net"] == 1 and item["y item"]["net_spread"] == 0


def test_repeated_pairs_weigh_like_the_join(spark):
    """Two equal item rows meet two measure rows: the join would give four rows."""
    rows = [("e1", "a", "P", "X", 4.0, 1.0, 2.0, 1.0), ("e1", "a", "P", "X", 4.0, 1.0, 2.0, 5.0),
            ("e2", "a", "P", "X", 4.0, 1.0, 2.0, 9.0)]
    star = star_tables(scored(spark, rows))
    pair = ["entity_id", "item_code"]
    want = star.items.join(star.measures, pair).agg(F.avg("net").alias("m"), F.max("net"), F.min("net")).first()
    got = queries.item_spread(star, more_than=1).first()
    assert got["avg_net"] == round(want["m"], 2) and got["entities"] == 2


def test_entity_attributes_do_not_depend_on_row_order(spark):
    rows = [("e1", "b", "P", "Y", 9.0, 1.0, 2.0, 1.0), ("e1", "a", "ZZ", "X", 1.0, 1.0, 2.0, 1.0)]
    for order in (rows, rows[::-1]):
        entity = star_tables(scored(spark, order)).entities.first()
        assert (entity["peer_group"], entity["place"], entity["region"]) == ("A", "ZZ", "Unknown")


def test_limits_and_ties(spark):
    rows = [(f"e{i:02d}", "a", "P", code, 1.0, 1.0, 20.0, 10.0) for i in range(15) for code in "XYZ"]
    rows += [(f"h{i}", "a", "P", "X", 1.0, 1.0, 2000.0, 1000.0) for i in range(2)]
    star = star_tables(scored(spark, rows))
    assert queries.item_spread(star, limit=2).count() == 2
    assert column(queries.most_extreme(queries.outlier_rows(star), 1), "entity_id") == ["h0"]
    assert queries.peer_variation(star).count() == 0 and queries.peer_variation(star, 10).count() == 1
    assert queries.peer_variation(star, 10).first()["variation_ratio"] == 100
    alert = alerts.outlier_alert(star, threshold=1).first()
    assert (alert["outlier_count"], alert["fires"]) == (2, 1)
    assert alerts.refresh_gate(star).first()["status"] == "FAIL"
    assert alerts.refresh_gate(star, 5).first()["status"] == "OK"


def test_registry_runs_all_six(spark):
    rows = [(f"e{i}", "a", "P", c, 1.0 + i, 1.0, 2.0, 1.0 + i) for i in range(30) for c in "XY"]
    results = queries.run_all(star_tables(scored(spark, rows)))
    assert [k[:2] for k in results] == ["q1", "q2", "q3", "q4", "q5", "q6"]
    assert results["q6_item_quartiles"].count() == 120


def test_rounding_keeps_what_has_no_digits(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1e16, -1e16, 1.00005, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(round_stable("x", 4).alias("r"))
    got = column(df, "r")
    assert got[0] != got[0] and got[1:] == [float("inf"), float("-inf"), 1e16, -1e16, 1.0001, None]


def test_infinite_amounts_are_missing(spark):
    df = spark.createDataFrame([("Infinity",), ("-inf",), ("NaN",), ("1e400",), ("2.5",)], "t string").select(to_number("t").alias("n"))
    assert column(df, "n") == [None, None, None, None, 2.5]


def test_the_window_score_equals_the_joined_one(spark):
    df = nets(spark, ("A", 10.0), ("A", 25.0), ("A", 31.0), ("B", 7.0), ("C", 5.0), ("C", 5.0))
    joined = df.transform(features.add_zscore, features.peer_stats(df)).select("peer_group", "net", "net_z")
    assert sorted(joined.collect(), key=str) == sorted(features.add_zscore_window(df).collect(), key=str)
