from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerbench.operators import ranks
from peerbench.operators.ranks import exact_ntile, exact_quantiles, histogram, merge_histograms, ntile_cuts, order_statistics

FRACTIONS = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q1": 1.0}


def _skewed(spark):
    """One group holds most rows, one value most rows of it, and one group is a single row."""
    return spark.range(6000).select(
        F.when(F.col("id") < 4500, "hot").when(F.col("id") < 5999, "cold").otherwise("lone").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") * 7919 % 4001) / 10.0).alias("v"),
        F.md5(F.col("id").cast("string")).alias("tie"),
    )


@pytest.fixture(params=[10_000, 20], ids=["few", "refined"])
def few(request, monkeypatch):
    """How many rows may be ordered in one place; with 20 the bins of these small tables are refined."""
    monkeypatch.setattr(ranks, "FEW", request.param)
    monkeypatch.setattr(ranks, "PARTS", 4_096 if request.param > 20 else 3)


def test_quantiles_equal_numpy(spark, few):
    rows = _skewed(spark)
    got = {r["g"]: r for r in exact_quantiles(
        rows, ["g"], "v", FRACTIONS, extras=[F.avg("v").alias("m")]).collect()}
    data = rows.toPandas()
    assert set(got) == {"hot", "cold", "lone"}
    for g, part in data.groupby("g"):
        for name, p in FRACTIONS.items():
            assert got[g][name] == pytest.approx(np.quantile(part["v"], p), abs=1e-9)
        assert got[g]["m"] == pytest.approx(part["v"].mean())


def test_quantiles_of_the_whole_table(spark, few):
    rows = _skewed(spark)
    got = exact_quantiles(rows, [], "v", FRACTIONS,
                          extras=[F.count("v").alias("n")]).first()
    values = rows.toPandas()["v"]
    assert got["n"] == 6000
    for name, p in FRACTIONS.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_of_nulls_are_null(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 3.0), (None, 4.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in exact_quantiles(rows, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {"a": None, "b": 3.0}


def test_ntile_equals_the_window(spark, few):
    rows = _skewed(spark)
    got = exact_ntile(rows, "g", "v", "tie", 4, "tile")
    want = rows.selectExpr("*", "ntile(4) over (partition by g order by v, tie) as tile")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.count() == 6000


@pytest.mark.parametrize("nulls", [1_000, 30_000])
def test_ntile_of_null_groups_and_large_groups(spark, nulls):
    rows = spark.range(60_000).select(
        F.when(F.col("id") >= nulls, F.when(F.col("id") % 500 == 1, "few").otherwise("hot")).alias("g"),
        (F.col("id") * 7919 % 30011).cast("double").alias("v"), F.md5(F.col("id").cast("string")).alias("tie"))
    got = exact_ntile(rows, "g", "v", "tie", 4, "tile")
    want = rows.selectExpr("*", "ntile(4) over (partition by g order by v, tie) as tile")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_task_orders_a_large_bin(spark):
    rows = spark.range(100_000).select((1e6 + F.col("id") * 7919 % 100_003 / 1e5).alias("v"))  # one bin
    assert histogram(rows, [], "v").count() == 1
    got = exact_quantiles(rows, [], "v", FRACTIONS)
    values = rows.toPandas()["v"]
    assert got.first().asDict() == {name: pytest.approx(np.quantile(values, p), abs=1e-9) for name, p in FRACTIONS.items()}


def test_bins_rise_with_the_value(spark):
    values = [-np.inf, -1.7e308, -3.0, -1.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.5, 1.0, 1.0000001, 3.0, 1e17, 1.7e308, np.inf, np.nan]
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    bins = [r["b"] for r in frame.select("i", ranks.bin_of("v").alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins) and bins[0] < bins[1] < 0 < bins[7] and bins[6] == 0


def test_odd_values(spark, few):
    values = [-2.5, -2.5, 0.0, -0.0, 1e-310, 7.0, 1e300, 1e300, 1e300] * 7 + [None] * 3
    frame = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = exact_quantiles(frame, ["g"], "v", FRACTIONS).first()
    for name, p in FRACTIONS.items():
        assert got[name] == pytest.approx(np.quantile([v for v in values if v is not None], p), rel=1e-12)


def test_ranks_and_ties(spark, few):
    rows = _skewed(spark)
    got = {r["g"]: r for r in order_statistics(rows, ["g"], "v", {"mid": "floor(_n / 2)", "beyond": "_n"}).collect()}
    for g, part in rows.toPandas().groupby("g"):
        ordered = np.sort(part["v"])
        value = ordered[len(ordered) // 2]
        assert got[g]["_n"] == len(ordered) and got[g]["beyond"] is None
        assert (got[g]["mid"], got[g]["mid_skip"], got[g]["mid_ties"]) == (value, len(ordered) // 2 - (ordered < value).sum(), (ordered == value).sum())


def test_histograms_of_parts_add_up(spark):
    rows = _skewed(spark)
    parts = histogram(rows.filter("tie < '8'"), ["g"], "v").union(histogram(rows.filter("tie >= '8'"), ["g"], "v"))
    merged, whole = merge_histograms(parts, ["g"]), histogram(rows, ["g"], "v")
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    got = exact_quantiles(rows, ["g"], "v", FRACTIONS, counts=merged)
    want = exact_quantiles(rows, ["g"], "v", FRACTIONS)
    assert got.exceptAll(want).isEmpty()


def test_weights_stand_for_repeated_rows(spark, few):
    rows = _skewed(spark).withColumn("w", F.ascii("tie") % 4)
    repeated = rows.select("g", "v", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("i")).where("i <= w and w > 0")
    got = ntile_cuts(rows.where("w > 0"), "g", "v", 4, weight="w")
    want = ntile_cuts(repeated, "g", "v", 4)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() == 9


def test_few_shuffles(spark):
    rows = _skewed(spark)
    plan = exact_quantiles(rows, ["g"], "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1  # and one for the bins and one for their sums before
