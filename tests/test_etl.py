"""A raw file all the way to results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from peerbench.operators import quality
from peerbench.plans import etl, profiles
from peerbench.roles import RAW_COLUMNS
from peerbench.sources.csvs import read_raw_csv, write_csv
from tests.synthetic import synthesize


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("etl"))


@pytest.fixture(scope="module")
def loaded(spark, folder):
    """3,000 rows with the columns in another order, one column missing and some rows damaged."""
    raw = synthesize(spark, 3000).drop("avg_beneficiary_age")
    n = F.col("npi").cast("long") % 100
    raw = raw.withColumns({
        "avg_medicare_payment": F.when(n == 1, "NA").when(n == 2, "-3").otherwise(F.col("avg_medicare_payment").cast("string")),
        "provider_specialty": F.upper("provider_specialty"),
        "provider_state": F.when(n == 3, "ZZ").otherwise(F.col("provider_state")),
    }).select(*sorted(c for c in RAW_COLUMNS if c != "avg_beneficiary_age"))
    write_csv(raw, f"{folder}/raw")
    return etl.load_raw(spark, f"{folder}/raw", f"{folder}/star")


def test_load(spark, folder, loaded):
    star, report = loaded
    assert read_raw_csv(spark, f"{folder}/raw").count() == 3000
    assert {r["row_count"] for r in profiles.health(star).collect()} == {2940}
    assert star.entities.filter("region = 'Unknown'").count() == 30
    assert star.entities.filter("peer_group = 'Allergy/Immunology'").count() > 0
    assert quality.passed(report).first()["all_passed"] == 1


def test_load_again_replaces_the_tables(spark, folder, loaded):
    write_csv(synthesize(spark, 300), f"{folder}/first")
    for source, rows in (("first", 300), ("raw", 2940)):
        star, _ = etl.load_raw(spark, f"{folder}/{source}", f"{folder}/again", strict=True)
        assert star.entities.count() == rows


def test_failed_checks_block_a_strict_load_only(spark, folder):
    raw = synthesize(spark, 300)
    write_csv(raw.unionByName(raw.limit(5)), f"{folder}/double")
    star, report = etl.load_raw(spark, f"{folder}/double", f"{folder}/double-star")
    assert quality.passed(report).first()["all_passed"] == 0 and star.measures.count() == 305
    write_csv(raw.drop("hcpcs_code"), f"{folder}/short")
    with pytest.raises(ValueError, match="hcpcs_code"):
        etl.load_raw(spark, f"{folder}/short", f"{folder}/short-star")
    with pytest.raises(etl.QualityError):
        etl.load_raw(spark, f"{folder}/double", f"{folder}/double-strict", strict=True)


def test_saved_results(spark, folder, loaded):
    star, _ = loaded
    paths = etl.save_results(star, f"{folder}/results")
    assert len(paths) == 6
    for path in paths:
        assert not spark.read.option("header", True).csv(path).isEmpty()
    texts = etl.save_narrative(star, f"{folder}/narrative", "2026-01-01 09:00")
    assert all("(2026-01-01 09:00)" in spark.read.text(p).first()["value"] for p in texts)


def test_segments_are_stored_at_a_new_place(spark, folder, loaded):
    star, _ = loaded
    named, updated = etl.segment(star, f"{folder}/segments")
    assert updated.segments.filter("cluster_id is null").isEmpty() and updated.segments.count() == 2940
    assert star.segments.filter("cluster_id is not null").isEmpty()
    summary = spark.read.option("header", True).csv(etl.save_cluster_summary(named, f"{folder}/summary"))
    assert 2 <= summary.count() <= 8
    assert quality.cluster_coverage(updated.segments).first()["coverage"] == 1
