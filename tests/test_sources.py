from __future__ import annotations

import csv

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from peerbench import session
from peerbench import workspace as workspace_module
from peerbench.operators import clean, features, quality
from peerbench.operators.star import read_star, star_tables, write_star
from peerbench.plans import facts, queries
from peerbench.roles import RAW_COLUMNS, Roles, star_schemas
from peerbench.session import fresh_path, setting, shared_dir
from peerbench.sources import dims
from peerbench.sources.csvs import read_raw_csv, read_result_csv, require_columns, write_csv, write_text
from tests.synthetic import STATE_WEIGHTS, synthesize, synthesize_for


@pytest.fixture(scope="module")
def raw(spark):
    """30,000 synthetic rows through a CSV file."""
    path = fresh_path(spark, "raw")
    write_csv(synthesize(spark, 30_000), path)
    return read_raw_csv(spark, path)


@pytest.fixture(scope="module")
def scored(spark, raw):
    cleaned = clean.clean(Roles().rename(raw)).checkpoint()
    return features.enrich(cleaned, dims.state_regions(spark)).checkpoint()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) in (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir())


def test_raw_csv_is_text_and_keeps_codes(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text(",".join(RAW_COLUMNS) + "\n" + '0012,"O""Neil, Jr",Ann,x/y,CA,LA,01234,00840,desc,5,6,7.5,2.5,70\n')
    row = read_raw_csv(spark, str(file)).first()
    assert row["hcpcs_code"] == "00840" and row["npi"] == "0012" and row["provider_last_name"] == 'O"Neil, Jr'
    assert {t for _, t in read_raw_csv(spark, str(file)).dtypes} == {"string"}


def test_latin1_fallback(spark, tmp_path):
    head = ",".join(RAW_COLUMNS) + "\n"
    tail = ",Ann,x,CA,LA,1,2,d,5,6,7.5,2.5,70\n"
    for encoding in ("utf-8", "latin-1"):
        file = tmp_path / f"{encoding}.csv"
        file.write_bytes((head + "1,Núñez" + tail).encode(encoding))
        assert read_raw_csv(spark, str(file)).first()["provider_last_name"] == "Núñez"


def test_files_of_two_header_orders_and_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("npi,code,name\n00842,3,Núñez\n")
    (tmp_path / "b.csv").write_text("code,npi,name\n4,00843,Ann\n")
    (tmp_path / "c.csv").write_bytes("code,npi,name\n5,00844,Muñoz\n".encode("latin-1"))
    rows = read_raw_csv(spark, str(tmp_path)).orderBy("npi").collect()
    assert [(r["npi"], r["code"], r["name"]) for r in rows] == [("00842", "3", "Núñez"), ("00843", "4", "Ann"), ("00844", "5", "Muñoz")]


def test_bad_rows_are_errors(spark, tmp_path):
    for name, text in (("many", "a,b\n1,2,3\n"), ("few", "a,b\n1\n")):
        file = tmp_path / f"{name}.csv"
        file.write_text(text)
        with pytest.raises(Exception, match="MALFORMED"):
            read_raw_csv(spark, str(file)).collect()
    for other in ("x,y\n1,2\n",):
        (tmp_path / "two").mkdir()
        (tmp_path / "two" / "1.csv").write_text("a,b\n1,2\n")
        (tmp_path / "two" / "2.csv").write_text(other)
        with pytest.raises(AnalysisException):
            read_raw_csv(spark, str(tmp_path / "two"))
    file = tmp_path / "lines.csv"
    file.write_text('a,b\n"one\ntwo",3\n')
    assert read_raw_csv(spark, str(file), multi_line=True).collect() == [("one\ntwo", "3")]
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw_csv(spark, str(file)).collect()
    with pytest.raises(ValueError, match="lacks z"):
        require_columns(read_raw_csv(spark, str(file), multi_line=True), ["a", "z"])


@pytest.mark.parametrize("encoding,ends", [("utf-8", "\n"), ("utf-8", "\r\n"), ("latin-1", "\n")])
def test_quoted_line_breaks_over_many_splits(spark, tmp_path, encoding, ends):
    """Fields with line breaks, quotes and separators, in splits that begin in the middle of them."""
    def field(i, j):
        return ["plain é", f"two\nlines {i}", 'a "quoted" word', "a, b", "", '"\n"', "x" * (i % 90), "\n\n", f"é\n{i}\n{j}"][(i * 7 + j * 3) % 9]

    rows = [[str(i), *[field(i, j) for j in range(3)]] for i in range(400)]
    for name, part in (("a", rows[:300]), ("b", rows[300:]), ("c", [])):
        with open(tmp_path / f"{name}.csv", "w", encoding=encoding, newline="") as file:
            csv.writer(file, lineterminator=ends).writerows([["id", "one", "two", "three"], *part])
    path = str(tmp_path)
    with setting(spark, "spark.sql.files.maxPartitionBytes", 700), setting(spark, "spark.sql.files.openCostInBytes", 1):
        got = read_raw_csv(spark, path, multi_line=True)
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        found = sorted(map(tuple, got.collect()), key=lambda r: int(r[0]))
    assert got.columns == ["id", "one", "two", "three"]
    assert [r for r in found] == [tuple(x or None for x in row) for row in rows]
    want = spark.read.options(header=True, escape='"', multiLine=True, encoding="ISO-8859-1" if encoding == "latin-1" else "UTF-8").csv(path)
    assert found == sorted(map(tuple, want.collect()), key=lambda r: int(r[0]))


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="left open"):
        read_raw_csv(spark, str(tmp_path), multi_line=True)


def test_quality_report_sees_numbers_that_are_not_finite(spark, scored):
    few = scored.limit(20).checkpoint()
    bad = few.unionByName(few.limit(1).withColumn("net_z", F.lit(float("inf")))).unionByName(
        few.limit(1).withColumns({"net_z": F.lit(float("nan")), "net": F.lit(1e16)}))
    report = {r["check_name"]: r for r in quality.quality_report(bad, 1, 1).collect()}
    assert (report["z_not_finite"]["observed"], report["z_not_finite"]["passed"]) == (2.0, 0)
    assert (report["max_net"]["observed"], report["max_net"]["passed"]) == (1e16, 0)


def test_missing_raw_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_raw_csv(spark, str(tmp_path / "none.csv")).count()


def test_missing_result_is_empty(spark, tmp_path):
    schema = star_schemas()["items"]
    assert read_result_csv(spark, str(tmp_path / "none"), schema).isEmpty()
    df = spark.createDataFrame([("1", "00840", " padded ", 2.0)], schema)
    back = read_result_csv(spark, write_csv(df, str(tmp_path / "items")), schema)
    assert back.collect() == df.collect()


def test_narrative_text(spark, tmp_path):
    frame = spark.createDataFrame([("Hello",)], "text string")
    path = write_text(frame, "text", str(tmp_path / "t"), "Title", "2026-01-01 09:00")
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines[0] == "# Title (2026-01-01 09:00)" and lines[-1] == "Hello"


def test_constant_tables(spark):
    assert dims.state_regions(spark).count() == 50 and dims.state_regions(spark).select("region").distinct().count() == 5


def test_synthetic_rows_do_not_depend_on_partitions(spark):
    one = synthesize_for(spark.range(0, 500, 1, 1), 7)
    many = synthesize_for(spark.range(0, 500, 1, 16).repartition(5), 7)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    assert not one.exceptAll(synthesize_for(spark.range(500), 8)).isEmpty()


def test_synthetic_distributions(spark):
    df = synthesize(spark, 30_000)
    assert tuple(df.columns) == RAW_COLUMNS
    r = df.agg(
        F.count_distinct("npi").alias("ids"), F.count_distinct("provider_specialty").alias("peers"),
        F.count_distinct("provider_state").alias("states"), F.count_distinct("hcpcs_code").alias("codes"),
        F.min("total_beneficiaries").alias("vmin"), F.max("total_beneficiaries").alias("vmax"),
        F.median(F.log("total_beneficiaries")).alias("vmed"),
        F.min("avg_medicare_payment").alias("nmin"), F.avg("avg_beneficiary_age").alias("age"),
        F.min("avg_beneficiary_age").alias("amin"), F.max("avg_beneficiary_age").alias("amax"),
        F.min(F.col("avg_submitted_charge") / F.col("avg_medicare_payment")).alias("rmin"),
        F.max(F.col("avg_submitted_charge") / F.col("avg_medicare_payment")).alias("rmax"),
        F.avg((F.col("provider_state") == "CA").cast("int")).alias("ca"),
        F.avg((F.col("total_services") < F.col("total_beneficiaries")).cast("int")).alias("few"),
    ).first()
    assert (r["ids"], r["peers"], r["states"], r["codes"]) == (30_000, 30, 50, 240)
    assert r["vmin"] >= 1 and r["vmax"] <= 5000 and abs(r["vmed"] - 4.5) < 0.05
    assert r["nmin"] >= 10 and abs(r["age"] - 68) < 0.3 and r["amin"] >= 40 and r["amax"] <= 95
    assert 1.79 <= r["rmin"] and r["rmax"] <= 4.51
    assert abs(r["ca"] - 10 / sum(STATE_WEIGHTS.values())) < 0.01
    assert r["few"] < 0.01


def test_invariants_of_a_synthetic_load(spark, scored):
    star = read_star(spark, write_star(star_tables(scored), fresh_path(spark, "star")))
    assert {n: getattr(star, n).count() for n in ("entities", "items", "measures", "segments")} == dict.fromkeys(
        ("entities", "items", "measures", "segments"), 30_000)
    assert star.entities.select("place").distinct().count() >= 45
    assert star.entities.select("peer_group").distinct().count() == 30
    assert star.entities.filter("region = 'Unknown'").isEmpty()
    report = {r["check_name"]: r for r in quality.quality_report(scored, 45, 25).collect()}
    assert all(r["passed"] for r in report.values())
    assert quality.passed(quality.quality_report(scored, 45, 25)).first()["all_passed"] == 1
    flags = quality.outlier_flag_errors(star).first()
    assert (flags["wrongly_flagged"], flags["wrongly_unflagged"]) == (0, 0)
    ratios = quality.ratio_checks(star).first()
    assert (ratios["gross_below_net"], ratios["unit_not_positive"], ratios["low_ratio_share"]) == (0, 0, 0)
    assert [r["orphan_rows"] for r in quality.orphans(star).collect()] == [0, 0, 0]
    assert quality.repeated_ids(star.entities).first()["repeated_ids"] == 0
    assert queries.peer_variation(star).filter("variation_ratio > 0").count() == 30
    assert queries.geographic(star).count() > 1200 and queries.outliers(star).count() == 100
    for sentence, row in (
        (facts.peer_sentence, facts.peer_facts(star)), (facts.geo_sentence, facts.geo_facts(star)),
        (facts.outlier_sentence, facts.outlier_facts(star)), (facts.overall_sentence, facts.overall_facts(star)),
    ):
        assert len(sentence(row).first()["text"]) > 60


def test_quality_findings(spark, scored):
    few = scored.limit(50).checkpoint()
    doubled = few.unionByName(few.limit(3))
    assert quality.duplicates(doubled).first()["duplicate_rows"] == 3
    report = {r["check_name"]: r["passed"] for r in quality.quality_report(doubled, 1, 1).collect()}
    assert report["duplicate_pairs"] == 0 and report["negative_net"] == 1
    assert quality.passed(quality.quality_report(doubled, 1, 1)).first()["all_passed"] == 0
    star = star_tables(few)
    gone = star.entities.orderBy("entity_id").limit(1)
    from dataclasses import replace
    less = replace(star, entities=star.entities.join(gone, "entity_id", "left_anti"))
    assert {r["table_name"]: r["orphan_rows"] for r in quality.orphans(less).collect()} == {
        "items": 1, "measures": 1, "segments": 1}
    assert quality.repeated_ids(star.entities.unionByName(gone)).first()["repeated_ids"] == 1


def test_lines_are_built_in_parts_of_a_bounded_size(spark, monkeypatch):
    keys, rows = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"), []
    before = [spark.conf.get(k) for k in keys]
    with session.sized(spark, 60 * session.TASK_ROWS):
        assert [spark.conf.get(k) for k in keys] == ["60", session.TASK_BYTES]
    assert [spark.conf.get(k) for k in keys] == before
    monkeypatch.setattr(workspace_module, "sized", lambda s, n: rows.append(n) or session.sized(s, n))
    workspace_module.Workspace(spark, SMOKE_DIR).lines
    assert rows == [spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").count()]
