from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from peerbench.sources.tables import event_lines
from peerbench.streaming import jobs


def same(a, b):
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def stats(spark):
    return jobs.publish_stats(event_lines(spark, SMOKE_DIR))


def test_streams_equal_their_batch_twins(spark, stats, tmp_path):
    batch = event_lines(spark, SMOKE_DIR)
    stream = jobs.event_stream(spark, f"{SMOKE_DIR}/{{events.parquet}}")
    folders = lambda name: (str(tmp_path / name), str(tmp_path / f"{name}-cp"))
    assert same(jobs.run_append(jobs.score(stream, stats), *folders("a")), jobs.score(batch, stats))
    daily = jobs.run_updates(jobs.daily_outliers(jobs.score(stream, stats), "2 days"), "starts", *folders("d"))
    assert same(daily, jobs.daily_outliers(jobs.score(batch, stats)))
    weekly = jobs.run_updates(jobs.weekly_rows(stream, "2 days"), "starts", *folders("w"))
    assert same(weekly, jobs.weekly_rows(batch))
    starts = weekly.select(F.dayofweek("starts").alias("d"), F.hour("starts").alias("h")).distinct().collect()
    assert [(r["d"], r["h"]) for r in starts] == [(2, 8)]


def write_events(spark, folder, name, *days):
    rows = [(i, d, 1, "x", 1.0, "") for i, d in enumerate(days)]
    spark.createDataFrame(rows, jobs.EVENT_SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_events(spark, folder, "a", datetime(2024, 1, 1, 10), datetime(2024, 1, 20, 10))
    stream = jobs.event_stream(spark, f"{folder}/*")
    checkpoint, seen = str(tmp_path / "cp"), []

    def drain():
        query = (
            jobs.weekly_rows(jobs.event_stream(spark, f"{folder}/*"), "2 days").writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: seen.extend(rows.collect()))
            .trigger(availableNow=True).start())
        query.awaitTermination()

    assert stream.isStreaming
    drain()
    first = {r["starts"]: r["row_count"] for r in seen}
    write_events(spark, folder, "b", datetime(2024, 1, 1, 11), datetime(2024, 1, 20, 11))
    seen.clear()
    drain()
    second = {r["starts"]: r["row_count"] for r in seen}
    assert first == {datetime(2024, 1, 1, 8): 1, datetime(2024, 1, 15, 8): 1}
    assert second == {datetime(2024, 1, 15, 8): 2}  # the row of January 1st came too late


def test_a_second_call_reads_only_new_files(spark, stats, tmp_path):
    folder = str(tmp_path / "in")
    out = {n: (str(tmp_path / n), str(tmp_path / f"{n}-cp")) for n in ("scores", "weeks")}
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")

    def call():
        scores = jobs.run_append(jobs.score(jobs.event_stream(spark, f"{folder}/*"), stats), *out["scores"])
        own = jobs.own_session(spark)
        weeks = jobs.run_updates(jobs.weekly_rows(jobs.event_stream(own, f"{folder}/*"), "2 days"), "starts", *out["weeks"])
        return scores.count(), {r["starts"]: r["row_count"] for r in weeks.collect()}

    write_events(spark, folder, "a", datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10))
    assert call() == (2, {datetime(2024, 1, 1, 8): 2})
    write_events(spark, folder, "b", datetime(2024, 1, 3, 10))
    files = {f.name for f in (tmp_path / "scores").glob("*.parquet")}
    assert call() == (3, {datetime(2024, 1, 1, 8): 3})
    new = [str(f) for f in (tmp_path / "scores").glob("*.parquet") if f.name not in files]
    assert spark.read.parquet(*new).count() == 1
    assert call() == (3, {datetime(2024, 1, 1, 8): 3}) and spark.conf.get("spark.sql.shuffle.partitions") == shuffles


def test_late_rows_are_listed(spark, tmp_path):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 20)), (3, datetime(2024, 1, 19))], "event_id long, at timestamp")
    assert [r["event_id"] for r in jobs.late_rows(rows, str(tmp_path / "late")).collect()] == [1]


def test_alert_and_gate(spark):
    daily = spark.createDataFrame([(201,), (200,), (None,)], "outlier_count long")
    assert [r["fires"] for r in jobs.with_daily_alert(daily).collect()] == [1, 0, 0]
    weekly = spark.createDataFrame([(1001,), (1000,)], "row_count long")
    assert [r["status"] for r in jobs.with_weekly_gate(weekly).collect()] == ["OK", "FAIL"]
