"""Scoring against published versions of the statistics, and daily alerts that fire once.

Both are micro-batches that write below their own number. What a batch decides depends on the batches with lower numbers
alone, so one that runs again after a failure replaces its files with the same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.operators.features import peer_stats
from peerbench.streaming.jobs import DAILY, drain, score


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of batches; one that has not been written yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_VERSIONS = "version long"
_STATS = "peer_group string, peer_mean double, peer_sd double, peer_p75 double"


def publish_version(stats: DataFrame, path: str) -> int:
    """Write statistics as the next version below ``path`` and then name it; one publisher at a time."""
    spark = stats.sparkSession
    version = (latest_version(spark, path) or 0) + 1
    stats.write.mode("overwrite").parquet(f"{path}/stats/{version}")
    spark.createDataFrame([(version,)], _VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the version that was named last."""
    return _read(spark, f"{path}/versions", _VERSIONS).agg(F.max("version")).first()[0]


def _chosen(spark: SparkSession, stats_path: str, output: str, batch: int) -> int:
    """The version that a batch scores with: the latest when it first runs, the same when it runs again."""
    note = f"{output}/chosen/batch={batch}"
    known = _read(spark, note, _VERSIONS).first()
    if known is not None:
        return known["version"]
    version = latest_version(spark, stats_path)
    if version is None:
        raise ValueError(f"no statistics have been published in {stats_path}")
    spark.createDataFrame([(version,)], _VERSIONS).coalesce(1).write.mode("overwrite").parquet(note)
    return version


def _scored(rows: DataFrame, stats_path: str, output: str, batch: int) -> DataFrame:
    spark = rows.sparkSession
    version = _chosen(spark, stats_path, output, batch)
    stats = spark.read.schema(_STATS).parquet(f"{stats_path}/stats/{version}")
    return score(rows, stats).withColumn("version", F.lit(version).cast("long"))


_SCORES = "event_id long, entity_id long, peer_group string, at timestamp, net double, net_z double, is_outlier int, version long"


def run_scores(events: DataFrame, stats_path: str, output: str, checkpoint: str) -> DataFrame:
    """Score what has not been read yet, each micro-batch with the statistics published last; returns all scores.

    ``version`` says which statistics a row was scored with.
    """
    def store(rows: DataFrame, batch: int) -> None:
        _scored(rows, stats_path, output, batch).write.mode("overwrite").parquet(f"{output}/scores/batch={batch}")

    drain(events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))
    return _read(events.sparkSession, f"{output}/scores", _SCORES + ", batch int").drop("batch")


_WINDOWS = "starts timestamp, row_count long, outlier_count long, fires int, batch int"
_SEEN = "event_id long, at timestamp, batch int"
_LATE = _SCORES + ", batch int"
_HORIZON = "newest timestamp, batch int"


def run_daily(
    events: DataFrame, stats_path: str, output: str, checkpoint: str, late: str = "2 days", threshold: int = 200,
) -> dict[str, DataFrame]:
    """Count rows and outliers per day from 09:00, with ``windows``, ``alerts`` and ``late`` as results.

    An alert is written in the batch in which the outliers of a day first exceed ``threshold``, once. A row that is older
    than the newest row of the batches before it less ``late`` is not counted but goes to ``late``; its day stays as it is. A
    row whose event_id has been counted since then counts once, so a file that comes again changes nothing.
    """
    spark = events.sparkSession

    def before(table: str, schema: str, batch: int) -> DataFrame:
        return _read(spark, f"{output}/{table}", schema).where(F.col("batch") < batch)

    def store(rows: DataFrame, batch: int) -> None:
        def write(frame: DataFrame, table: str) -> DataFrame:
            frame.drop("batch").write.mode("overwrite").parquet(f"{output}/{table}/batch={batch}")
            return spark.read.schema(frame.drop("batch").schema).parquet(f"{output}/{table}/batch={batch}")

        scored = write(_scored(rows, stats_path, output, batch), "scores")
        newest = before("horizon", _HORIZON, batch).agg(F.max("newest")).first()[0]
        limit = F.lit(newest) - F.expr(f"interval {late}")
        behind = F.coalesce(F.col("at") < limit, F.lit(False)) if newest is not None else F.lit(False)
        counted = before("seen", _SEEN, batch)
        if newest is not None:
            counted = counted.where(F.col("at") >= limit)
        write(scored.where(behind), "late")
        fresh = scored.where(~behind).dropDuplicates(["event_id"]).join(counted.select("event_id"), "event_id", "left_anti")
        fresh = write(fresh.select("event_id", "at", "is_outlier"), "fresh")
        write(fresh.select("event_id", "at"), "seen")
        own = fresh.groupBy(F.window("at", *DAILY)["start"].alias("starts")).agg(
            F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("is_outlier"), F.lit(0)).alias("outlier_count"))
        last = _latest(before("windows", _WINDOWS, batch))
        both = last.unionByName(own.withColumn("fires", F.lit(0))).groupBy("starts").agg(
            F.sum("row_count").alias("row_count"), F.sum("outlier_count").alias("outlier_count"), F.max("fires").alias("fired"))
        changed = both.join(own.select("starts"), "starts", "left_semi").withColumn(
            "fires", (F.col("outlier_count") > threshold).cast("int"))
        changed = write(changed.select("starts", "row_count", "outlier_count", "fires", "fired"), "changes")
        write(changed.where("fires = 1 and fired = 0").drop("fired"), "alerts")
        write(changed.drop("fired"), "windows")
        write(scored.agg(F.max("at").alias("newest")), "horizon")

    drain(events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))
    return {
        "windows": _latest(_read(spark, f"{output}/windows", _WINDOWS)),
        "alerts": _read(spark, f"{output}/alerts", _WINDOWS),
        "late": _read(spark, f"{output}/late", _LATE),
    }


def _latest(windows: DataFrame) -> DataFrame:
    """The last state of every window."""
    kept = F.struct("row_count", "outlier_count", "fires")
    return windows.groupBy("starts").agg(F.max_by(kept, "batch").alias("last")).select("starts", "last.*")


def publish(events: DataFrame, path: str) -> int:
    """Publish the peer statistics of a batch of events."""
    return publish_version(peer_stats(events).select("peer_group", "peer_mean", "peer_sd", "peer_p75"), path)
