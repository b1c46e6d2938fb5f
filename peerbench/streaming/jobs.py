"""Structured Streaming forms of the refresh and alert jobs over a folder of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from peerbench.functions.numbers import flag
from peerbench.operators.features import add_outlier_flag, add_zscore, peer_stats
from peerbench.sources.tables import with_event_roles

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
DAILY = ("1 day", "1 day", "9 hours")  # windows start at 09:00
WEEKLY = ("7 days", "7 days", "4 days 8 hours")  # windows start on Mondays at 08:00


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Event files as they arrive; ``path`` may be a glob."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_event_roles(reader.parquet(path))


def score(events: DataFrame, stats: DataFrame) -> DataFrame:
    """Events with z-score and outlier flag against published peer statistics (batch or stream)."""
    return events.transform(add_zscore, stats.drop("peer_p75")).transform(add_outlier_flag).select(
        "event_id", "entity_id", "peer_group", "at", "net", "net_z", "is_outlier")


def publish_stats(events: DataFrame) -> DataFrame:
    """Peer statistics of a batch of events as a stored table that streams join with."""
    return peer_stats(events)


def daily_outliers(scored: DataFrame, late: str | None = None) -> DataFrame:
    """Rows and outliers per day from 09:00 to 09:00; ``late`` sets the watermark of a stream."""
    rows = scored.withWatermark("at", late) if late else scored
    return (
        rows.groupBy(F.window("at", *DAILY).alias("w"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("is_outlier").alias("outlier_count"))
        .select(F.col("w.start").alias("starts"), "row_count", "outlier_count")
    )


def weekly_rows(events: DataFrame, late: str | None = None) -> DataFrame:
    """Rows per week from Monday 08:00."""
    rows = events.withWatermark("at", late) if late else events
    return (
        rows.groupBy(F.window("at", *WEEKLY).alias("w")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.col("w.start").alias("starts"), "row_count")
    )


def with_daily_alert(daily: DataFrame, threshold: int = 200) -> DataFrame:
    """Whether the outliers of a day exceed the threshold."""
    return daily.withColumn("fires", flag(F.col("outlier_count") > threshold))


def with_weekly_gate(weekly: DataFrame, more_than: int = 1000) -> DataFrame:
    """Whether a week brought enough rows."""
    return weekly.withColumn("status", F.when(F.col("row_count") > more_than, "OK").otherwise("FAIL"))


def drain(writer: DataStreamWriter) -> None:
    """Process everything that is there now, then stop; errors of the query are raised here."""
    writer.trigger(availableNow=True).start().awaitTermination()


def run_append(stream: DataFrame, output: str, checkpoint: str) -> DataFrame:
    """Process what a stateless stream has not read yet into Parquet files and return all of them.

    ``checkpoint`` holds what was read: a later call with the same folders takes up from there.
    """
    drain(stream.writeStream.format("parquet").option("path", output)
           .option("checkpointLocation", checkpoint).outputMode("append"))
    return stream.sparkSession.read.schema(stream.schema).parquet(output)


def late_rows(events: DataFrame, output: str, late: str = "2 days") -> DataFrame:
    """The rows that a watermark of ``late`` would drop, for a table beside the windows: older than the newest row less ``late``.

    Read over what was stored, since a stream does not hand out the rows that it drops.
    """
    newest = events.agg(F.max("at")).scalar()
    behind = events.filter(F.col("at") < newest - F.expr(f"interval {late}"))
    behind.write.mode("overwrite").parquet(output)
    return events.sparkSession.read.schema(events.schema).parquet(output)


def own_session(spark: SparkSession, state_partitions: int = 8) -> SparkSession:
    """A session of the same application for a stateful stream: few state partitions, without changing the caller's."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", state_partitions)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def run_updates(stream: DataFrame, key: str, output: str, checkpoint: str) -> DataFrame:
    """Process what a windowed aggregate has not read yet, open windows included, and return the last state of every key.

    Build ``stream`` on :func:`own_session`: the state is one row per window, so a few partitions hold it however
    many rows are counted. ``checkpoint`` holds state and progress for the next call.

    Every trigger writes the rows it changed below its own batch number: a batch that is run again
    after a failure replaces its files, and the reader keeps the row of the latest batch.
    """
    spark = stream.sparkSession
    schema = T.StructType(stream.schema.fields + [T.StructField("batch", T.LongType())])

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    drain(stream.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint))
    values = [c for c in stream.columns if c != key]
    return (
        spark.read.schema(schema).parquet(output)
        .groupBy(key).agg(F.max_by(F.struct(*values), "batch").alias("last")).select(key, "last.*")
    )
