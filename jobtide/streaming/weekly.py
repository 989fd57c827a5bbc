"""Weekly demand as a running aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


#: Windows count from 1970-01-01, a Thursday; four days later is a Monday.
MONDAY = "4 days"


#: Fixed value: postings are delivered for up to a week.
LATENESS = "7 days"
BATCH = "batch_id"


def stream_weekly_demand(stream: DataFrame, time: str = "posted_ts", skill: str = "skill", lateness: str = LATENESS) -> DataFrame:
    """Rows per skill and Monday week; weeks older than the lateness are final and leave the state."""
    counted = (
        stream.withWatermark(time, lateness)
        .groupBy(F.window(time, "7 days", startTime=MONDAY).alias("_week"), F.col(skill).alias("skill"))
        .agg(F.count(F.lit(1)).alias("job_count"))
    )
    return counted.select("skill", F.col("_week.start").cast("date").alias("week"), "job_count")


def write_weekly_updates(weekly: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the changed rows of each micro-batch below its own folder; a retry overwrites the folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = weekly.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def weekly_from_updates(spark: SparkSession, path: str) -> DataFrame:
    """Newest count per skill and week over all updates."""
    updates = spark.read.option("basePath", path).parquet(path)
    return updates.groupBy("skill", "week").agg(F.max_by("job_count", BATCH).alias("job_count"))
