"""Streaming jobs run to completion over files."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from jobtide.functions.vocabulary import ETL_TERMS, Vocabulary
from jobtide.plans.registered.postings import NOW, SQL as POSTING_SQL, _raw, flat
from jobtide.session import scratch_path, shuffles_removed
from jobtide.sources.driver_tables import table
from jobtide.sources.sinks import write_ndjson
from jobtide.streaming import ingest, weekly


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _ingest(spark, sf):
    """Every record delivered three times over three micro-batches: twice as it is, and once older with another title.

    The older one of half of the records comes first, and that of the others second.
    """
    raw_path, jobs_path, checkpoint = (scratch_path(spark, n) for n in ("raw", "jobs", "checkpoint"))
    raw = _raw(spark, sf)
    old_first = F.coalesce(F.pmod(F.crc32("url"), F.lit(2)) == 0, F.lit(False))

    def delivered(older):
        return raw.withColumns({
            "title": F.when(older, "outdated").otherwise(F.col("title")),
            "ingested_at": F.when(older, "1970-01-01T00:00:00Z").otherwise(F.col("ingested_at")),
        })

    deliveries = delivered(old_first).unionAll(delivered(~old_first)).unionAll(raw)
    with shuffles_removed(spark):
        write_ndjson(deliveries, raw_path)
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "part-*"))
    stream = ingest.read_raw_stream(spark, raw_path, files_per_batch=max(1, ceil(len(files) / 3)))
    _finish(ingest.stream_ingest(stream, jobs_path, checkpoint, Vocabulary(ETL_TERMS + ("rest",)), NOW))
    return flat(ingest.ingested_jobs(spark, jobs_path))


def _weekly(spark, sf):
    events_path, path, checkpoint = (scratch_path(spark, n) for n in ("events", "weekly", "checkpoint"))
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("skill"), F.col("ts").cast("timestamp").alias("posted_ts")
    )
    events.repartitionByRange(4, "posted_ts").write.parquet(events_path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(events_path)
    _finish(weekly.write_weekly_updates(weekly.stream_weekly_demand(stream, lateness="60 days"), path, checkpoint))
    return weekly.weekly_from_updates(spark, path)


QUERIES = {"stream_ingest": _ingest, "stream_weekly_demand": _weekly}

SQL = {
    "stream_ingest": POSTING_SQL["project_jobs"],
    "stream_weekly_demand": """
SELECT event_type AS skill, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS job_count FROM events GROUP BY 1, 2""",
}
