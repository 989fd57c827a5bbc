"""Incremental ingestion of the raw zone."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobtide.functions.vocabulary import ETL_VOCABULARY, Vocabulary
from jobtide.operators import normalize as nz
from jobtide.operators.extract import explode_skills
from jobtide.plans.etl import etl_jobs
from jobtide.schema import JOBS, PARTITIONS, RAW_POSTING
from jobtide.session import shuffles_removed

#: Fixed value: the folder name of rows without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"
VERSION, MANIFESTS, INCOMING, SEEN = "v", "_manifests", "_incoming", "_seen"
#: Fixed value: one batch in so many writes the versions of all jobs, the others those of their own rows.
WHOLE_EVERY = 10
_VERSIONS = ("job_id", "ingested_at", "row_version", "place")
_SEEN = "job_id string, ingested_at string, row_version long, place string, batch long"


def read_raw_stream(
    spark: SparkSession, path: str, schema: T.StructType = RAW_POSTING, files_per_batch: int | None = None
) -> DataFrame:
    """New NDJSON files of the raw zone as a stream."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def read_manifest(spark: SparkSession, jobs_path: str, before: int | None = None) -> dict[str, int]:
    """Month folder to the version that holds it, from the newest manifest (of a batch *before* the given one)."""
    fs, folder = _files(spark, f"{jobs_path}/{MANIFESTS}")
    if not fs.exists(folder):
        return {}
    batches = [int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
    batches = [b for b in batches if before is None or b < before]
    if not batches:
        return {}
    lines = spark.read.text(f"{jobs_path}/{MANIFESTS}/{max(batches)}").collect()  # one line
    return json.loads(lines[0]["value"])


def _write_manifest(spark: SparkSession, jobs_path: str, batch: int, months: dict[str, int]) -> None:
    """Put a manifest in place by a rename, so that readers see the one before or all of this one."""
    fs, temporary = _files(spark, f"{jobs_path}/{MANIFESTS}/.{batch}")
    _, final = _files(spark, f"{jobs_path}/{MANIFESTS}/{batch}")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(months, sort_keys=True).encode()))
    out.close()
    if fs.exists(final):  # left by a run of the same batch that did not end
        fs.delete(final, False)
    if not fs.rename(temporary, final):
        raise OSError(f"no manifest for batch {batch} in {jobs_path}")


def _months(spark: SparkSession, jobs_path: str, months: dict[str, int]) -> DataFrame:
    """The rows of some month folders."""
    if not months:
        return spark.createDataFrame([], JOBS)
    paths = [f"{jobs_path}/{VERSION}={version}/{place}" for place, version in sorted(months.items())]
    rows = spark.read.option("basePath", jobs_path).schema(T.StructType([*JOBS.fields, T.StructField(VERSION, T.LongType())])).parquet(*paths)
    return rows.select(*JOBS.fieldNames())


def seen_versions(spark: SparkSession, jobs_path: str, before: int) -> DataFrame:
    """(job_id, ingested_at, row_version, place, batch): the newest version of each job that the batches *before* one brought.

    What a batch lets through is newer than all before it, so a job's newest version is that of its last batch.
    """
    batches = [b for b in _seen_batches(spark, jobs_path) if b < before]
    if not batches:
        if read_manifest(spark, jobs_path, before):
            raise ValueError(f"{jobs_path} has jobs, but no versions of them: it was written by other means, ingest it anew")
        return spark.createDataFrame([], _SEEN)
    whole = max([b for b in batches if _is_whole(b)], default=batches[0])
    rows = spark.read.schema(_SEEN).parquet(*[f"{jobs_path}/{SEEN}/{b}" for b in batches if b >= whole])
    return rows if whole == batches[-1] else _last_batch(rows)


def _seen_batches(spark: SparkSession, jobs_path: str) -> list[int]:
    fs, folder = _files(spark, f"{jobs_path}/{SEEN}")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _is_whole(batch: int) -> bool:
    return batch % WHOLE_EVERY == WHOLE_EVERY - 1


def _last_batch(rows: DataFrame) -> DataFrame:
    row = F.max_by(F.struct(*_VERSIONS[1:], "batch"), "batch").alias("r")
    return rows.groupBy("job_id").agg(row).select("job_id", "r.*")


def _write_seen(spark: SparkSession, jobs_path: str, batch: int, rows: DataFrame) -> None:
    """The versions of a batch's rows, now and then with those of all jobs, so that a batch reads a bounded number of folders."""
    seen = rows.select(*_VERSIONS, F.lit(batch).cast("long").alias("batch"))
    if _is_whole(batch):
        seen = _last_batch(seen_versions(spark, jobs_path, batch).unionByName(seen))
    seen.write.mode("overwrite").option("compression", "zstd").parquet(f"{jobs_path}/{SEEN}/{batch}")


def newer_rows(batch: DataFrame, seen: DataFrame, vocabulary: Vocabulary, as_of: Column | dt.date | str | None) -> DataFrame:
    """The newest row of each job in a batch, if it is newer than what was seen before, as :func:`merge_batch` takes it."""
    rows = etl_jobs(batch, vocabulary, as_of, versions=True, known=seen)
    folder = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(UNDATED))) for c in PARTITIONS]
    place, payload = F.concat_ws("/", *folder).alias("place"), F.struct(*JOBS.fieldNames()).alias("payload")
    return rows.select("job_id", F.col("ingested_at").cast("string").alias("ingested_at"), "row_version", place, "earlier", payload)


def merge_batch(spark: SparkSession, jobs_path: str, batch_id: int, newer: DataFrame) -> None:
    """Put the newest versions of some jobs in the place of their earlier ones.

    Months that gain or lose a row are written anew, without the earlier versions, into a folder of this batch; then a new
    manifest names it for these months. A batch that is run again starts from the manifest before it and overwrites its own
    folder, so nothing is lost or doubled; readers go on with the folders of the manifest they have read.

    *newer* holds job_id, the place (month folder) of the row, the earlier place of its job, and the row itself as payload, a
    struct or its JSON. Versions (ingested_at, row_version), if there are, are kept for the batches that follow.
    """
    incoming = f"{jobs_path}/{INCOMING}/{batch_id}"
    newer.write.mode("overwrite").option("compression", "zstd").parquet(incoming)  # the plan of the batch runs once
    rows = spark.read.schema(newer.schema).parquet(incoming)
    if set(_VERSIONS) <= set(newer.columns):
        _write_seen(spark, jobs_path, batch_id, rows)
    payload = F.from_json("payload", JOBS) if dict(newer.dtypes)["payload"] == "string" else F.col("payload")
    jobs = nz.filter_has_description(rows.select(payload.alias("r")).select("r.*"))
    places = rows.select(F.explode(F.array("place", "earlier")).alias("place")).where("place IS NOT NULL").distinct()
    touched = {r["place"] for r in places.collect()}  # months
    months = read_manifest(spark, jobs_path, before=batch_id)
    kept = _months(spark, jobs_path, {p: v for p, v in months.items() if p in touched}).join(rows.select("job_id"), "job_id", "left_anti")
    target = f"{jobs_path}/{VERSION}={batch_id}"
    merged = kept.select(*JOBS.fieldNames()).unionByName(jobs)
    merged.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(*PARTITIONS).parquet(target)
    months = {p: v for p, v in months.items() if p not in touched}
    fs, folder = _files(spark, target)
    for year in fs.listStatus(folder):
        if year.isDirectory():
            months |= {f"{year.getPath().getName()}/{m.getPath().getName()}": batch_id for m in fs.listStatus(year.getPath()) if m.isDirectory()}
    _write_manifest(spark, jobs_path, batch_id, months)
    fs, path = _files(spark, incoming)
    fs.delete(path, True)


def stream_ingest(
    stream: DataFrame, jobs_path: str, checkpoint: str, vocabulary: Vocabulary = ETL_VOCABULARY,
    as_of: Column | dt.date | str | None = None, once: bool = True,
) -> StreamingQuery:
    """Keep the jobs table up to date: one row per job, the newest by ``ingested_at``, however late rows arrive.

    A table beside the jobs holds time and version of each job's newest row and the month it stands in. Each micro-batch
    is joined with it (:func:`newer_rows`), so rows that are not newer go no further, and a row that moves to another month is
    found; the rest is merged into the months it touches (:func:`merge_batch`). The result equals the batch job over the
    same files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with shuffles_removed(spark):
            seen = seen_versions(spark, jobs_path, batch_id)
            merge_batch(spark, jobs_path, batch_id, newer_rows(batch, seen, vocabulary, as_of))

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def remove_old_versions(spark: SparkSession, jobs_path: str, keep: int = 2) -> list[int]:
    """Remove the folders that none of the last *keep* manifests names, all manifests before them, and versions no batch reads."""
    fs, folder = _files(spark, f"{jobs_path}/{MANIFESTS}")
    batches = sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
    kept = batches[-keep:]
    used = {version for batch in kept for version in read_manifest(spark, jobs_path, before=batch + 1).values()}
    gone = []
    for status in fs.listStatus(_files(spark, jobs_path)[1]):
        name = status.getPath().getName()
        if name.startswith(f"{VERSION}=") and int(name[2:]) not in used and int(name[2:]) <= max(kept, default=-1):
            fs.delete(status.getPath(), True)
            gone.append(int(name[2:]))
    for batch in batches[:-keep]:
        fs.delete(_files(spark, f"{jobs_path}/{MANIFESTS}/{batch}")[1], False)
    seen = _seen_batches(spark, jobs_path)
    whole = max([b for b in seen if _is_whole(b) and b < min(kept, default=-1)], default=-1)
    for batch in seen:
        if batch < whole:
            fs.delete(_files(spark, f"{jobs_path}/{SEEN}/{batch}")[1], True)
    return sorted(gone)


def ingested_jobs(spark: SparkSession, jobs_path: str) -> DataFrame:
    """The jobs table as of the last merged batch: one version per job is all that is stored in what is read."""
    return _months(spark, jobs_path, read_manifest(spark, jobs_path))


def ingested_job_skills(spark: SparkSession, jobs_path: str) -> DataFrame:
    return explode_skills(ingested_jobs(spark, jobs_path))
