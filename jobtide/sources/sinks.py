"""Writers and catalog registration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import BULK_JOB_SKILLS, BULK_JOBS, JOB_SKILLS, JOBS, PARTITIONS

#: Rows per output file; keeps files near the usual few hundred megabytes for posting-sized rows.
ROWS_PER_FILE = 2_000_000
#: A compressed file cannot be split, so those of text are smaller.
NDJSON_ROWS_PER_FILE = 250_000


@dataclass
class WriteResult:
    """Where a table went and the row count observed while it was written."""

    path: str
    rows: int


def _write_partitioned(df: DataFrame, path: str, mode: str) -> WriteResult:
    """Partitioned Parquet, clustered by month so that a task writes few files.

    Rebalancing lets adaptive execution merge small months into one task and split a month that holds a large share
    of the rows over many.
    """
    rows = Observation("written")
    (
        df.observe(rows, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", *PARTITIONS)
        .write.mode(mode)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    return WriteResult(path, int(rows.get["rows"]))


def write_jobs(df: DataFrame, path: str, mode: str = "overwrite") -> WriteResult:
    """The jobs table; with ``partitionOverwriteMode=dynamic`` only the months present are replaced."""
    return _write_partitioned(df, path, mode)


def write_job_skills(df: DataFrame, path: str, mode: str = "overwrite") -> WriteResult:
    return _write_partitioned(df, path, mode)


def write_training_data(df: DataFrame, path: str, mode: str = "overwrite") -> WriteResult:
    rows = Observation("training rows")
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return WriteResult(path, int(rows.get["rows"]))


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw-zone form: one JSON record per line, compressed, in files small enough that each is read by one task."""
    df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", NDJSON_ROWS_PER_FILE).json(path)


def row_counts(observed: dict[str, WriteResult], spark: SparkSession) -> DataFrame:
    """Counts gathered while the tables were written; no second pass over the data."""
    rows = [(name, result.rows) for name, result in observed.items()]
    return spark.createDataFrame(rows, "table_name string, row_count long")


def _create_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{location}'"
    )


def register_tables(
    spark: SparkSession, database: str, jobs: str | None = None, job_skills: str | None = None,
    bulk_jobs: str | None = None, bulk_job_skills: str | None = None, database_location: str | None = None,
) -> None:
    """External tables over the given folders, plus the united view ``job_skills_all`` when both junctions are there."""
    where = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, schema, location in (
        ("jobs", JOBS, jobs), ("job_skills", JOB_SKILLS, job_skills),
        ("jobs_bulk", BULK_JOBS, bulk_jobs), ("job_skills_bulk", BULK_JOB_SKILLS, bulk_job_skills),
    ):
        if location:
            _create_table(spark, f"{database}.{name}", schema, location)
    if job_skills and bulk_job_skills:
        columns = JOB_SKILLS.fieldNames()
        bulk = {"posted_date": "CAST(posted_date AS DATE) AS posted_date", "salary_mid_usd": "salary_mid AS salary_mid_usd"}
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.job_skills_all AS SELECT {', '.join(columns)} FROM {database}.job_skills "
            f"UNION ALL SELECT {', '.join(bulk.get(c, c) for c in columns)} FROM {database}.job_skills_bulk"
        )


def repair_partitions(spark: SparkSession, *tables: str) -> None:
    """Let the catalog find the partitions that were written since."""
    for table in tables:
        spark.sql(f"MSCK REPAIR TABLE {table}")
