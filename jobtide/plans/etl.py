"""The batch job: raw postings to the jobs and job_skills tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.vocabulary import BULK_VOCABULARY, ETL_VOCABULARY, Vocabulary
from jobtide.operators import normalize as nz
from jobtide.operators.dedup import dedup_latest, newer_than
from jobtide.operators.extract import explode_skills, extract_skills, parse_skill_list, skill_count, skills_passthrough
from jobtide.operators.relations import join_skills_jobs
from jobtide.sources.readers import CORRUPT, read_postings_csv, read_raw_auto, read_skills_csv
from jobtide.sources.sinks import WriteResult, write_job_skills, write_jobs, write_training_data


def etl_jobs(
    raw: DataFrame, vocabulary: Vocabulary = ETL_VOCABULARY, as_of: Column | dt.date | str | None = None,
    versions: bool = False, known: DataFrame | None = None,
) -> DataFrame:
    """Raw postings of either shape (nested or flat) to the jobs table.

    The schema decides the branches once, on the driver; the plan itself is one scan, one shuffle for the newest
    row per job, and a projection. With *versions*, rows without a description stay, and ``ingested_at`` and
    ``row_version`` tell which row of a job is the newest, so that batches can be put together later. With *known* too (the
    versions seen before, a row per job), only newer rows go on, each with the ``earlier`` place of its job; texts of others
    are not searched.
    """
    own = nz.job_id_rowhash(raw)
    df = raw.withColumn("job_id", F.coalesce(F.col("job_id").cast("string"), own) if "job_id" in raw.columns else own)
    if versions:
        df = df.withColumn("row_version", F.xxhash64(*[F.col(c) for c in df.columns]))
    df = dedup_latest(df)
    if known is not None:
        df = newer_than(df, known)
    df = nz.flatten_location(df)
    if "description" in df.columns:
        df = fill_skills(df if versions else nz.filter_has_description(df), vocabulary)
    else:
        df = skills_passthrough(df, "description", vocabulary).withColumn("description", F.lit(None).cast("string"))
    df = nz.flatten_salary(skill_count(df))
    df = df.withColumn("salary_mid_usd", nz.salary_mid_strict(F.col("salary_min_usd"), F.col("salary_max_usd")))
    df = nz.ensure_columns(nz.resolve_posted_date(df, as_of))
    if not versions:
        return nz.project_jobs(df)
    return nz.project_jobs(df, "ingested_at", "row_version", *(["earlier"] if known is not None else []))


def fill_skills(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Delivered skills where a row has them, otherwise those found in its description."""
    if "extracted_skills" not in df.columns:
        return skills_passthrough(df, "description", vocabulary)
    given = df.withColumnRenamed("extracted_skills", "_given").withColumn("_whole", F.col("description"))
    found = extract_skills(given.withColumn("description", F.when(F.col("_given").isNull(), F.col("_whole"))), "description", vocabulary)
    filled = found.withColumns({"extracted_skills": F.coalesce("_given", "extracted_skills"), "description": F.col("_whole")})
    return filled.drop("_given", "_whole")


def etl_job_skills(jobs: DataFrame) -> DataFrame:
    """The junction rows of a jobs table."""
    return explode_skills(jobs)


@dataclass
class EtlResult:
    jobs: WriteResult
    job_skills: WriteResult
    corrupt_lines: int = 0


def run_etl(
    spark: SparkSession, raw_path: str, jobs_path: str, job_skills_path: str,
    vocabulary: Vocabulary = ETL_VOCABULARY, as_of: Column | dt.date | str | None = None,
) -> EtlResult:
    """Read the raw zone and write both tables.

    The junction is exploded from the jobs table just written, so texts are searched once and nothing is cached. Lines
    that do not parse are counted on the way.
    """
    corrupt = Observation("corrupt")
    bad = F.col(CORRUPT).isNotNull()
    raw = read_raw_auto(spark, raw_path).observe(corrupt, F.count(F.when(bad, F.lit(1))).alias("lines"))
    written = write_jobs(etl_jobs(raw.filter(~bad).drop(CORRUPT), vocabulary, as_of), jobs_path)
    skills = write_job_skills(etl_job_skills(spark.read.parquet(jobs_path)), job_skills_path)
    return EtlResult(written, skills, corrupt.get["lines"])


# --- Bulk files ------------------------------------------------------------------------------------------------------


def bulk_jobs(
    postings: DataFrame, ingested_at: Column | None = None, vocabulary: Vocabulary = BULK_VOCABULARY,
    source: str = "bulk", impute_dates: bool = False,
) -> DataFrame:
    """Bulk postings to the bulk jobs table."""
    df = nz.map_columns(postings, nz.POSTING_COLUMNS)
    if "job_id" in df.columns:
        df = df.withColumn("job_id", F.col("job_id").cast("string"))
    else:
        parts = [F.col(c) if c in df.columns else F.lit("") for c in ("title", "company", "location")]
        df = df.withColumn("job_id", nz.job_id_composite(*parts))
    if "posted_date" in df.columns:
        df = df.withColumn("posted_date", nz.coerce_posted_date(F.col("posted_date")))
    else:
        df = df.withColumn("posted_date", F.lit(None).cast("timestamp"))
    if impute_dates:
        df = nz.impute_posted_date(df).withColumn("posted_date", F.col("posted_date").cast("timestamp"))
    df = skills_passthrough(df, "description", vocabulary)
    df = nz.salary_mid_backfill(nz.coerce_numeric(df.withColumn("skill_count", F.size("extracted_skills"))))
    df = df.withColumns(
        {
            "source": F.lit(source),
            "ingested_at": (F.current_timestamp() if ingested_at is None else ingested_at).cast("string"),
            "year": F.year("posted_date"), "month": F.month("posted_date"),
        }
    )
    return nz.project_bulk_jobs(df)


def bulk_skill_rows(skill_table: DataFrame) -> DataFrame | None:
    """(job_id, skill) rows of a skill file in one of its known forms; None when its columns are not recognised."""
    df = nz.map_columns(skill_table, nz.SKILL_COLUMNS)
    multi = next((c for c in nz.MULTI_SKILL_COLUMNS if c in df.columns), None)
    if multi and "job_id" in df.columns:
        df = df.select("job_id", F.explode(parse_skill_list(F.col(multi))).alias("skill"))
    if not {"job_id", "skill"} <= set(df.columns):
        return None
    return nz.clean_skill(df.select(F.col("job_id").cast("string").alias("job_id"), "skill"))


def bulk_job_skills(
    jobs: DataFrame, skill_table: DataFrame | None = None, country: str = "US", impute_dates: bool = False
) -> DataFrame:
    """Junction of the bulk source: from its skill file if usable, otherwise from the extracted skills."""
    rows = None if skill_table is None else bulk_skill_rows(skill_table)
    if rows is not None and not rows.isEmpty():
        return join_skills_jobs(rows, jobs, country, impute_dates)
    return explode_skills(jobs, keep=("job_id", "posted_date", "salary_mid", "year", "month"), country=country)


def run_bulk(
    spark: SparkSession, folder: str, jobs_path: str, job_skills_path: str, training_path: str | None = None,
    ingested_at: Column | None = None, impute_dates: bool = False,
) -> EtlResult:
    """Load bulk CSV files into the bulk tables."""
    written = write_jobs(bulk_jobs(read_postings_csv(spark, folder), ingested_at, impute_dates=impute_dates), jobs_path)
    try:
        skill_table = read_skills_csv(spark, folder)
    except FileNotFoundError:
        skill_table = None
    junction = bulk_job_skills(spark.read.parquet(jobs_path), skill_table, impute_dates=impute_dates)
    skills = write_job_skills(junction, job_skills_path)
    if training_path:
        write_training_data(spark.read.parquet(job_skills_path), training_path)
    return EtlResult(written, skills)
