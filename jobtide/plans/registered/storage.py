"""Readers, writers, catalog and the batch job, each through files in the scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.vocabulary import ETL_TERMS, Vocabulary
from jobtide.plans import etl, views
from jobtide.plans.registered.common import JOB_SKILLS_SQL, r, rounded
from jobtide.plans.registered.postings import (
    _JOBS, JOBS_SQL, NOW, PAYLOAD_SQL, SQL as POSTING_SQL, _flat_record, _jobs, _raw, flat,
)
from jobtide.plans.registered.demand import SQL as DEMAND_SQL
from jobtide.session import scratch_path
from jobtide.sources import readers, sinks
from jobtide.sources.driver_tables import job_skill_sets, job_skills, table

_VOCABULARY = Vocabulary(ETL_TERMS + ("rest",))


def _write_jobs(spark, sf):
    path = scratch_path(spark, "jobs")
    sinks.write_jobs(_jobs(spark, sf), path)
    return flat(spark.read.parquet(path))


def _write_job_skills(spark, sf):
    path = scratch_path(spark, "job_skills")
    sinks.write_job_skills(job_skills(spark, sf), path)
    return rounded(spark.read.parquet(path))


def _write_training(spark, sf):
    path = scratch_path(spark, "training")
    sinks.write_training_data(job_skills(spark, sf), path)
    return rounded(spark.read.parquet(path))


def _counts(spark, sf):
    jobs = sinks.write_jobs(_jobs(spark, sf), scratch_path(spark, "jobs"))
    skills = sinks.write_job_skills(job_skills(spark, sf), scratch_path(spark, "job_skills"))
    return sinks.row_counts({"jobs": jobs, "job_skills": skills}, spark)


def _ndjson(spark, sf):
    path = scratch_path(spark, "raw")
    sinks.write_ndjson(_raw(spark, sf), path)
    read = readers.read_ndjson(spark, path)
    return flat(read.drop("_corrupt_record"))


def _raw_auto(spark, sf):
    """A raw zone in two layouts: Parquet by day beside JSON by year."""
    path = scratch_path(spark, "raw")
    raw = _raw(spark, sf)
    predicted = F.col("salary.is_predicted")
    raw.filter(predicted).write.parquet(f"{path}/date=2001-12-31")
    raw.filter(~predicted).write.json(f"{path}/year=2001")
    read = readers.read_raw_auto(spark, path)
    return read.select("job_id", "title", F.col("salary.is_predicted").alias("is_predicted"), F.col("date").cast("string").alias("date"), "year")


def _postings_csv(spark, sf):
    path = scratch_path(spark, "bulk")
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("job_link"), F.col("text").alias("description"))
    documents.write.options(header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
        f"{path}/postings.csv"
    )
    read = readers.read_postings_csv(spark, path)
    return read.select("job_link", F.md5("description").alias("digest"))


def _skills_csv(spark, sf):
    path = scratch_path(spark, "bulk")
    sets = job_skill_sets(spark, sf).select(F.col("job_id").alias("job_link"), F.array_join("skills", ", ").alias("job_skills"))
    sets.write.options(header=True, escape='"').csv(f"{path}/job_skills.csv")
    return etl.bulk_skill_rows(readers.read_skills_csv(spark, path))


def _parquet_multi(spark, sf):
    one, two = scratch_path(spark, "part"), scratch_path(spark, "part")
    js = job_skills(spark, sf)
    js.filter(F.col("year") < 1998).write.parquet(one)
    js.filter(F.col("year") >= 1998).drop("month").write.parquet(two)
    return rounded(readers.read_parquet_multi(spark, [one, f"{one}-missing", two]))


def _training_table(spark, sf):
    path = scratch_path(spark, "training")
    js = job_skills(spark, sf)
    js.write.parquet(f"{path}.parquet")
    js.write.option("header", True).csv(f"{path}.csv")
    schema = T.StructType(js.schema.fields)
    as_parquet = readers.read_training_table(spark, f"{path}.parquet").withColumn("source", F.lit("parquet"))
    as_csv = readers.read_training_table(spark, f"{path}.csv", schema).withColumn("source", F.lit("csv"))
    return rounded(as_parquet.unionByName(as_csv))


def _registered_tables(spark, sf):
    """Tables over folders whose partitions the catalog finds by repair."""
    root = scratch_path(spark, "db")
    database = f"market_{uuid.uuid4().hex[:8]}"
    sinks.write_jobs(_jobs(spark, sf), f"{root}/jobs")
    sinks.write_job_skills(job_skills(spark, sf), f"{root}/job_skills")
    sinks.register_tables(spark, database, f"{root}/jobs", f"{root}/job_skills", database_location=f"{root}/database")
    sinks.repair_partitions(spark, f"{database}.jobs", f"{database}.job_skills")
    return database


def _register_tables(spark, sf):
    database = _registered_tables(spark, sf)
    return flat(readers.read_view(spark, f"{database}.jobs"))


def _repair_partitions(spark, sf):
    database = _registered_tables(spark, sf)
    return rounded(spark.sql(f"SELECT * FROM {database}.job_skills"))


def _united_view(spark, sf):
    """The catalog view over the scraped and the bulk junction."""
    root, database = scratch_path(spark, "db"), f"market_{uuid.uuid4().hex[:8]}"
    js = job_skills(spark, sf)
    sinks.write_job_skills(js.filter(F.col("year") < 1998), f"{root}/scraped")
    bulk = js.filter(F.col("year") >= 1998).withColumnRenamed("salary_mid_usd", "salary_mid")
    sinks.write_job_skills(bulk.withColumn("posted_date", F.col("posted_date").cast("timestamp")), f"{root}/bulk")
    sinks.register_tables(
        spark, database, job_skills=f"{root}/scraped", bulk_job_skills=f"{root}/bulk", database_location=f"{root}/database"
    )
    sinks.repair_partitions(spark, f"{database}.job_skills", f"{database}.job_skills_bulk")
    return rounded(readers.read_view(spark, f"{database}.job_skills_all"))


def _created_view(spark, sf):
    views.create_views(spark, job_skills(spark, sf))
    return rounded(spark.sql("SELECT * FROM vw_top_skills"))


def _read_view(spark, sf):
    views.create_views(spark, job_skills(spark, sf))
    return rounded(readers.read_view(spark, "vw_salary_by_country"))


def _etl_from_files(spark, sf):
    """The whole batch job over NDJSON in which every record was delivered twice, an older copy with another title."""
    raw_path, jobs_path, skills_path = (scratch_path(spark, n) for n in ("raw", "jobs", "job_skills"))
    newest = _raw(spark, sf)
    older = newest.withColumns({"title": F.lit("old"), "ingested_at": F.lit("2001-01-01T00:00:00")})
    sinks.write_ndjson(newest.unionByName(older), raw_path)
    etl.run_etl(spark, raw_path, jobs_path, skills_path, _VOCABULARY, NOW)
    jobs = spark.read.parquet(jobs_path).select("job_id", "title")
    return rounded(spark.read.parquet(skills_path).join(jobs, "job_id"))


def _etl_flat(spark, sf):
    """Flat records, which bring their skills, scalar place and flat salaries along."""
    return flat(etl.etl_jobs(_flat_record(spark, sf), _VOCABULARY).drop("description"))


def _bulk_junction(spark, sf):
    path = scratch_path(spark, "bulk")
    sets = job_skill_sets(spark, sf)
    sets.select(F.col("job_id").alias("job_link"), F.array_join("skills", "|").alias("job_skills")).write.options(
        header=True, escape='"'
    ).csv(f"{path}/job_skills.csv")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_link"), F.col("o_orderpriority").alias("job_title"),
        F.col("o_totalprice").alias("med_salary"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen"),
    )
    orders.write.option("header", True).csv(f"{path}/linkedin_job_postings.csv")
    result = etl.run_bulk(spark, path, f"{path}/jobs", f"{path}/junction", f"{path}/training", F.lit(NOW))
    read = spark.read.parquet(f"{path}/training").withColumn("posted_date", F.col("posted_date").cast("date"))
    return rounded(read.withColumn("written", F.lit(result.job_skills.rows).cast("long")))


QUERIES = {
    "write_jobs": _write_jobs,
    "write_job_skills": _write_job_skills,
    "write_training_data": _write_training,
    "row_counts": _counts,
    "read_ndjson": _ndjson,
    "read_raw_auto": _raw_auto,
    "read_postings_csv": _postings_csv,
    "read_skills_csv": _skills_csv,
    "read_parquet_multi": _parquet_multi,
    "read_training_table": _training_table,
    "read_view": _read_view,
    "register_tables": _register_tables,
    "job_skills_all": _united_view,
    "repair_partitions": _repair_partitions,
    "create_views": _created_view,
    "etl_jobs": _etl_from_files,
    "etl_jobs_flat": _etl_flat,
    "bulk_job_skills": _bulk_junction,
}

_ALL = f"job_id, posted_date, country, {r('salary_mid_usd')}, skill, year, month"

SQL = {
    "write_jobs": POSTING_SQL["project_jobs"],
    "write_job_skills": JOB_SKILLS_SQL + f"SELECT {_ALL} FROM jsv",
    "write_training_data": JOB_SKILLS_SQL + f"SELECT {_ALL} FROM jsv",
    "row_counts": """
SELECT 'jobs' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'job_skills', count(*) FROM lineitem""",
    "read_ndjson": POSTING_SQL["normalize_posting_nested"],
    "read_raw_auto": PAYLOAD_SQL + """
SELECT md5(coalesce(id, '') || '-' || title || '-' || coalesce(company, '')) AS job_id, title,
  coalesce(predicted = 1, false) AS is_predicted,
  CASE WHEN coalesce(predicted = 1, false) THEN '2001-12-31' END AS date,
  CAST(CASE WHEN NOT coalesce(predicted = 1, false) THEN 2001 END AS INTEGER) AS year
FROM p""",
    "read_postings_csv": "SELECT CAST(doc_id AS VARCHAR) AS job_link, md5(text) AS digest FROM documents",
    "read_skills_csv": JOB_SKILLS_SQL + "SELECT DISTINCT job_id, lower(skill) AS skill FROM jsv",
    "read_parquet_multi": JOB_SKILLS_SQL + f"""
SELECT job_id, posted_date, country, {r('salary_mid_usd')}, skill, year,
       CASE WHEN year < 1998 THEN month END AS month FROM jsv""",
    "read_training_table": JOB_SKILLS_SQL + f"""
SELECT {_ALL}, 'parquet' AS source FROM jsv UNION ALL SELECT {_ALL}, 'csv' FROM jsv""",
    "read_view": DEMAND_SQL["vw_salary_by_country"],
    "register_tables": POSTING_SQL["project_jobs"],
    "job_skills_all": JOB_SKILLS_SQL + f"""
SELECT job_id, posted_date, country, {r('salary_mid_usd')}, skill, year, month FROM jsv""",
    "repair_partitions": JOB_SKILLS_SQL + f"SELECT {_ALL} FROM jsv",
    "create_views": DEMAND_SQL["vw_top_skills"],
    "etl_jobs": JOBS_SQL + f"""
SELECT job_id, posted_date, country, {r('salary_mid_usd')}, 'rest' AS skill, year, month, title
FROM jobs WHERE extracted_skills = 'rest'""",
    "etl_jobs_flat": PAYLOAD_SQL + f""", jobs AS (
  SELECT 'adzuna_' || coalesce(id, substr(md5(title || '-' || coalesce(company, '') || '-' || place), 1, 12)) AS job_id,
    title, coalesce(company, '') AS company, place AS location, upper(search_country) AS country,
    salary_min AS salary_min_usd, salary_max AS salary_max_usd, (salary_min + salary_max) / 2 AS salary_mid_usd,
    coalesce(label, '') AS category, redirect_url AS url, coalesce(created_day, DATE '{NOW}') AS posted_date,
    CASE WHEN description IS NULL THEN '' ELSE 'rest' END AS extracted_skills,
    CASE WHEN description IS NULL THEN 0 ELSE 1 END AS skill_count
  FROM p)
SELECT {_JOBS.replace('description, ', '').replace('year, month', '')} CAST(year(posted_date) AS INTEGER) AS year,
       CAST(month(posted_date) AS INTEGER) AS month
FROM jobs""",
    "bulk_job_skills": JOB_SKILLS_SQL + f"""
SELECT DISTINCT job_id, posted_date, {r('o_totalprice', 'salary_mid')}, lower(skill) AS skill, 'US' AS country, year, month,
       (SELECT count(*) FROM (SELECT DISTINCT job_id, skill FROM jsv)) AS written
FROM jsv JOIN orders ON job_id = CAST(o_orderkey AS VARCHAR)""",
}
