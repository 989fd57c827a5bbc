"""Demand, salary and trend aggregations over the junction table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.dates import latest, since, week_start, weeks_before
from jobtide.functions.numbers import exact_mean
from jobtide.functions.vocabulary import skill_category
from jobtide.operators.quantiles import quantiles_disc

AsOf = Column | dt.date | str | None


def _jobs() -> Column:
    return F.count(F.lit(1)).alias("job_count")


def _salary(function=exact_mean, name: str = "avg_salary") -> Column:
    return F.round(function(F.col("salary_mid_usd")), 0).alias(name)


def top_skills(df: DataFrame, n: int = 20) -> DataFrame:
    """Most wanted skills among rows with a salary."""
    return (
        df.filter(F.col("salary_mid_usd").isNotNull())
        .groupBy("skill")
        .agg(_jobs(), _salary(), _salary(F.min, "min_salary"), _salary(F.max, "max_salary"))
        .orderBy(F.desc("job_count"), "skill")
        .limit(n)
    )


def salary_by_skill(
    df: DataFrame, low: float = 50_000, high: float = 500_000, min_jobs: int = 10, n: int = 30, approx: bool = False
) -> DataFrame:
    """Best paid skills between two salary bounds, with median and 90th percentile.

    Percentiles are exact by default; *approx* uses one pass of bounded sketches instead of two passes.
    """
    bounded = df.filter((F.col("salary_mid_usd") > low) & (F.col("salary_mid_usd") < high))
    measures = [_jobs(), exact_mean(F.col("salary_mid_usd")).alias("_avg")]
    if approx:
        measures += [
            F.percentile_approx("salary_mid_usd", 0.5).alias("_p50"), F.percentile_approx("salary_mid_usd", 0.9).alias("_p90")
        ]
    grouped = bounded.groupBy("skill").agg(*measures).filter(F.col("job_count") >= min_jobs)
    if not approx:
        quantiles = quantiles_disc(bounded, ["skill"], "salary_mid_usd", {"_p50": "0.5", "_p90": "0.9"})
        grouped = grouped.join(quantiles, "skill")
    return (
        grouped.select(
            "skill", "job_count", F.round("_avg", 0).alias("avg_salary"), F.round("_p50", 0).alias("median_salary"),
            F.round("_p90", 0).alias("p90_salary"),
        )
        .orderBy(F.desc("avg_salary"), "skill")
        .limit(n)
    )


def geographic_demand(df: DataFrame) -> DataFrame:
    return df.groupBy("country", "skill").agg(_jobs(), _salary()).orderBy("country", F.desc("job_count"), "skill")


def skill_trends_monthly(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("skill", "year", "month").agg(_jobs(), _salary())
        .orderBy("year", "month", F.desc("job_count"), "skill")
    )


def vw_top_skills(df: DataFrame) -> DataFrame:
    return df.groupBy("skill", "country").agg(_jobs(), F.countDistinct("job_id").alias("unique_jobs"), _salary())


def vw_skill_trends(df: DataFrame, as_of: AsOf = None, weeks: int = 24) -> DataFrame:
    recent = since(df, weeks_before(as_of, weeks))
    return recent.groupBy("skill", week_start(F.col("posted_date")).alias("week"), "country").agg(
        _jobs(), F.avg("salary_mid_usd").alias("avg_salary")
    )


def vw_salary_by_country(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("salary_mid_usd").isNotNull()).groupBy("country")
        .agg(_salary(), _jobs(), F.countDistinct("skill").alias("unique_skills"))
    )


def vw_dashboard_kpis(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row of totals. *approx* replaces the exact distinct counts, whose shuffle carries every job id."""
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(
        distinct("job_id").alias("total_jobs"), distinct("skill").alias("unique_skills"), _salary(),
        distinct("country").alias("countries"),
    )


def vw_skills_by_category(df: DataFrame, groups: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Rows per skill; the category is looked up once per skill, after the aggregation."""
    return df.groupBy("skill").agg(_jobs()).withColumn("category", skill_category(F.col("skill"), groups))


def smoke_top10(df: DataFrame, n: int = 10) -> DataFrame:
    return df.groupBy("skill").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "skill").limit(n)


def weekly_demand(
    df: DataFrame, as_of: AsOf = None, weeks: int | None = 52, keys: tuple[str, ...] = ("skill", "country")
) -> DataFrame:
    """Weekly rows per skill and country over the last *weeks* weeks (None: all)."""
    kept = df if weeks is None else since(df, weeks_before(as_of, weeks))
    first, *rest = keys
    return kept.groupBy(first, week_start(F.col("posted_date")).alias("week"), *rest).agg(
        _jobs(), F.avg("salary_mid_usd").alias("avg_salary"), F.countDistinct("job_id").alias("unique_jobs")
    )


def weekly_demand_from_raw(df: DataFrame) -> DataFrame:
    """Weekly rows from unclean junction rows: unreadable dates and absent keys drop out."""
    salary = next((c for c in ("salary_mid_usd", "salary_mid") if c in df.columns), None)
    amount = F.col(salary).try_cast("double") if salary else F.lit(None).cast("double")
    counted = F.col("job_id") if "job_id" in df.columns else F.col("skill")
    day = F.coalesce(F.col("posted_date").try_cast("date"), F.col("posted_date").try_cast("timestamp").try_cast("date"))
    rows = df.select("skill", "country", week_start(day).alias("week"), counted.alias("_id"), amount.alias("_amount"))
    return (
        rows.filter(F.col("week").isNotNull() & F.col("skill").isNotNull() & F.col("country").isNotNull())
        .groupBy("skill", "week", "country")
        .agg(F.count("_id").alias("job_count"), F.avg("_amount").alias("avg_salary"))
    )


def latest_week_rows(df: DataFrame, weeks: int) -> DataFrame:
    """Rows from *weeks* weeks before the newest week on."""
    newest = df.agg(F.max(week_start(F.col("posted_date")))).scalar()
    return since(df, F.date_sub(newest, 7 * weeks))


def weekly_history(df: DataFrame, weeks: int = 16, skills: list[str] | None = None) -> DataFrame:
    """Weekly rows per skill since *weeks* weeks before the newest week of the whole table."""
    recent = latest_week_rows(df, weeks)
    if skills:
        recent = recent.filter(F.col("skill").isin(skills))
    return recent.groupBy("skill", week_start(F.col("posted_date")).alias("week")).agg(
        _jobs(), F.avg("salary_mid_usd").alias("avg_salary")
    )


def latest_week_scalar(df: DataFrame) -> DataFrame:
    """Rows per skill in the newest week."""
    week = week_start(F.col("posted_date"))
    newest = week_start(latest(df))
    return since(df, newest).filter(week == newest).groupBy("skill").agg(_jobs())


def date_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(_jobs())
