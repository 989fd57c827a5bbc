"""Growth and emergence of skills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.functions.dates import since, week_start, weeks_before
from jobtide.functions.numbers import exact_mean, ratio
from jobtide.operators.demand import AsOf


def _trend(growth: Column) -> Column:
    """Class of an unrounded growth; NULL growth is ``Stable``."""
    return (
        F.when(growth > 50, F.lit("Hot")).when(growth > 20, F.lit("Rising")).when(growth > 0, F.lit("Growing"))
        .when(growth <= 0, F.lit("Declining")).otherwise(F.lit("Stable"))
    )


def _emergence(growth: Column, jobs: Column) -> Column:
    return (
        F.when((growth > 50) & (jobs >= 5), F.lit("Hot")).when((growth > 25) & (jobs >= 3), F.lit("Rising"))
        .when(growth > 10, F.lit("Growing")).otherwise(F.lit("Stable"))
    )


def vw_skill_growth(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Busiest week of the last four against the busiest of the four before, over twelve weeks."""
    recent, prior = weeks_before(as_of, 4), weeks_before(as_of, 8)
    weekly = (
        since(df, weeks_before(as_of, 12))
        .groupBy("skill", week_start(F.col("posted_date")).alias("week"))
        .agg(F.count(F.lit(1)).alias("job_count"), exact_mean(F.col("salary_mid_usd")).alias("avg_salary"))
    )
    jobs, week = F.col("job_count"), F.col("week")
    now_max = F.max(F.when(week >= recent, jobs))
    then_max = F.max(F.when((week < recent) & (week >= prior), jobs))
    trends = (
        weekly.groupBy("skill")
        .agg(
            F.count(F.lit(1)).alias("_weeks"), F.sum("job_count").alias("total_jobs"),
            F.round(F.avg("job_count"), 1).alias("avg_weekly_jobs"), F.round(F.max("avg_salary"), 0).alias("max_salary"),
            now_max.alias("_now"), then_max.alias("_then"),
        )
        .filter(F.col("_weeks") >= 4)
        .withColumn("_growth", ratio((F.col("_now") - F.col("_then")) * 100, F.col("_then")))
    )
    known = F.coalesce("_growth", F.lit(0.0))
    return trends.select(
        "skill", "total_jobs", "avg_weekly_jobs", "max_salary", F.round(known, 1).alias("growth_pct"),
        F.round(F.col("avg_weekly_jobs") * (1 + known / 100), 1).alias("forecast_weekly"),
        _trend(F.col("_growth")).alias("trend_status"),
    )


def _recent_and_prior(df: DataFrame, as_of: AsOf) -> DataFrame:
    """Both four-week windows in one conditional aggregation instead of two scans and a join."""
    start = weeks_before(as_of, 4)
    is_recent = F.col("posted_date") >= start
    return (
        since(df, weeks_before(as_of, 8)).groupBy("skill")
        .agg(
            F.count(F.when(is_recent, F.lit(1))).alias("current_jobs"),
            F.count(F.when(~is_recent, F.lit(1))).alias("_prior"),
            exact_mean(F.when(is_recent, F.col("salary_mid_usd"))).alias("_salary"),
        )
        .filter(F.col("current_jobs") > 0)
    )


def emerging_left_join(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every skill of the last four weeks with its count in the four before; none counts as 1."""
    prior = F.coalesce(F.nullif(F.col("_prior"), F.lit(0)), F.lit(1))
    growth = F.round(ratio((F.col("current_jobs") - prior) * 100, prior), 1)
    return _recent_and_prior(df, as_of).select(
        "skill", "current_jobs", prior.alias("prev_jobs"), F.round("_salary", 0).alias("avg_salary"),
        growth.alias("growth_pct"),
    )


def vw_emerging_skills(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    status = _emergence(F.col("growth_pct"), F.col("current_jobs")).alias("trend_status")
    return emerging_left_join(df, as_of).filter(F.col("current_jobs") >= 3).select("*", status)


def _weekly_totals(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("skill", "week").agg(
        F.sum("job_count").alias("job_count"), F.avg("avg_salary").alias("avg_salary")
    )


def growth_by_rows(weekly: DataFrame) -> DataFrame:
    """Last four weekly rows against the four before, for skills with at least eight.

    A skill has one row per week, so ranking its rows is bounded by the calendar.
    """
    rank = F.row_number().over(Window.partitionBy("skill").orderBy(F.desc("week")))
    ranked = _weekly_totals(weekly).withColumn("_rank", rank)
    summed = (
        ranked.groupBy("skill")
        .agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("job_count").alias("total_jobs"), F.avg("job_count").alias("_mean"),
            F.max("avg_salary").alias("_salary"),
            F.sum(F.when(F.col("_rank") <= 4, F.col("job_count"))).alias("_recent"),
            F.sum(F.when(F.col("_rank").between(5, 8), F.col("job_count"))).alias("_prior"),
        )
        .filter(F.col("_rows") >= 8)
    )
    growth = ratio((F.col("_recent") - F.col("_prior")) * 100, F.greatest(F.col("_prior"), F.lit(1)))
    mean = F.bround("_mean", 1)
    return summed.select(
        "skill", "total_jobs", mean.alias("avg_weekly_jobs"), F.floor("_salary").cast("long").alias("max_salary"),
        F.bround(growth, 1).alias("growth_pct"), F.bround(mean * (1 + growth / 100), 1).alias("forecast_weekly"),
        _trend(growth).alias("trend_status"),
    )


def emerging_anchored(weekly: DataFrame) -> DataFrame:
    """Emergence anchored at the newest week: the weeks from four before it on, and the four before those."""
    newest = weekly.agg(F.max("week")).scalar()
    recent = F.col("week") >= F.date_sub(newest, 28)
    summed = (
        weekly.filter(F.col("week") >= F.date_sub(newest, 56)).groupBy("skill")
        .agg(
            F.sum(F.when(recent, F.col("job_count"))).alias("current_jobs"),
            F.sum(F.when(~recent, F.col("job_count"))).alias("_prior"),
            F.avg(F.when(recent, F.col("avg_salary"))).alias("_salary"),
        )
    )
    prior = F.coalesce("_prior", F.lit(1))
    growth = F.bround(ratio((F.col("current_jobs") - prior) * 100, prior), 1)
    return (
        summed.filter(F.col("current_jobs") >= 3)
        .select(
            "skill", "current_jobs", F.bround("_salary", 0).alias("avg_salary"), prior.alias("prev_jobs"),
            growth.alias("growth_pct"),
        )
        .withColumn("trend_status", _emergence(F.col("growth_pct"), F.col("current_jobs")))
        .orderBy(F.desc("growth_pct"), "skill")
    )
