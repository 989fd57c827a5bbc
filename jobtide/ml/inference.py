"""Scoring: forecasts, emerging skills, recommendations and the market report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.ml.boosting import BoostedTrees
from jobtide.ml.isoforest import IsolationForestModel
from jobtide.operators.dashboard import top_k
from jobtide.operators.features import FEATURES, latest_per_skill
from jobtide.operators.relations import enrich_recommendations, filter_known_skills


def align_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Every model input as a double: absent columns and NULL become 0."""
    present = set(df.columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in present else F.lit(0.0) for c in columns}
    )


def batch_score(demand: BoostedTrees, forest: IsolationForestModel, df: DataFrame) -> DataFrame:
    """Add ``demand_forecast`` and ``emergence_score_model`` to a feature table."""
    scored = forest.score(demand.transform(align_features(df)))
    return (
        scored.withColumnsRenamed({"predicted": "demand_forecast", "anomaly_score": "emergence_score_model"})
        .drop("is_outlier")
    )


def forecast_demand(
    demand: BoostedTrees, latest: DataFrame, skills: list[str] | None = None, top_n: int | None = 20
) -> DataFrame:
    """Forecast for the named skills, or for the *top_n* most wanted (None: all). The horizon is that of the training target."""
    if skills:
        chosen = latest.filter(F.col("skill").isin(skills))
    else:
        chosen = latest if top_n is None else top_k(latest, top_n, "job_count", "skill")
    predicted = F.rint("predicted").cast("long")
    return (
        demand.transform(align_features(chosen))
        .select(
            "skill", F.col("job_count").alias("current_demand"), predicted.alias("predicted_demand"),
            F.col("avg_salary").alias("current_salary"), (predicted - F.col("job_count")).alias("demand_change"),
            F.bround((F.try_divide(predicted.cast("double"), F.col("job_count")) - 1) * 100, 1).alias("growth_pct"),
        )
        .orderBy(F.desc("growth_pct"), "skill")
    )


def detect_emerging(
    forest: IsolationForestModel, history: DataFrame, threshold: float = 0.8, top_n: int = 10, min_growth: float = 0.1
) -> DataFrame:
    """Newest row per skill whose score, scaled over all skills, reaches *threshold*, with monthly growth.

    *history* holds the inference features of the last weeks.
    """
    latest = latest_per_skill(history)
    raw = forest.score(align_features(latest)).select("skill", "job_count", "anomaly_score", "mom_growth", "avg_salary")
    bounds = raw.agg(F.min("anomaly_score").alias("_low"), F.max("anomaly_score").alias("_high"))
    low_high = bounds.select(F.struct("_low", "_high")).scalar()
    scaled = raw.withColumn("_bounds", low_high).withColumn(
        "emergence_score",
        (F.col("anomaly_score") - F.col("_bounds._low")) / (F.col("_bounds._high") - F.col("_bounds._low") + F.lit(1e-8)),
    )
    emerging = scaled.filter((F.col("emergence_score") >= threshold) & (F.col("mom_growth") > min_growth))
    return top_k(emerging, top_n, "emergence_score", "skill").select(
        "skill", F.col("job_count").alias("current_jobs"), F.bround("emergence_score", 3).alias("emergence_score"),
        F.bround(F.col("mom_growth") * 100, 1).alias("monthly_growth_pct"), "avg_salary",
    )


def detect_emerging_batch(forest: IsolationForestModel, matrix: DataFrame, top_n: int = 20) -> DataFrame:
    """Most anomalous growing skills of a feature table, by the newest growing row of each."""
    growing = forest.score(matrix).filter(F.col("mom_growth") > 0)
    return top_k(latest_per_skill(growing), top_n, "anomaly_score", "skill").select("skill", "anomaly_score", "mom_growth")


def recommend_skills(clusters: DataFrame, forecast: DataFrame, known: list[str], top_n: int = 5) -> DataFrame:
    """Unknown skills from the clusters of the known ones, fastest growing first; no forecast counts as no growth."""
    candidates = filter_known_skills(clusters, known).withColumn(
        "reason", F.lit(f"Often used alongside {known[0]}" if known else "")
    )
    return (
        enrich_recommendations(candidates, forecast)
        .orderBy(F.coalesce("growth_pct", F.lit(0.0)).desc(), "skill").limit(top_n)
    )


def market_report(forecast: DataFrame, emerging: DataFrame, n: int = 10, min_demand: int = 10) -> dict[str, DataFrame]:
    """Summary and four top lists. *forecast* covers the top skills and is read five times, so pass a stored one."""
    growth = F.col("growth_pct")
    summary = forecast.agg(
        F.count(F.lit(1)).alias("total_skills_tracked"), F.avg(growth).alias("avg_growth_rate"),
        F.count(F.when(growth > 0, F.lit(1))).alias("skills_growing"),
        F.count(F.when(growth < 0, F.lit(1))).alias("skills_declining"), F.avg("current_salary").alias("avg_salary"),
    ).withColumn("report_date", F.current_timestamp())
    demand_columns = ["skill", "current_demand", "predicted_demand", "growth_pct"]
    return {
        "market_summary": summary,
        "top_demand_skills": top_k(forecast, n, "current_demand", "skill").select(demand_columns),
        "fastest_growing_skills": top_k(
            forecast.filter(F.col("current_demand") >= min_demand), n, "growth_pct", "skill"
        ).select(demand_columns),
        "emerging_skills": emerging,
        "highest_paying_skills": top_k(forecast, n, "current_salary", "skill").select(
            "skill", "current_salary", "current_demand", "growth_pct"
        ),
    }
