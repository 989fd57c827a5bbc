"""The analytics views by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobtide.operators import demand, growth, pairs
from jobtide.operators.demand import AsOf

VIEWS: dict[str, Callable[[DataFrame, AsOf], DataFrame]] = {
    "vw_top_skills": lambda df, as_of: demand.vw_top_skills(df),
    "vw_skill_trends": demand.vw_skill_trends,
    "vw_salary_by_country": lambda df, as_of: demand.vw_salary_by_country(df),
    "vw_skill_growth": growth.vw_skill_growth,
    "vw_emerging_skills": growth.vw_emerging_skills,
    "vw_skill_cooccurrence": lambda df, as_of: pairs.vw_skill_cooccurrence(df),
    "vw_dashboard_kpis": lambda df, as_of: demand.vw_dashboard_kpis(df),
    "vw_skills_by_category": lambda df, as_of: demand.vw_skills_by_category(df),
}


def create_views(spark: SparkSession, job_skills: DataFrame, as_of: AsOf = None) -> list[str]:
    """Register the eight views over *job_skills* for SQL users; each is evaluated when it is queried."""
    for name, view in VIEWS.items():
        view(job_skills, as_of).createOrReplaceTempView(name)
    return list(VIEWS)
