"""Aggregations, views, growth, pairs and dashboard tables over the junction view."""

from __future__ import annotations

from jobtide.operators import dashboard as dash
from jobtide.operators import demand, growth, pairs
from jobtide.plans.registered.common import BRAND_GROUPS, JOB_SKILLS_SQL, WEEKLY_SQL, category_sql, r, rounded
from jobtide.sources.driver_tables import as_of, job_skills

PICKED = ["Brand#1", "Brand#2", "Brand#7"]


def _js(function, **kwargs):
    return lambda spark, sf: rounded(function(job_skills(spark, sf), **kwargs))


def _dated(function, **kwargs):
    return lambda spark, sf: rounded(function(job_skills(spark, sf), as_of=as_of(spark, sf), **kwargs))


def _top(function, **kwargs):
    return lambda spark, sf: rounded(function(demand.vw_top_skills(job_skills(spark, sf)), **kwargs))


def _trends(function, **kwargs):
    return lambda spark, sf: rounded(
        function(demand.vw_skill_trends(job_skills(spark, sf), as_of(spark, sf)), **kwargs)
    )


def _emerging(function, **kwargs):
    return lambda spark, sf: rounded(
        function(growth.vw_emerging_skills(job_skills(spark, sf), as_of(spark, sf)), **kwargs)
    )


def _pairs(function, **kwargs):
    return lambda spark, sf: function(pairs.vw_skill_cooccurrence(job_skills(spark, sf)), **kwargs)


def _weekly_all(spark, sf):
    return demand.weekly_demand(job_skills(spark, sf), weeks=None)


QUERIES = {
    "top_skills": _js(demand.top_skills),
    "salary_by_skill": _js(demand.salary_by_skill),
    "geographic_demand": _js(demand.geographic_demand),
    "skill_trends_monthly": _js(demand.skill_trends_monthly),
    "vw_top_skills": _js(demand.vw_top_skills),
    "vw_skill_trends": _dated(demand.vw_skill_trends),
    "vw_salary_by_country": _js(demand.vw_salary_by_country),
    "vw_skill_growth": _dated(growth.vw_skill_growth),
    "vw_emerging_skills": _dated(growth.vw_emerging_skills),
    "emerging_left_join": _dated(growth.emerging_left_join),
    "vw_skill_cooccurrence": _js(pairs.vw_skill_cooccurrence),
    "cooccurrence_selfjoin": _js(pairs.cooccurrence_selfjoin),
    "vw_dashboard_kpis": _js(demand.vw_dashboard_kpis),
    "vw_skills_by_category": _js(demand.vw_skills_by_category, groups=BRAND_GROUPS),
    "smoke_top10": _js(demand.smoke_top10),
    "weekly_demand": _dated(demand.weekly_demand, weeks=52),
    "weekly_history": _js(demand.weekly_history, weeks=16, skills=PICKED),
    "latest_week_scalar": _js(demand.latest_week_scalar),
    "growth_by_rows": lambda spark, sf: rounded(growth.growth_by_rows(_weekly_all(spark, sf))),
    "emerging_anchored": lambda spark, sf: rounded(growth.emerging_anchored(_weekly_all(spark, sf))),
    "date_distribution": _js(demand.date_distribution),
    "dash_filter": _top(
        dash.dash_filter, categories=["Languages"], countries=["NATION_1", "NATION_2"], groups=BRAND_GROUPS
    ),
    "dash_skill_totals": _top(dash.dash_skill_totals, groups=BRAND_GROUPS),
    "dash_skill_totals_by_salary": _top(dash.dash_skill_totals, n=10, by="avg_salary", groups=BRAND_GROUPS),
    "dash_category_totals": lambda spark, sf: dash.dash_category_totals(
        demand.vw_skills_by_category(job_skills(spark, sf), BRAND_GROUPS)
    ),
    "dash_trend_topk": _trends(dash.dash_trend_topk),
    "dash_country_topk": _top(dash.dash_country_topk),
    "dash_trend_compare": _trends(dash.dash_trend_compare, skills=PICKED),
    "dash_salary_country": lambda spark, sf: rounded(
        dash.dash_salary_country(demand.vw_salary_by_country(job_skills(spark, sf)), ["NATION_1", "NATION_2", "NATION_3"])
    ),
    "dash_salary_box": _top(dash.dash_salary_box),
    "dash_emerging_kpi": _emerging(dash.dash_emerging_kpi),
    "dash_emerging_table": _emerging(dash.dash_emerging_table),
    "dash_kpi_cards": lambda spark, sf: dash.dash_kpi_cards(demand.vw_dashboard_kpis(job_skills(spark, sf))),
    "dash_cooc_long": _pairs(dash.dash_cooc_long, n=15),
    "dash_cooc_matrix": _pairs(dash.dash_cooc_matrix, n=25),  # all brands, so that SQL can name the columns
    "dash_top_pairs": _pairs(dash.dash_top_pairs, n=25, categories=["Languages"], groups=BRAND_GROUPS),
}

_TOP = """, top AS (
  SELECT skill, country, count(*) AS job_count, count(DISTINCT job_id) AS unique_jobs,
         round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary
  FROM jsv GROUP BY skill, country)
"""
_TRENDS = """, trends AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, country, count(*) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv WHERE posted_date >= (SELECT d FROM ref) - 168 GROUP BY ALL)
"""
_GROWTH = """, recent AS (
  SELECT skill, count(*) AS current_jobs, 
         CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd) AS avg_salary
  FROM jsv WHERE posted_date >= (SELECT d FROM ref) - 28 GROUP BY skill),
previous AS (
  SELECT skill, count(*) AS prev_jobs FROM jsv
  WHERE posted_date >= (SELECT d FROM ref) - 56 AND posted_date < (SELECT d FROM ref) - 28 GROUP BY skill),
growth AS (
  SELECT r.skill, r.current_jobs, coalesce(p.prev_jobs, 1) AS prev_jobs, round(r.avg_salary, 0) AS avg_salary,
         round(CAST((r.current_jobs - coalesce(p.prev_jobs, 1)) * 100 AS DOUBLE) / coalesce(p.prev_jobs, 1), 1) + 0.0
           AS growth_pct
  FROM recent r LEFT JOIN previous p ON r.skill = p.skill)
"""
_EMERGING = _GROWTH + """, emerging AS (
  SELECT *, CASE WHEN growth_pct > 50 AND current_jobs >= 5 THEN 'Hot'
                 WHEN growth_pct > 25 AND current_jobs >= 3 THEN 'Rising'
                 WHEN growth_pct > 10 THEN 'Growing' ELSE 'Stable' END AS trend_status
  FROM growth WHERE current_jobs >= 3)
"""
_PAIRS = """, allpairs AS (
  SELECT a.skill AS skill_a, b.skill AS skill_b, count(*) AS cooccurrence_count
  FROM jsv a JOIN jsv b ON a.job_id = b.job_id AND a.skill < b.skill GROUP BY a.skill, b.skill),
pairs AS (SELECT * FROM allpairs WHERE cooccurrence_count >= 3)
"""
_CELLS = """, s AS (
  SELECT skill_a AS skill, skill_b AS other, cooccurrence_count AS c FROM pairs
  UNION ALL SELECT skill_b, skill_a, cooccurrence_count FROM pairs),
k AS (SELECT skill FROM s GROUP BY skill ORDER BY sum(c) DESC, skill LIMIT 15),
cells AS (SELECT a.skill AS skill, b.skill AS other, coalesce(s.c, 0) AS cooccurrence_count
  FROM k a CROSS JOIN k b LEFT JOIN s ON s.skill = a.skill AND s.other = b.skill)
"""
_TREND_CASE = """CASE WHEN {g} > 50 THEN 'Hot' WHEN {g} > 20 THEN 'Rising' WHEN {g} > 0 THEN 'Growing'
  WHEN {g} <= 0 THEN 'Declining' ELSE 'Stable' END"""
_PICKED = "('Brand#1', 'Brand#2', 'Brand#7')"

SQL = {
    "top_skills": JOB_SKILLS_SQL + """
SELECT skill, count(*) AS job_count, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary,
       round(min(salary_mid_usd), 0) AS min_salary, round(max(salary_mid_usd), 0) AS max_salary
FROM jsv WHERE salary_mid_usd IS NOT NULL GROUP BY skill ORDER BY job_count DESC, skill LIMIT 20""",
    "salary_by_skill": JOB_SKILLS_SQL + """
SELECT skill, count(*) AS job_count, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary,
       round(quantile_disc(salary_mid_usd, 0.5), 0) AS median_salary,
       round(quantile_disc(salary_mid_usd, 0.9), 0) AS p90_salary
FROM jsv WHERE salary_mid_usd > 50000 AND salary_mid_usd < 500000
GROUP BY skill HAVING count(*) >= 10 ORDER BY avg_salary DESC, skill LIMIT 30""",
    "geographic_demand": JOB_SKILLS_SQL + """
SELECT country, skill, count(*) AS job_count, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary
FROM jsv GROUP BY country, skill ORDER BY country, job_count DESC, skill""",
    "skill_trends_monthly": JOB_SKILLS_SQL + """
SELECT skill, year, month, count(*) AS job_count, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary
FROM jsv GROUP BY skill, year, month ORDER BY year, month, job_count DESC, skill""",
    "vw_top_skills": JOB_SKILLS_SQL + _TOP + "SELECT * FROM top",
    "vw_skill_trends": JOB_SKILLS_SQL + _TRENDS + f"SELECT skill, week, country, job_count, {r('avg_salary')} FROM trends",
    "vw_salary_by_country": JOB_SKILLS_SQL + """
SELECT country, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary, count(*) AS job_count,
       count(DISTINCT skill) AS unique_skills
FROM jsv WHERE salary_mid_usd IS NOT NULL GROUP BY country""",
    "vw_skill_growth": JOB_SKILLS_SQL + f""", weekly AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, count(*) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv WHERE posted_date >= (SELECT d FROM ref) - 84 GROUP BY ALL),
m AS (
  SELECT skill, count(*) AS n, sum(job_count) AS total_jobs, round(avg(job_count), 1) AS avg_weekly_jobs,
         round(max(avg_salary), 0) AS max_salary,
         max(CASE WHEN week >= (SELECT d FROM ref) - 28 THEN job_count END) AS a,
         max(CASE WHEN week < (SELECT d FROM ref) - 28 AND week >= (SELECT d FROM ref) - 56 THEN job_count END) AS b
  FROM weekly GROUP BY skill HAVING count(*) >= 4),
trends AS (SELECT *, CAST((a - b) * 100 AS DOUBLE) / nullif(b, 0) AS g FROM m)
SELECT skill, CAST(total_jobs AS BIGINT) AS total_jobs, avg_weekly_jobs, max_salary,
       round(coalesce(g, 0), 1) + 0.0 AS growth_pct,
       round(avg_weekly_jobs * (1 + coalesce(g, 0) / 100), 1) + 0.0 AS forecast_weekly,
       {_TREND_CASE.format(g='g')} AS trend_status
FROM trends""",
    "vw_emerging_skills": JOB_SKILLS_SQL + _EMERGING + "SELECT * FROM emerging",
    "emerging_left_join": JOB_SKILLS_SQL + _GROWTH + "SELECT * FROM growth",
    "vw_skill_cooccurrence": JOB_SKILLS_SQL + _PAIRS + "SELECT * FROM pairs",
    "cooccurrence_selfjoin": JOB_SKILLS_SQL + _PAIRS + "SELECT * FROM allpairs",
    "vw_dashboard_kpis": JOB_SKILLS_SQL + """
SELECT count(DISTINCT job_id) AS total_jobs, count(DISTINCT skill) AS unique_skills,
       round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary, count(DISTINCT country) AS countries FROM jsv""",
    "vw_skills_by_category": JOB_SKILLS_SQL + f"""
SELECT skill, count(*) AS job_count, {category_sql('skill')} AS category FROM jsv GROUP BY skill""",
    "smoke_top10": JOB_SKILLS_SQL + "SELECT skill, count(*) AS cnt FROM jsv GROUP BY skill ORDER BY cnt DESC, skill LIMIT 10",
    "weekly_demand": JOB_SKILLS_SQL + f"""
SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, country, count(*) AS job_count,
       {r('avg(salary_mid_usd)', 'avg_salary')}, count(DISTINCT job_id) AS unique_jobs
FROM jsv WHERE posted_date >= (SELECT d FROM ref) - 364
GROUP BY skill, CAST(date_trunc('week', posted_date) AS DATE), country""",
    "weekly_history": JOB_SKILLS_SQL + f"""
SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, count(*) AS job_count,
       {r('avg(salary_mid_usd)', 'avg_salary')}
FROM jsv
WHERE posted_date >= CAST((SELECT max(date_trunc('week', posted_date)) FROM jsv) AS DATE) - 112 AND skill IN {_PICKED}
GROUP BY skill, CAST(date_trunc('week', posted_date) AS DATE)""",
    "latest_week_scalar": JOB_SKILLS_SQL + """
SELECT skill, count(*) AS job_count FROM jsv
WHERE date_trunc('week', posted_date) = (SELECT max(date_trunc('week', posted_date)) FROM jsv) GROUP BY skill""",
    "growth_by_rows": WEEKLY_SQL + f""", w AS (
  SELECT skill, week, sum(job_count) AS job_count, avg(avg_salary) AS avg_salary FROM wkc GROUP BY skill, week),
k AS (SELECT *, row_number() OVER (PARTITION BY skill ORDER BY week DESC) AS rn FROM w),
s AS (
  SELECT skill, count(*) AS n, sum(job_count) AS total_jobs, round_even(avg(job_count), 1) AS m, max(avg_salary) AS sal,
         sum(CASE WHEN rn <= 4 THEN job_count END) AS a, sum(CASE WHEN rn BETWEEN 5 AND 8 THEN job_count END) AS b
  FROM k GROUP BY skill HAVING count(*) >= 8),
g AS (SELECT *, CAST((a - b) * 100 AS DOUBLE) / greatest(b, 1) AS gr FROM s)
SELECT skill, CAST(total_jobs AS BIGINT) AS total_jobs, m AS avg_weekly_jobs,
       CAST(floor(sal) AS BIGINT) AS max_salary, round_even(gr, 1) + 0.0 AS growth_pct,
       round_even(m * (1 + gr / 100), 1) + 0.0 AS forecast_weekly, {_TREND_CASE.format(g='gr')} AS trend_status
FROM g""",
    "emerging_anchored": WEEKLY_SQL + """, mw AS (SELECT max(week) AS w FROM wkc),
s AS (
  SELECT skill, sum(CASE WHEN week >= (SELECT w FROM mw) - 28 THEN job_count END) AS c,
         sum(CASE WHEN week < (SELECT w FROM mw) - 28 THEN job_count END) AS p,
         avg(CASE WHEN week >= (SELECT w FROM mw) - 28 THEN avg_salary END) AS sal
  FROM wkc WHERE week >= (SELECT w FROM mw) - 56 GROUP BY skill),
g AS (SELECT skill, CAST(c AS BIGINT) AS current_jobs, round_even(sal, 0) AS avg_salary,
             CAST(coalesce(p, 1) AS BIGINT) AS prev_jobs,
             round_even(CAST((c - coalesce(p, 1)) * 100 AS DOUBLE) / coalesce(p, 1), 1) + 0.0 AS growth_pct
      FROM s WHERE c >= 3)
SELECT *, CASE WHEN growth_pct > 50 AND current_jobs >= 5 THEN 'Hot'
               WHEN growth_pct > 25 AND current_jobs >= 3 THEN 'Rising'
               WHEN growth_pct > 10 THEN 'Growing' ELSE 'Stable' END AS trend_status
FROM g""",
    "date_distribution": JOB_SKILLS_SQL + "SELECT year, month, count(*) AS job_count FROM jsv GROUP BY year, month",
    "dash_filter": JOB_SKILLS_SQL + _TOP + f"""
SELECT * FROM top WHERE {category_sql('skill')} = 'Languages' AND country IN ('NATION_1', 'NATION_2')""",
    "dash_skill_totals": JOB_SKILLS_SQL + _TOP + f"""
SELECT skill, CAST(sum(job_count) AS BIGINT) AS job_count, {r('avg(avg_salary)', 'avg_salary')},
       {category_sql('skill')} AS category
FROM top GROUP BY skill ORDER BY job_count DESC, skill LIMIT 20""",
    "dash_skill_totals_by_salary": JOB_SKILLS_SQL + _TOP + f"""
SELECT skill, CAST(sum(job_count) AS BIGINT) AS job_count, {r('avg(avg_salary)', 'avg_salary')},
       {category_sql('skill')} AS category
FROM top GROUP BY skill ORDER BY avg_salary DESC, skill LIMIT 10""",
    "dash_category_totals": JOB_SKILLS_SQL + f"""
SELECT {category_sql('skill')} AS category, count(*) AS job_count FROM jsv GROUP BY 1 ORDER BY job_count DESC, category""",
    "dash_trend_topk": JOB_SKILLS_SQL + _TRENDS + """, w AS (
  SELECT skill, week, CAST(sum(job_count) AS BIGINT) AS job_count FROM trends GROUP BY skill, week)
SELECT * FROM w WHERE skill IN (SELECT skill FROM w GROUP BY skill ORDER BY sum(job_count) DESC, skill LIMIT 8)""",
    "dash_country_topk": JOB_SKILLS_SQL + _TOP + """, w AS (
  SELECT country, skill, CAST(sum(job_count) AS BIGINT) AS job_count FROM top GROUP BY country, skill)
SELECT * FROM w WHERE skill IN (SELECT skill FROM w GROUP BY skill ORDER BY sum(job_count) DESC, skill LIMIT 15)""",
    "dash_trend_compare": JOB_SKILLS_SQL + _TRENDS + f"""
SELECT skill, week, CAST(sum(job_count) AS BIGINT) AS job_count, {r('avg(avg_salary)', 'avg_salary')}
FROM trends WHERE skill IN {_PICKED} GROUP BY skill, week""",
    "dash_salary_country": JOB_SKILLS_SQL + """
SELECT country, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS avg_salary, count(*) AS job_count,
       count(DISTINCT skill) AS unique_skills
FROM jsv WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY country ORDER BY avg_salary, country""",
    "dash_salary_box": JOB_SKILLS_SQL + _TOP + f"""
SELECT skill, {r('quantile_cont(avg_salary, 0.0)', 'min_salary')}, {r('quantile_cont(avg_salary, 0.25)', 'q1_salary')},
       {r('quantile_cont(avg_salary, 0.5)', 'median_salary')}, {r('quantile_cont(avg_salary, 0.75)', 'q3_salary')},
       {r('quantile_cont(avg_salary, 1.0)', 'max_salary')}
FROM top WHERE avg_salary > 0 AND skill IN (
  SELECT skill FROM top WHERE avg_salary > 0 GROUP BY skill ORDER BY sum(job_count) DESC, skill LIMIT 15)
GROUP BY skill""",
    "dash_emerging_kpi": JOB_SKILLS_SQL + _EMERGING + """
SELECT count(*) FILTER (WHERE trend_status IN ('Hot', 'Rising')) AS emerging_skills, max(growth_pct) AS highest_growth,
       (SELECT skill FROM emerging ORDER BY growth_pct DESC, current_jobs DESC, skill DESC LIMIT 1) AS top_emerging
FROM emerging""",
    "dash_emerging_table": JOB_SKILLS_SQL + _EMERGING + """
SELECT skill, current_jobs, prev_jobs, growth_pct,
       CASE WHEN avg_salary IS NULL THEN 'N/A' ELSE format('${:,}', CAST(avg_salary AS BIGINT)) END AS avg_salary,
       trend_status
FROM emerging""",
    "dash_kpi_cards": JOB_SKILLS_SQL + """, k AS (
  SELECT count(DISTINCT job_id) AS j, count(DISTINCT skill) AS s, round(CAST(sum(CAST(salary_mid_usd AS DECIMAL(28,8))) AS DOUBLE) / count(salary_mid_usd), 0) AS a,
         count(DISTINCT country) AS countries FROM jsv)
SELECT CASE WHEN j >= 1000000 THEN printf('%.1fM', j / 1000000.0) WHEN j >= 1000 THEN printf('%.1fK', j / 1000.0)
            ELSE format('{:,}', j) END AS total_jobs,
       format('{:,}', s) AS unique_skills, format('${:,}', CAST(a AS BIGINT)) AS avg_salary, countries
FROM k""",
    "dash_cooc_long": JOB_SKILLS_SQL + _PAIRS + _CELLS + "SELECT * FROM cells",
    "dash_cooc_matrix": JOB_SKILLS_SQL + _PAIRS + _CELLS.replace("LIMIT 15", "LIMIT 25") + "SELECT skill, " + ", ".join(
        f"""CAST(sum(cooccurrence_count) FILTER (other = 'Brand#{i}') AS BIGINT) AS "Brand#{i}\"""" for i in range(1, 26)
    ) + " FROM cells GROUP BY skill",
    "dash_top_pairs": JOB_SKILLS_SQL + _PAIRS + f"""
SELECT skill_a, skill_b, cooccurrence_count, skill_a || ' + ' || skill_b AS pair FROM pairs
WHERE {category_sql('skill_a')} = 'Languages' OR {category_sql('skill_b')} = 'Languages'
ORDER BY cooccurrence_count DESC, skill_a, skill_b LIMIT 25""",
}
