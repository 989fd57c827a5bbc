"""Weekly feature blocks over the junction view."""

from __future__ import annotations

from jobtide.operators import demand, features, relations
from jobtide.plans.registered.common import BRAND_GROUPS, JOB_SKILLS_SQL, WEEKLY_SQL, category_sql, r, rounded
from jobtide.plans.store import stored
from jobtide.sources.driver_tables import job_skills

MODEL_GROUPS = {"languages": BRAND_GROUPS["Languages"], "cloud": BRAND_GROUPS["Cloud & Infra"]}


def weekly(spark, sf, keys=features.SERIES):
    return demand.weekly_demand(job_skills(spark, sf), weeks=None, keys=keys).drop("unique_jobs")


def _block(function, **kwargs):
    return lambda spark, sf: rounded(function(weekly(spark, sf), **kwargs))


def _by_skill(function, **kwargs):
    """The same block with one sequence per skill, countries interleaved."""
    return lambda spark, sf: rounded(function(weekly(spark, sf), ("skill",), **kwargs))


def _cv(df):
    return features.feat_cv(features.feat_rolling(df)).select("skill", "week", "country", "cv_8w")


def _emergence(df):
    return features.feat_emergence(features.feat_trend_strength(features.feat_growth(df)))


def _smoothed(df):
    return features.smoothed_growth(features.feat_lags(df)).select(
        "skill", "week", "country", "job_count", "job_count_lag_1w", "job_count_lag_4w", "wow_growth", "mom_growth"
    )


def _category_join(df):
    return features.feat_category(df, MODEL_GROUPS)


def _target_pair(df, on_country):
    small = features.make_target(df)
    return relations.features_target_join(small.select("skill", "week", "country", "job_count"), small, on_country)


QUERIES = {
    "feat_time": _block(features.feat_time),
    "feat_lags": _block(features.feat_lags),
    "feat_lags_by_skill": _by_skill(features.feat_lags),
    "feat_rolling": _block(features.feat_rolling),
    "feat_ema4": _block(features.feat_ema4),
    "feat_growth": _block(features.feat_growth),
    "feat_market_share": _block(features.feat_market_share),
    "feat_salary_growth": _block(features.feat_salary_growth),
    "feat_cv": _block(_cv),
    "feat_trend_strength": _block(features.feat_trend_strength),
    "feat_emergence": _block(_emergence),
    "feat_category": _block(_category_join),
    "category_weekly_join": lambda spark, sf: features.category_weekly(weekly(spark, sf), MODEL_GROUPS),
    "make_target": _block(features.make_target),
    "feature_matrix": lambda spark, sf: rounded(
        features.feature_matrix(stored(weekly(spark, sf), "weekly"), groups=MODEL_GROUPS)
    ),
    "features_target_join": _block(_target_pair, on_country=True),
    "features_target_join_no_country": _block(_target_pair, on_country=False),
    "smoothed_growth": _block(_smoothed),
    "latest_features": lambda spark, sf: rounded(features.latest_features(job_skills(spark, sf))),
    "latest_features_filter_first": lambda spark, sf: rounded(
        features.latest_features(job_skills(spark, sf), filter_first=True)
    ),
    "inference_features": lambda spark, sf: rounded(
        features.inference_history(job_skills(spark, sf), 20)
    ),
    "latest_per_skill": _block(features.latest_per_skill),
}

_W = "OVER (PARTITION BY skill, country ORDER BY week)"


def _frame(n: int, keys: str = "skill, country", order: str = "week") -> str:
    return f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _lag(column: str, n: int, window: str = _W) -> str:
    return f"lag({column}, {n}) {window}"


def _pct(now: str, before: str) -> str:
    return f"(CAST({now} AS DOUBLE) / nullif({before}, 0) - 1)"


def _growth_columns(window: str = _W) -> dict[str, str]:
    one, two, four, twelve = (_lag("job_count", n, window) for n in (1, 2, 4, 12))
    return {
        "wow_growth": _pct("job_count", one),
        "mom_growth": _pct("job_count", four),
        "qoq_growth": _pct("job_count", twelve),
        "growth_acceleration": f"{_pct('job_count', one)} - {_pct(one, two)}",
    }


def _columns(columns: dict[str, str], rounding: bool = True) -> str:
    return ", ".join(r(e, name) if rounding else f"{e} AS {name}" for name, e in columns.items())


def _lag_columns(window: str) -> str:
    return ", ".join(
        f"{_lag('job_count', n, window)} AS job_count_lag_{n}w, {r(_lag('avg_salary', n, window), f'salary_lag_{n}w')}"
        for n in features.LAGS
    )


def _rolling(keys: str = "skill, country") -> dict[str, str]:
    found = {}
    for n in features.SPANS:
        frame = _frame(n, keys)
        found[f"job_count_ma_{n}w"] = f"avg(job_count) {frame}"
        found[f"job_count_std_{n}w"] = f"stddev_samp(job_count) {frame}"
        found[f"salary_ma_{n}w"] = f"avg(avg_salary) {frame}"
    return found


_TIME = {
    "week_sin": "sin(weekofyear(week) * 2 * pi() / 52)", "week_cos": "cos(weekofyear(week) * 2 * pi() / 52)",
    "month_sin": "sin(month(week) * 2 * pi() / 12)", "month_cos": "cos(month(week) * 2 * pi() / 12)",
}


def _ema(source: str, keys: str = "skill, country") -> str:
    return (
        "list_reduce(list(CAST(job_count AS DOUBLE)) OVER (PARTITION BY " + keys
        + " ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda a, b: a * 0.6 + b * 0.4)"
    )


def _trend(source: str, keys: str) -> str:
    """CTE ``tr``: the source with its trend strength."""
    frame = _frame(8, keys, "t")
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY week) AS t FROM {source}),
tr AS (SELECT * EXCLUDE (t),
  CASE WHEN count(*) {frame} < 4 THEN NULL WHEN min(job_count) {frame} = max(job_count) {frame} THEN 0.0
       ELSE regr_r2(job_count, t) {frame} END AS trend_strength_8w
  FROM numbered)"""


def _emergence_ctes(source: str, keys: str) -> str:
    """CTE ``em``: the source (with growth and trend columns) with the emergence scores."""
    return f"""nov AS (SELECT *, 1 / (1 + ln(1 + avg(job_count) OVER (PARTITION BY {keys}))) AS nv FROM {source}),
sc AS (SELECT * EXCLUDE (nv),
  greatest(0.0, least(1.0, (mom_growth - min(mom_growth) OVER wk) / (max(mom_growth) OVER wk - min(mom_growth) OVER wk + 1e-8)))
    + mom_growth * 0 AS growth_score,
  greatest(0.0, least(1.0, (growth_acceleration - min(growth_acceleration) OVER wk)
    / (max(growth_acceleration) OVER wk - min(growth_acceleration) OVER wk + 1e-8))) + growth_acceleration * 0
    AS acceleration_score,
  greatest(0.0, least(1.0, coalesce(trend_strength_8w, 0.0))) AS trend_score,
  (nv - min(nv) OVER wk) / (max(nv) OVER wk - min(nv) OVER wk + 1e-8) AS novelty_score
  FROM nov WINDOW wk AS (PARTITION BY week)),
em AS (SELECT *, 0.35 * growth_score + 0.25 * acceleration_score + 0.25 * trend_score + 0.15 * novelty_score
  AS emergence_score FROM sc)"""


_SCORES = ("growth_score", "acceleration_score", "trend_score", "novelty_score", "emergence_score")


def _emergence_sql(source: str, keys: str, base: str, window: str) -> str:
    growth = _columns(_growth_columns(window), rounding=False)
    return (
        f", gr AS (SELECT *, {growth} FROM {source}), {_trend('gr', keys)}, {_emergence_ctes('tr', keys)} "
        f"SELECT {base}, {', '.join(r(c) for c in (*_growth_columns(), 'trend_strength_8w', *_SCORES))} FROM em"
    )


_BASE = f"skill, week, country, job_count, {r('avg_salary')}"
_SHARE = f"CAST(job_count AS DOUBLE) / sum(job_count) OVER (PARTITION BY week)"
_MODEL_CATEGORY = category_sql("skill", MODEL_GROUPS, "other")


def _finite(expression: str, name: str) -> str:
    unusable = f"{expression} IS NULL OR isnan({expression}) OR isinf({expression})"
    return r(f"CASE WHEN {unusable} THEN 0.0 ELSE {expression} END", name)


def _matrix_sql(source: str = "wkc", category: str = _MODEL_CATEGORY) -> str:
    lags = {f"job_count_lag_{n}w": _lag("job_count", n) for n in (1, 2, 4)}
    lags |= {f"salary_lag_{n}w": _lag("avg_salary", n) for n in (1, 4)}
    padded = "last_value(avg_salary IGNORE NULLS) OVER (PARTITION BY skill, country ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    first = {
        **_growth_columns(), **_rolling(), **lags, **_TIME, "job_count_ema_4w": _ema(source), "market_share": _SHARE,
        "_pad": padded, "skill_category": category, "target": f"lead(job_count, 4) {_W}",
    }
    second = {
        "market_share_change": _pct("market_share", _lag("market_share", 4)),
        "salary_wow_growth": _pct("_pad", _lag("_pad", 1)), "salary_mom_growth": _pct("_pad", _lag("_pad", 4)),
        "cv_8w": "job_count_std_8w / (job_count_ma_8w + 1)",
        "category_job_count": "sum(job_count) OVER (PARTITION BY week, skill_category)",
    }
    final = ", ".join(_finite(f"CAST({c} AS DOUBLE)", c) for c in features.FEATURES if c != "category_share")
    share = "CAST(job_count AS DOUBLE) / (category_job_count + 1)"
    return (
        f", f1 AS (SELECT *, {_columns(first, False)} FROM {source}), f2 AS (SELECT *, {_columns(second, False)} FROM f1), "
        f"{_trend('f2', 'skill, country')}, {_emergence_ctes('tr', 'skill, country')} "
        f"SELECT skill, week, country, {final}, {_finite(share, 'category_share')}, CAST(target AS DOUBLE) AS target "
        "FROM em WHERE target IS NOT NULL"
    )


def _latest_sql(filter_first: bool) -> str:
    """Newest week with lags; the week filter sits before or after the windows."""
    where = "WHERE week = (SELECT w FROM mw)"
    window = "OVER (PARTITION BY skill ORDER BY week)"
    source = f"(SELECT * FROM ws {where})" if filter_first else "ws"
    return JOB_SKILLS_SQL + f""", mw AS (SELECT CAST(max(date_trunc('week', posted_date)) AS DATE) AS w FROM jsv),
ws AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, count(*) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv WHERE posted_date >= (SELECT w FROM mw) - 112 GROUP BY ALL),
l AS (
  SELECT *, lag(job_count, 1) {window} AS job_count_lag_1w, lag(job_count, 4) {window} AS job_count_lag_4w,
         lag(avg_salary, 1) {window} AS salary_lag_1w, avg(job_count) {_frame(4, 'skill')} AS job_count_ma_4w,
         avg(job_count) {_frame(8, 'skill')} AS job_count_ma_8w
  FROM {source} s)
SELECT skill, week, job_count, {r('avg_salary')}, job_count_lag_1w, job_count_lag_4w, {r('salary_lag_1w')},
       {r('job_count_ma_4w')}, {r('job_count_ma_8w')},
       {r('CAST(job_count - job_count_lag_1w AS DOUBLE) / (job_count_lag_1w + 1)', 'wow_growth')},
       {r('CAST(job_count - job_count_lag_4w AS DOUBLE) / (job_count_lag_4w + 1)', 'mom_growth')}
FROM l {'' if filter_first else where}"""


def _inference_sql() -> str:
    window = "OVER (PARTITION BY skill ORDER BY week)"
    share = "job_count / (sum(job_count) OVER (PARTITION BY week) + 1e-8)"
    growth = _columns(_growth_columns(window), rounding=False)
    return JOB_SKILLS_SQL + f""", mw AS (SELECT CAST(max(date_trunc('week', posted_date)) AS DATE) AS w FROM jsv),
ws AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, count(*) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv WHERE posted_date >= (SELECT w FROM mw) - 140 GROUP BY ALL),
gr AS (SELECT *, {growth}, {share} AS market_share FROM ws),
sh AS (SELECT *, {_pct('market_share', _lag('market_share', 4, window))} AS market_share_change FROM gr),
{_trend('sh', 'skill')}, {_emergence_ctes('tr', 'skill')}
SELECT skill, week, job_count, {r('avg_salary')},
  {', '.join(r(c) for c in (*_growth_columns(), 'trend_strength_8w', 'market_share', 'market_share_change', *_SCORES))}
FROM em"""


SQL = {
    "feat_time": WEEKLY_SQL + f"""
SELECT {_BASE}, CAST(weekofyear(week) AS INTEGER) AS week_of_year, CAST(month(week) AS INTEGER) AS month,
       CAST(quarter(week) AS INTEGER) AS quarter, CAST(year(week) AS INTEGER) AS year, {_columns(_TIME)} FROM wkc""",
    "feat_lags": WEEKLY_SQL + f"SELECT {_BASE}, {_lag_columns(_W)} FROM wkc",
    "feat_lags_by_skill": WEEKLY_SQL + f"SELECT {_BASE}, {_lag_columns('OVER (PARTITION BY skill ORDER BY week, country)')} FROM wkc",
    "feat_rolling": WEEKLY_SQL + f"SELECT {_BASE}, {_columns(_rolling())} FROM wkc",
    "feat_ema4": WEEKLY_SQL + f"SELECT {_BASE}, {r(_ema('wkc'), 'job_count_ema_4w')} FROM wkc",
    "feat_growth": WEEKLY_SQL + f"SELECT {_BASE}, {_columns(_growth_columns())} FROM wkc",
    "feat_market_share": WEEKLY_SQL + f""", s AS (SELECT *, {_SHARE} AS market_share FROM wkc)
SELECT {_BASE}, {r('market_share')}, {r(_pct('market_share', _lag('market_share', 4)), 'market_share_change')} FROM s""",
    "feat_salary_growth": WEEKLY_SQL + f"""
SELECT {_BASE}, {r(_pct('avg_salary', _lag('avg_salary', 1)), 'salary_wow_growth')},
       {r(_pct('avg_salary', _lag('avg_salary', 4)), 'salary_mom_growth')} FROM wkc""",
    "feat_cv": WEEKLY_SQL + f"""
SELECT skill, week, country, {r(f'stddev_samp(job_count) {_frame(8)} / (avg(job_count) {_frame(8)} + 1)', 'cv_8w')} FROM wkc""",
    "feat_trend_strength": WEEKLY_SQL + f", {_trend('wkc', 'skill, country')} SELECT {_BASE}, {r('trend_strength_8w')} FROM tr",
    "feat_emergence": WEEKLY_SQL + _emergence_sql("wkc", "skill, country", _BASE, _W),
    "feat_category": WEEKLY_SQL + f""", c AS (SELECT *, {_MODEL_CATEGORY} AS skill_category FROM wkc),
t AS (SELECT week, skill_category, sum(job_count) AS category_job_count FROM c GROUP BY ALL)
SELECT skill, c.week AS week, country, job_count, {r('avg_salary')}, c.skill_category AS skill_category,
       CAST(category_job_count AS BIGINT) AS category_job_count,
       {r('CAST(job_count AS DOUBLE) / (category_job_count + 1)', 'category_share')}
FROM c LEFT JOIN t ON c.week = t.week AND c.skill_category = t.skill_category""",
    "category_weekly_join": WEEKLY_SQL + f"""
SELECT week, {_MODEL_CATEGORY} AS skill_category, CAST(sum(job_count) AS BIGINT) AS category_job_count FROM wkc GROUP BY 1, 2""",
    "make_target": WEEKLY_SQL + f""", t AS (SELECT *, lead(job_count, 4) {_W} AS target FROM wkc)
SELECT {_BASE}, target FROM t WHERE target IS NOT NULL""",
    "feature_matrix": WEEKLY_SQL + _matrix_sql(),
    "features_target_join": WEEKLY_SQL + f""", t AS (SELECT *, lead(job_count, 4) {_W} AS target FROM wkc)
SELECT skill, week, country, job_count, target FROM t WHERE target IS NOT NULL""",
    "features_target_join_no_country": WEEKLY_SQL + f""", l AS (SELECT *, lead(job_count, 4) {_W} AS target FROM wkc),
t AS (SELECT * FROM l WHERE target IS NOT NULL)
SELECT a.skill AS skill, a.week AS week, a.country AS country, a.job_count AS job_count, b.target AS target
FROM t a JOIN t b ON a.skill = b.skill AND a.week = b.week""",
    "smoothed_growth": WEEKLY_SQL + f""", l AS (
  SELECT *, {_lag('job_count', 1)} AS job_count_lag_1w, {_lag('job_count', 4)} AS job_count_lag_4w FROM wkc)
SELECT skill, week, country, job_count, job_count_lag_1w, job_count_lag_4w,
       {r('CAST(job_count - job_count_lag_1w AS DOUBLE) / (job_count_lag_1w + 1)', 'wow_growth')},
       {r('CAST(job_count - job_count_lag_4w AS DOUBLE) / (job_count_lag_4w + 1)', 'mom_growth')} FROM l""",
    "latest_features": _latest_sql(False),
    "latest_features_filter_first": _latest_sql(True),
    "inference_features": _inference_sql(),
    "latest_per_skill": WEEKLY_SQL + f"""
SELECT {_BASE} FROM wkc QUALIFY row_number() OVER (PARTITION BY skill ORDER BY week DESC, country DESC) = 1""",
}
