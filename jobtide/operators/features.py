"""Weekly time-series features.

Rows are one per series and week. A series is (skill, country) unless *keys* says otherwise; with ``("skill",)``
the rows of all countries form one sequence ordered by week and country. Windows over a series are bounded by the
number of weeks in the calendar. Statistics across a week are aggregated first, which combines on the map side, and
joined back by broadcast: there is one row per Monday, and even the whole range of the date type (years 1 to 9999)
has 521,722 of them, about 8 MB.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from jobtide.functions.dates import week_start
from jobtide.functions.numbers import clip, finite_or_zero, pct_change, ratio
from jobtide.functions.vocabulary import model_category
from jobtide.operators.demand import latest_week_rows, weekly_history

SERIES = ("skill", "country")
#: Rows looked back, and rows of rolling frames.
LAGS = (1, 2, 4, 8, 12)
SPANS = (4, 8, 12)

#: The model's input columns.
FEATURES = (
    "job_count_lag_1w", "job_count_lag_2w", "job_count_lag_4w", "salary_lag_1w", "salary_lag_4w",
    "job_count_ma_4w", "job_count_ma_8w", "job_count_ma_12w", "job_count_std_4w", "job_count_std_8w",
    "job_count_ema_4w", "salary_ma_4w", "salary_ma_8w",
    "wow_growth", "mom_growth", "qoq_growth", "growth_acceleration", "market_share", "market_share_change",
    "salary_wow_growth", "salary_mom_growth",
    "cv_8w", "trend_strength_8w",
    "emergence_score", "growth_score", "trend_score",
    "category_share", "category_job_count",
    "week_sin", "week_cos", "month_sin", "month_cos",
)
#: Inputs of the emergence model.
EMERGENCE_FEATURES = (
    "mom_growth", "qoq_growth", "growth_acceleration", "market_share_change", "trend_strength_8w", "emergence_score",
)

#: Weights of growth, acceleration, trend and novelty in the emergence score.
EMERGENCE_WEIGHTS = {"growth_score": 0.35, "acceleration_score": 0.25, "trend_score": 0.25, "novelty_score": 0.15}

Keys = Sequence[str]


def series_window(df: DataFrame, keys: Keys = SERIES) -> WindowSpec:
    """Rows of one series in time order."""
    tie = [c for c in SERIES if c in df.columns and c not in keys]
    return Window.partitionBy(*keys).orderBy("week", *tie)


def _span(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(-(rows - 1), Window.currentRow)


def feat_time(df: DataFrame) -> DataFrame:
    def angle(column: str, period: int) -> Column:
        return F.col(column) * F.lit(2 * math.pi) / F.lit(float(period))

    dated = df.withColumns(
        {
            "week_of_year": F.weekofyear("week"), "month": F.month("week"), "quarter": F.quarter("week"),
            "year": F.year("week"),
        }
    )
    return dated.withColumns(
        {
            "week_sin": F.sin(angle("week_of_year", 52)), "week_cos": F.cos(angle("week_of_year", 52)),
            "month_sin": F.sin(angle("month", 12)), "month_cos": F.cos(angle("month", 12)),
        }
    )


def feat_lags(df: DataFrame, keys: Keys = SERIES, lags: Sequence[int] = LAGS) -> DataFrame:
    window = series_window(df, keys)
    columns = {}
    for n in lags:
        columns[f"job_count_lag_{n}w"] = F.lag("job_count", n).over(window)
        columns[f"salary_lag_{n}w"] = F.lag("avg_salary", n).over(window)
    return df.withColumns(columns)


def feat_rolling(df: DataFrame, keys: Keys = SERIES, spans: Sequence[int] = SPANS) -> DataFrame:
    """Mean, sample deviation (NULL for one row) and salary mean over the last rows."""
    window = series_window(df, keys)
    columns = {}
    for n in spans:
        span = _span(window, n)
        columns[f"job_count_ma_{n}w"] = F.avg("job_count").over(span)
        columns[f"job_count_std_{n}w"] = F.stddev_samp("job_count").over(span)
        columns[f"salary_ma_{n}w"] = F.avg("avg_salary").over(span)
    return df.withColumns(columns)


def feat_ema4(df: DataFrame, keys: Keys = SERIES, span: int = 4) -> DataFrame:
    """Exponentially weighted mean: y0 = x0, then y = a*x + (1-a)*y with a = 2/(span+1).

    The distance e = x - y follows e = (1-a) * (e before + change of x), so it is a scan with affine maps, and maps compose:
    a row that holds the distance over its last n rows takes that of the row n before, times (1-a)^n, and then holds it over
    2n. A few such steps reach back until the weight is less than a double can tell. All lags share one order, and no row
    holds more than a number.
    """
    keep = 1.0 - 2.0 / (span + 1)
    window = series_window(df, keys)
    x = F.col("job_count").cast("double")
    df = df.withColumn("_e", F.when(F.row_number().over(window) == 1, x * 0.0).otherwise((x - F.lag(x, 1).over(window)) * F.lit(keep)))
    back = 1
    while keep**back > 2.0**-60:
        df = df.withColumn("_e", F.col("_e") + F.lag("_e", back, 0.0).over(window) * F.lit(keep**back))
        back *= 2
    return df.withColumn("job_count_ema_4w", x - F.col("_e")).drop("_e")


def feat_growth(df: DataFrame, keys: Keys = SERIES) -> DataFrame:
    """Change against 1, 4 and 12 rows before, and the difference of the last two weekly changes."""
    window = series_window(df, keys)
    now = F.col("job_count")
    one, two, four, twelve = (F.lag("job_count", n).over(window) for n in (1, 2, 4, 12))
    return df.withColumns(
        {
            "wow_growth": pct_change(now, one), "mom_growth": pct_change(now, four),
            "qoq_growth": pct_change(now, twelve),
            "growth_acceleration": pct_change(now, one) - pct_change(one, two),
        }
    )


def feat_market_share(
    df: DataFrame, keys: Keys = SERIES, epsilon: float = 0.0, basis: DataFrame | None = None
) -> DataFrame:
    """Share of the week's total and its change against four rows before.

    *basis*: the same rows before other columns were added, from which the totals are cheaper.
    """
    totals = (df if basis is None else basis).groupBy("week").agg(F.sum("job_count").alias("_week_total"))
    shared = df.join(F.broadcast(totals), "week", "left").withColumn(
        "market_share", ratio(F.col("job_count"), F.col("_week_total") + F.lit(epsilon))
    )
    before = F.lag("market_share", 4).over(series_window(shared, keys))
    changed = shared.withColumn("market_share_change", pct_change(F.col("market_share"), before))
    return changed.select(*df.columns, "market_share", "market_share_change")


def feat_salary_growth(df: DataFrame, keys: Keys = SERIES) -> DataFrame:
    """Salary change against 1 and 4 rows before; gaps carry the last known salary forward."""
    window = series_window(df, keys)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    padded = df.withColumn("_salary", F.last("avg_salary", ignorenulls=True).over(upto))
    now = F.col("_salary")
    return padded.withColumns(
        {
            "salary_wow_growth": pct_change(now, F.lag("_salary", 1).over(window)),
            "salary_mom_growth": pct_change(now, F.lag("_salary", 4).over(window)),
        }
    ).drop("_salary")


def feat_cv(df: DataFrame) -> DataFrame:
    return df.withColumn("cv_8w", F.col("job_count_std_8w") / (F.col("job_count_ma_8w") + 1))


def feat_trend_strength(df: DataFrame, keys: Keys = SERIES, rows: int = 8, min_rows: int = 4) -> DataFrame:
    """R² of a straight line through the last rows: NULL below *min_rows*, 0 for a constant."""
    window = series_window(df, keys)
    numbered = df.withColumn("_t", F.row_number().over(window))
    span = _span(window, rows)
    fit = (
        F.when(F.count("job_count").over(span) < min_rows, F.lit(None))
        .when(F.min("job_count").over(span) == F.max("job_count").over(span), F.lit(0.0))
        .otherwise(F.regr_r2("job_count", "_t").over(span))
    )
    return numbered.withColumn(f"trend_strength_{rows}w", fit).drop("_t")


def _with_novelty(df: DataFrame, keys: Keys, expanding: bool) -> DataFrame:
    window = series_window(df, keys)
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow) if expanding else Window.partitionBy(*keys)
    return df.withColumn("_novelty", F.lit(1.0) / (F.lit(1.0) + F.log1p(F.avg("job_count").over(frame))))


def feat_emergence(
    df: DataFrame, keys: Keys = SERIES, expanding: bool = False, epsilon: float = 1e-8, basis: DataFrame | None = None
) -> DataFrame:
    """Composite of growth, acceleration, trend and novelty, each scaled within its week.

    Novelty uses the mean of the whole series; *expanding* uses the rows up to the week instead, without looking
    ahead. *basis*: the same rows with only the growth columns, from which the bounds are cheaper.
    """
    raw = _with_novelty(df, keys, expanding)
    source = raw if basis is None else _with_novelty(basis, keys, expanding)
    scaled = {"growth_score": "mom_growth", "acceleration_score": "growth_acceleration", "novelty_score": "_novelty"}
    bounds = source.groupBy("week").agg(
        *[f(column).alias(f"_{f.__name__}_{name}") for name, column in scaled.items() for f in (F.min, F.max)]
    )
    joined = raw.join(F.broadcast(bounds), "week", "left")

    def within_week(name: str) -> Column:
        low, high = F.col(f"_min_{name}"), F.col(f"_max_{name}")
        value = (F.col(scaled[name]) - low) / (high - low + F.lit(epsilon))
        return value if name == "novelty_score" else clip(value)

    scores = {name: within_week(name) for name in scaled}
    scores["trend_score"] = clip(F.coalesce("trend_strength_8w", F.lit(0.0)))
    scored = joined.withColumns(scores)
    total = None
    for name, weight in EMERGENCE_WEIGHTS.items():
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    return scored.withColumn("emergence_score", total).select(
        *df.columns, "growth_score", "acceleration_score", "trend_score", "novelty_score", "emergence_score"
    )


def category_weekly(df: DataFrame, groups: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(week, category) totals."""
    named = df.withColumn("skill_category", model_category(F.col("skill"), groups))
    return named.groupBy("week", "skill_category").agg(F.sum("job_count").alias("category_job_count"))


def feat_category(
    df: DataFrame, groups: dict[str, tuple[str, ...]] | None = None, basis: DataFrame | None = None
) -> DataFrame:
    """Category, its total in the week, and the row's share of it. There are eight categories per week."""
    named = df.withColumn("skill_category", model_category(F.col("skill"), groups))
    joined = named.join(F.broadcast(category_weekly(df if basis is None else basis, groups)), ["week", "skill_category"], "left")
    share = ratio(F.col("job_count"), F.col("category_job_count") + 1)
    return joined.withColumn("category_share", share).select(
        *df.columns, "skill_category", "category_job_count", "category_share"
    )


def make_target(df: DataFrame, keys: Keys = SERIES, horizon: int = 4) -> DataFrame:
    """The count *horizon* rows ahead; rows without one are dropped."""
    ahead = F.lead("job_count", horizon).over(series_window(df, keys))
    return df.withColumn("target", ahead).filter(F.col("target").isNotNull())


def all_features(
    weekly: DataFrame, keys: Keys = SERIES, groups: dict[str, tuple[str, ...]] | None = None, expanding: bool = False
) -> DataFrame:
    """Every feature block on weekly rows."""
    df = feat_ema4(weekly, keys)
    df = feat_time(df)
    df = feat_lags(df, keys)
    df = feat_rolling(df, keys)
    df = feat_growth(df, keys)
    df = feat_salary_growth(df, keys)
    df = feat_cv(df)
    df = feat_trend_strength(df, keys)
    df = feat_market_share(df, keys, basis=weekly)
    df = feat_emergence(df, keys, expanding, basis=feat_growth(weekly, keys))
    return feat_category(df, groups, basis=weekly)


def _identity(df: DataFrame) -> list[str]:
    return [c for c in ("skill", "week", "country") if c in df.columns]


def feature_matrix(
    weekly: DataFrame, keys: Keys = SERIES, horizon: int | None = 4,
    groups: dict[str, tuple[str, ...]] | None = None, expanding: bool = False,
) -> DataFrame:
    """Keys, the 32 features without NULL or infinity, and the target (unless *horizon* is None).

    *weekly* is read by several branches (week totals, week bounds), so pass a stored table.
    """
    df = all_features(weekly, keys, groups, expanding)
    extra = []
    if horizon is not None:
        df = make_target(df, keys, horizon)
        extra = [F.col("target").cast("double").alias("target")]
    return df.select(*_identity(weekly), *[finite_or_zero(F.col(c)).alias(c) for c in FEATURES], *extra)


# --- At inference time -------------------------------------------------------------------------------------------


def smoothed_growth(df: DataFrame) -> DataFrame:
    """Change against a lag, with one added to the lag."""

    def change(lag: str) -> Column:
        return ratio(F.col("job_count") - F.col(lag), F.col(lag) + 1)

    return df.withColumns({"wow_growth": change("job_count_lag_1w"), "mom_growth": change("job_count_lag_4w")})


def latest_features(df: DataFrame, weeks: int = 16, skills: list[str] | None = None, filter_first: bool = False) -> DataFrame:
    """Features of the newest week from the last *weeks* weeks.

    *filter_first* keeps only the newest week before the windows are taken, which leaves every lag empty.
    """
    recent = latest_week_rows(df, weeks)
    newest = df.agg(F.max(week_start(F.col("posted_date")))).scalar()
    if skills:
        recent = recent.filter(F.col("skill").isin(skills))
    weekly = recent.groupBy("skill", week_start(F.col("posted_date")).alias("week")).agg(
        F.count(F.lit(1)).alias("job_count"), F.avg("salary_mid_usd").alias("avg_salary")
    )
    if filter_first:
        weekly = weekly.filter(F.col("week") == newest)
    window = series_window(weekly, ("skill",))
    lagged = weekly.withColumns(
        {
            "job_count_lag_1w": F.lag("job_count", 1).over(window), "job_count_lag_4w": F.lag("job_count", 4).over(window),
            "salary_lag_1w": F.lag("avg_salary", 1).over(window),
            "job_count_ma_4w": F.avg("job_count").over(_span(window, 4)),
            "job_count_ma_8w": F.avg("job_count").over(_span(window, 8)),
        }
    )
    if not filter_first:
        lagged = lagged.filter(F.col("week") == newest)
    return smoothed_growth(lagged)


def inference_features(weekly: DataFrame) -> DataFrame:
    """Growth, share, trend and emergence of weekly rows per skill, as the detector expects them."""
    keys = ("skill",)
    df = feat_growth(weekly, keys)
    df = feat_trend_strength(df, keys)
    df = feat_market_share(df, keys, epsilon=1e-8)
    return feat_emergence(df, keys)


def inference_history(df: DataFrame, weeks: int = 20) -> DataFrame:
    return inference_features(weekly_history(df, weeks))


def latest_per_skill(df: DataFrame, keys: Keys = ("skill",)) -> DataFrame:
    """Last row per skill by week (and country, where weeks repeat)."""
    tie = [F.desc(c) for c in SERIES if c in df.columns and c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("week"), *tie))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
