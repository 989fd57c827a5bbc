"""The table work behind the dashboard pages, as transformations of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.functions.text import fixed, fmt_number, fmt_salary
from jobtide.functions.vocabulary import skill_category
from jobtide.plans.store import stored

Groups = dict[str, tuple[str, ...]] | None


def top_k(df: DataFrame, k: int, by: str, *tie: str) -> DataFrame:
    """The *k* largest rows by *by*, ties by key: a total order, so the result is determined."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def dash_filter(
    df: DataFrame, categories: list[str] | None = None, countries: list[str] | None = None, groups: Groups = None
) -> DataFrame:
    """Keep the selected categories and countries, each only if something is selected and the column exists."""
    if categories and "skill" in df.columns:
        category = F.col("category") if "category" in df.columns else skill_category(F.col("skill"), groups)
        df = df.filter(category.isin(categories))
    if countries and "country" in df.columns:
        df = df.filter(F.col("country").isin(countries))
    return df


def skill_totals(top: DataFrame) -> DataFrame:
    """Sum of counts and mean of the per-country salaries."""
    return top.groupBy("skill").agg(F.sum("job_count").alias("job_count"), F.avg("avg_salary").alias("avg_salary"))


def dash_skill_totals(top: DataFrame, n: int = 20, by: str = "job_count", groups: Groups = None) -> DataFrame:
    return top_k(skill_totals(top), n, by, "skill").withColumn("category", skill_category(F.col("skill"), groups))


def dash_category_totals(by_category: DataFrame) -> DataFrame:
    totals = by_category.groupBy("category").agg(F.sum("job_count").alias("job_count"))
    return totals.orderBy(F.desc("job_count"), "category")


def _of_top_skills(df: DataFrame, k: int) -> DataFrame:
    """Rows of the *k* skills with the largest sums; the skill list has *k* rows and is broadcast."""
    totals = df.groupBy("skill").agg(F.sum("job_count").alias("_total"))
    return df.join(F.broadcast(top_k(totals, k, "_total", "skill").select("skill")), "skill", "left_semi")


def dash_trend_topk(trends: DataFrame, k: int = 8) -> DataFrame:
    weekly = trends.groupBy("skill", "week").agg(F.sum("job_count").alias("job_count"))
    return _of_top_skills(weekly, k).select("skill", "week", "job_count")


def dash_country_topk(top: DataFrame, k: int = 15) -> DataFrame:
    sums = top.groupBy("country", "skill").agg(F.sum("job_count").alias("job_count"))
    return _of_top_skills(sums, k).select("country", "skill", "job_count")


def dash_trend_compare(trends: DataFrame, skills: list[str]) -> DataFrame:
    return trends.filter(F.col("skill").isin(skills)).groupBy("skill", "week").agg(
        F.sum("job_count").alias("job_count"), F.avg("avg_salary").alias("avg_salary")
    )


def dash_salary_country(salaries: DataFrame, countries: list[str] | None = None) -> DataFrame:
    return dash_filter(salaries, countries=countries).orderBy("avg_salary", "country")


def dash_salary_box(top: DataFrame, k: int = 15) -> DataFrame:
    """Quartiles over countries of the salaries of the top skills; a skill has one row per country."""
    paid = top.filter(F.col("avg_salary") > 0)
    box = _of_top_skills(paid, k).groupBy("skill").agg(F.percentile("avg_salary", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("q"))
    names = ("min_salary", "q1_salary", "median_salary", "q3_salary", "max_salary")
    return box.select("skill", *[F.col("q")[i].alias(name) for i, name in enumerate(names)])


def dash_emerging_kpi(emerging: DataFrame) -> DataFrame:
    """Number of hot or rising skills, largest growth, and the skill that has it."""
    hot = F.count(F.when(F.col("trend_status").isin("Hot", "Rising"), F.lit(1)))
    leader = F.max(F.struct(F.col("growth_pct"), F.col("current_jobs"), F.col("skill"))).alias("_leader")
    return emerging.agg(hot.alias("emerging_skills"), F.max("growth_pct").alias("highest_growth"), leader).select(
        "emerging_skills", "highest_growth", F.col("_leader.skill").alias("top_emerging")
    )


def dash_emerging_table(emerging: DataFrame) -> DataFrame:
    return emerging.select(
        "skill", "current_jobs", "prev_jobs", "growth_pct", fmt_salary(F.col("avg_salary")).alias("avg_salary"),
        "trend_status",
    )


def dash_kpi_cards(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        fmt_number(F.col("total_jobs")).alias("total_jobs"), fmt_number(F.col("unique_skills")).alias("unique_skills"),
        fmt_salary(F.col("avg_salary")).alias("avg_salary"), F.col("countries"),
    )


def _both_sides(pairs: DataFrame) -> DataFrame:
    """Each pair from either side: (skill, other, count). One scan, two rows per pair."""
    sides = F.array(
        F.struct(F.col("skill_a").alias("skill"), F.col("skill_b").alias("other")),
        F.struct(F.col("skill_b").alias("skill"), F.col("skill_a").alias("other")),
    )
    return pairs.select(F.inline(sides), F.col("cooccurrence_count"))


def dash_cooc_long(
    pairs: DataFrame, n: int = 15, top_pairs: int | None = None, categories: list[str] | None = None, groups: Groups = None
) -> DataFrame:
    """The symmetric matrix of the *n* skills with the most co-occurrences, in long form with zeros.

    *top_pairs* restricts the totals and the cells to that many of the largest pairs. The pairs are read three times, so
    they are written first.
    """
    pairs = stored(pairs, "pairs")
    used = pairs if top_pairs is None else top_k(pairs, top_pairs, "cooccurrence_count", "skill_a", "skill_b")
    if categories:
        a, b = skill_category(F.col("skill_a"), groups), skill_category(F.col("skill_b"), groups)
        used = used.filter(a.isin(categories) & b.isin(categories))
    sides = _both_sides(used)
    totals = sides.groupBy("skill").agg(F.sum("cooccurrence_count").alias("_total"))
    shown = top_k(totals, n, "_total", "skill").agg(F.array_sort(F.collect_list("skill")).alias("names")).scalar()
    cells = sides.filter(F.array_contains(shown, F.col("skill")) & F.array_contains(shown, F.col("other")))
    zeros = totals.filter(F.array_contains(shown, F.col("skill"))).select(
        "skill", F.explode(shown).alias("other"), F.lit(0).cast("long").alias("cooccurrence_count")
    )
    return cells.unionByName(zeros).groupBy("skill", "other").agg(F.sum("cooccurrence_count").alias("cooccurrence_count"))


def dash_cooc_matrix(
    pairs: DataFrame, n: int = 15, top_pairs: int | None = None, categories: list[str] | None = None, groups: Groups = None
) -> DataFrame:
    """One row and one column per skill. The columns are data, so the long form is written before it is turned."""
    long = stored(dash_cooc_long(pairs, n, top_pairs, categories, groups), "cooc")
    return long.groupBy("skill").pivot("other").agg(F.sum("cooccurrence_count")).na.fill(0)


def dash_top_pairs(
    pairs: DataFrame, n: int = 25, categories: list[str] | None = None, groups: Groups = None
) -> DataFrame:
    """Largest pairs with a side in the selected categories."""
    if categories:
        a, b = skill_category(F.col("skill_a"), groups), skill_category(F.col("skill_b"), groups)
        pairs = pairs.filter(a.isin(categories) | b.isin(categories))
    top = top_k(pairs, n, "cooccurrence_count", "skill_a", "skill_b")
    return top.withColumn("pair", F.concat_ws(" + ", "skill_a", "skill_b"))


def dash_cluster_counts(clusters: DataFrame) -> DataFrame:
    label = F.concat(F.lit("Cluster "), F.col("cluster").cast("string")).alias("cluster")
    return clusters.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def dash_cluster_members(clusters: DataFrame, cluster: int | None = None, groups: Groups = None) -> DataFrame:
    chosen = clusters if cluster is None else clusters.filter(F.col("cluster") == cluster)
    return chosen.select("cluster", "skill", skill_category(F.col("skill"), groups).alias("category"))


def dash_metrics(metrics: DataFrame) -> DataFrame:
    """Model metrics as cards: (model, metric, value, shown)."""
    digits = F.when(F.col("metric").endswith("r2_mean"), fixed(F.col("value"), 3)).when(
        F.col("metric") == "anomaly_threshold", F.format_string("%.2e", "value")
    )
    counts = F.when(F.col("metric").startswith("n_"), fmt_number(F.col("value")))
    return metrics.withColumn("shown", F.coalesce(digits, counts, fixed(F.col("value"), 2)))
