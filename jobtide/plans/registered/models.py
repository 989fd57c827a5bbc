"""Models and their inference over weekly features per skill."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.ml import clusters as cl
from jobtide.ml import demand as dm
from jobtide.ml import embeddings, inference, isoforest
from jobtide.operators import dashboard as dash
from jobtide.operators import features, relations
from jobtide.operators.demand import vw_top_skills, weekly_demand
from jobtide.plans import training
from jobtide.plans.registered.common import BRAND_GROUPS, JOB_SKILLS_SQL, WEEKLY_SQL, category_sql, r, rounded
from jobtide.plans.registered.features import _latest_sql, _matrix_sql
from jobtide.plans.store import stored
from jobtide.session import scratch_path
from jobtide.sources.driver_tables import job_skill_sets, job_skills, skill_vectors

KNOWN = ["Brand#1", "Brand#7"]

#: Stored tables and fitted models by application, data, name and version of the data.
_BUILT: dict[tuple, object] = {}


def _version(spark, sf) -> int:
    """Changes with the files of the tables that the models read: their names, sizes and times."""
    seen = []
    for table in ("lineitem", "part", "orders", "customer", "nation"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{table}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            seen.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return hash(tuple(sorted(seen)))


def _once(spark, sf, name, build):
    """What several model queries read, built once per application and state of the data."""
    key = (spark.sparkContext.applicationId, sf, name, _version(spark, sf))
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def weekly(spark, sf):
    return _once(
        spark, sf, "weekly",
        lambda: stored(weekly_demand(job_skills(spark, sf), weeks=None, keys=("skill",)).drop("unique_jobs"), "weekly"),
    )


def matrix(spark, sf):
    return _once(spark, sf, "matrix", lambda: stored(features.feature_matrix(weekly(spark, sf), ("skill",)), "matrix"))


def _models(spark, sf):
    """All models at the library's parameters, fitted once for all queries that apply them."""
    return _once(spark, sf, "models", lambda: training.train_all(matrix(spark, sf)))


def _forecast(spark, sf, top_n=20):
    model = _models(spark, sf).demand
    return inference.forecast_demand(model, features.latest_features(job_skills(spark, sf)), top_n=top_n)


def _errors(spark, sf):
    naive = matrix(spark, sf).withColumn("predicted", F.col("job_count_lag_1w"))
    return rounded(dm.regression_errors(naive))


def _scaled(spark, sf):
    columns = ("job_count", "avg_salary")
    model = dm.scale_features(weekly(spark, sf), columns)
    z = vector_to_array("features")
    return rounded(model.transform(weekly(spark, sf)).select("skill", "week", z[0].alias("z_count"), z[1].alias("z_salary")))


def _fold_sizes(spark, sf, chronological):
    parts = []
    for i, (train, valid) in enumerate(dm.time_folds(weekly(spark, sf), 5, chronological)):
        for name, part in (("train", train), ("valid", valid)):
            parts.append(part.agg(F.lit(i).alias("fold"), F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def _clusters(spark, sf):
    """(skill in small letters, cluster) of the fitted clusters."""
    return _models(spark, sf).clusters.withColumn("skill", F.lower("skill"))


def _enriched(spark, sf):
    totals = dash.skill_totals(vw_top_skills(job_skills(spark, sf)))
    forecast = totals.select(
        F.lower("skill").alias("skill"), F.col("job_count").alias("current_demand"), F.lit(1.0).alias("growth_pct"),
        F.col("avg_salary").alias("current_salary"),
    )
    return rounded(relations.enrich_recommendations(relations.filter_known_skills(_clusters(spark, sf), KNOWN), forecast))


def _outliers(spark, sf):
    model = isoforest.train_emergence(matrix(spark, sf))
    return model.score(matrix(spark, sf)).select("skill", "week", "anomaly_score", "is_outlier")


def _folder(spark, sf):
    """The stored models."""
    def save():
        folder = scratch_path(spark, "models")
        training.save_models(_models(spark, sf), folder)
        return folder

    return _once(spark, sf, "folder", save)


def _loaded(spark, sf):
    models = training.load_models(spark, _folder(spark, sf))
    scored = inference.batch_score(models.demand, models.forest, matrix(spark, sf))
    return scored.select("skill", "week", "demand_forecast", "emergence_score_model")


def _scored(spark, sf):
    models = _models(spark, sf)
    scored = inference.batch_score(models.demand, models.forest, matrix(spark, sf))
    return scored.select("skill", "week", "demand_forecast", "emergence_score_model")


def _metrics(spark, sf):
    """The metrics table that was stored with the models."""
    return training.load_models(spark, _folder(spark, sf)).metrics


def _aligned(spark, sf):
    df = weekly(spark, sf).withColumn("avg_salary", F.when(F.col("avg_salary") > 50_000, F.col("avg_salary")))
    return rounded(inference.align_features(df, ("job_count", "avg_salary", "missing")))


def _recommended(spark, sf):
    forecast = _forecast(spark, sf, None).withColumn("skill", F.lower("skill"))
    return inference.recommend_skills(_clusters(spark, sf), stored(forecast, "forecast"), KNOWN)


def _emerging(spark, sf, **options):
    return inference.detect_emerging(_models(spark, sf).forest, features.inference_history(job_skills(spark, sf)), **options)


def _report(spark, sf):
    forecast = stored(_forecast(spark, sf, 50), "forecast")
    return _report_rows(inference.market_report(forecast, _emerging(spark, sf)))


def _report_rows(report: dict[str, DataFrame]) -> DataFrame:
    """All tables of the report under each other, with the table's name; what a table lacks is NULL."""
    result = None
    for name, part in report.items():
        part = part.drop("report_date").withColumn("report_table", F.lit(name))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


def _vectors(spark, sf):
    return embeddings.skill2vec(job_skill_sets(spark, sf))


def _predicted(spark, sf):
    return _models(spark, sf).demand.transform(matrix(spark, sf)).select("skill", "week", "target", "predicted")


def _finite(name):
    column = F.col(name)
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) < float("inf"))


def _all(condition):
    """Whether a condition holds on every row; true without rows."""
    return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True))


def _steps_down(column, *order):
    """Whether a column never rises along an order; for tables of a few rows."""
    return F.coalesce(F.lag(column).over(Window.orderBy(*order)) >= F.col(column), F.lit(True))


def _demand_facts(spark, sf):
    """Per skill: rows and targets of the training table, predictions all numbers, errors below those of the mean target."""
    scored = stored(_predicted(spark, sf), "predicted")
    overall = dm.regression_errors(scored).select(F.col("r2") > 0.0).scalar()
    return scored.groupBy("skill").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target").alias("targets"), _all(_finite("predicted")).alias("finite"),
        F.min("week").alias("first_week"), F.max("week").alias("last_week"),
    ).withColumn("better_than_mean", overall)


def _fold_facts(spark, sf):
    """Per fold: the errors are numbers, MAE is at most RMSE, R² at most 1; the summary is their mean."""
    models = _models(spark, sf)
    summary = models.metrics.where("model = 'demand_model' AND metric = 'cv_mae_mean'").select("value").scalar()
    errors = models.fold_errors
    mean = errors.agg(F.avg("mae")).scalar()
    return errors.select(
        "fold", (_finite("mae") & _finite("rmse") & _finite("r2")).alias("finite"), (F.col("mae") <= F.col("rmse") + 1e-12).alias("mae_below_rmse"),
        (F.col("r2") <= 1.0).alias("r2_at_most_1"), (F.abs(mean - summary) < 1e-9).alias("summary_is_mean"),
    )


def _importance_facts(spark, sf):
    """The ranks; shares between 0 and 1 that do not rise; names among the model's inputs."""
    top = _models(spark, sf).importance
    known = F.col("feature").isin(*features.FEATURES)
    return top.select("rank", F.col("importance").between(0, 1).alias("share"), _steps_down("importance", "rank").alias("ordered"), known.alias("known"))


def _outlier_facts(spark, sf):
    """Rows scored, outliers are the positive scores, and a tenth of the rows."""
    scored = _outliers(spark, sf)
    share = F.avg(F.col("is_outlier").cast("int"))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), _all(F.col("is_outlier") == (F.col("anomaly_score") > 0)).alias("by_sign"),
        _all(F.col("anomaly_score").between(-1, 1)).alias("in_range"), (F.abs(share - 0.1) < 0.02).alias("tenth"),
    )


def _stored_facts(spark, sf):
    """Per skill: rows of the training table, and the loaded models score them as the fitted ones do."""
    own = _scored(spark, sf).withColumnsRenamed({"demand_forecast": "d", "emergence_score_model": "e"})
    both = _loaded(spark, sf).join(own, ["skill", "week"])
    same = (F.abs(F.col("demand_forecast") - F.col("d")) < 1e-9) & (F.abs(F.col("emergence_score_model") - F.col("e")) < 1e-9)
    return both.groupBy("skill").agg(F.count(F.lit(1)).alias("rows"), _all(same).alias("same"))


def _forecast_facts(spark, sf):
    """The most wanted skills with their demand and salary; change and growth follow from the prediction."""
    growth = F.bround((F.try_divide(F.col("predicted_demand").cast("double"), F.col("current_demand")) - 1) * 100, 1)
    return rounded(_forecast(spark, sf).select(
        "skill", "current_demand", "current_salary", (F.col("demand_change") == F.col("predicted_demand") - F.col("current_demand")).alias("change"),
        F.coalesce(F.col("growth_pct") == growth, F.lit(False)).alias("growth"),
    ))


def _emerging_facts(spark, sf):
    """At most ten skills of the newest history, scores in range that do not rise, growth above the limit."""
    found = _emerging(spark, sf).withColumn("ordered", _steps_down("emergence_score", F.desc("emergence_score"), "skill"))
    known = weekly(spark, sf).select("skill").distinct()
    counted = found.join(known.withColumn("known", F.lit(True)), "skill", "left")
    return counted.agg(
        (F.count(F.lit(1)) <= 10).alias("at_most_10"), _all(F.col("emergence_score").between(0.8, 1)).alias("score"), _all(F.col("ordered")).alias("ordered"),
        _all(F.col("monthly_growth_pct") >= 10).alias("growing"), _all(F.col("known")).alias("known"),
    )


def _batch_facts(spark, sf):
    found = inference.detect_emerging_batch(_models(spark, sf).forest, matrix(spark, sf))
    return found.withColumn("ordered", _steps_down("anomaly_score", F.desc("anomaly_score"), "skill")).agg(
        (F.count(F.lit(1)) == 20).alias("twenty"), _all(F.col("mom_growth") > 0).alias("growing"), _all(F.col("ordered")).alias("ordered"),
        (F.countDistinct("skill") == F.count(F.lit(1))).alias("one_row_each"),
    )


def _recommended_facts(spark, sf):
    """Others of the known skills' clusters, five at most, by growth; no forecast counts as no growth."""
    mine = _clusters(spark, sf)
    mates = relations.filter_known_skills(mine, KNOWN).select("skill", F.lit(True).alias("mate"))
    found = _recommended(spark, sf).withColumn("growth", F.coalesce("growth_pct", F.lit(0.0)))
    least = found.agg(F.min("growth")).scalar()
    better = mates.join(_forecast(spark, sf, None).select(F.lower("skill").alias("skill"), "growth_pct"), "skill")
    left_out = better.join(found.select("skill"), "skill", "left_anti").agg(F.max("growth_pct")).scalar()
    return found.join(mates, "skill", "left").agg(
        (F.count(F.lit(1)) == F.least(F.lit(5), mates.agg(F.count(F.lit(1))).scalar())).alias("five_if_there_are"), _all(F.col("mate")).alias("mates"),
        _all(F.coalesce(left_out <= least, F.lit(True))).alias("best_growth"),
    )


def _report_facts(spark, sf):
    """The lists by demand and by salary, which follow from the newest week alone."""
    report = _report(spark, sf)
    lists = report.where(F.col("report_table").isin("top_demand_skills", "highest_paying_skills"))
    return rounded(lists.select("report_table", "skill", "current_demand", "current_salary"))


def _vector_facts(spark, sf):
    """Per skill: the length of its vector, all numbers, not all zero."""
    return _vectors(spark, sf).select(
        "skill", F.size("vector").alias("numbers"), F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6)).alias("finite"),
        F.exists("vector", lambda x: x != 0).alias("not_zero"),
    )


QUERIES = {
    "scale_features": _scaled,
    "encode_skill": lambda spark, sf: rounded(dm.encode_skill(weekly(spark, sf)).select("skill", "week", "skill_encoded")),
    "train_demand": _predicted,
    "train_demand_facts": _demand_facts,
    "cv_time_series": lambda spark, sf: _models(spark, sf).metrics.where("model = 'demand_model'").select("metric", "value"),
    "cv_time_series_facts": _fold_facts,
    "cv_fold_sizes": lambda spark, sf: _fold_sizes(spark, sf, True),
    "cv_fold_sizes_by_row": lambda spark, sf: _fold_sizes(spark, sf, False),
    "regression_errors": _errors,
    "feature_importance_top10": lambda spark, sf: _models(spark, sf).importance,
    "feature_importance_top10_facts": _importance_facts,
    "train_emergence": _outliers,
    "train_emergence_facts": _outlier_facts,
    "train_clusters": lambda spark, sf: cl.train_clusters(matrix(spark, sf)),
    "train_all": lambda spark, sf: _models(spark, sf).metrics,
    "save_models": _metrics,
    "load_models": _loaded,
    "load_models_facts": _stored_facts,
    "batch_score": _scored,
    "align_features": _aligned,
    "forecast_demand": _forecast,
    "forecast_demand_facts": _forecast_facts,
    "detect_emerging": _emerging,
    "detect_emerging_facts": _emerging_facts,
    "detect_emerging_batch": lambda spark, sf: inference.detect_emerging_batch(_models(spark, sf).forest, matrix(spark, sf)),
    "detect_emerging_batch_facts": _batch_facts,
    "filter_known_skills": lambda spark, sf: relations.filter_known_skills(_clusters(spark, sf), KNOWN),
    "enrich_recommendations": _enriched,
    "recommend_skills": _recommended,
    "recommend_skills_facts": _recommended_facts,
    "market_report": _report,
    "market_report_facts": _report_facts,
    "skill2vec": _vectors,
    "skill2vec_facts": _vector_facts,
    "most_similar": lambda spark, sf: rounded(embeddings.most_similar(skill_vectors(spark, sf), "3", 10)),
    "dash_cluster_counts": lambda spark, sf: dash.dash_cluster_counts(_clusters(spark, sf)),
    "dash_cluster_members": lambda spark, sf: dash.dash_cluster_members(
        _clusters(spark, sf), 1, {k: tuple(m.lower() for m in v) for k, v in BRAND_GROUPS.items()}
    ),
    "dash_metrics": lambda spark, sf: dash.dash_metrics(_metrics(spark, sf)),
    "dash_metrics_counts": lambda spark, sf: dash.dash_metrics(_metrics(spark, sf).where("metric LIKE 'n\\_%' AND metric <> 'n_emerging_detected'")),
}

#: The training table: the feature matrix of one series per skill, whose categories are all the same here.
_TRAINING_SQL = WEEKLY_SQL + """, wka AS (SELECT *, 'all' AS country FROM wk),
matrix AS (SELECT * FROM (SELECT * FROM (""" + _matrix_sql("wka", "'other'").replace(", f1 AS", "WITH f1 AS", 1) + """)))
"""


def _clusters_sql(k: int = 8, starts: int = 10, seed: int = 42, steps: int = 20) -> str:
    """The training table's clusters as CTE ``c`` (skill in small letters, cluster): all starts, every step written out."""
    columns = features.FEATURES
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    scaled = ", ".join(
        f"CASE WHEN stddev_samp({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0 END" for c in columns
    )
    parts = [
        f"profile AS (SELECT skill, {means} FROM matrix GROUP BY skill)",
        f"p AS MATERIALIZED (SELECT skill, [{scaled}] AS x FROM profile)",
        f"""k0 AS MATERIALIZED (
  SELECT start, row_number() OVER (PARTITION BY start ORDER BY md5(skill || ':' || start || ':{seed}'), skill) - 1 AS centre, x
  FROM p, range({starts}) t(start) QUALIFY centre < {k})""",
    ]
    near = """a{0} AS MATERIALIZED (
  SELECT start, skill, min([list_distance(p.x, c.x), CAST(centre AS DOUBLE)]) AS best FROM p, k{0} c GROUP BY ALL)"""
    for step in range(steps):
        parts.append(near.format(step))
        parts.append(f"""k{step + 1} AS MATERIALIZED (
  SELECT start, centre, coalesce(moved, c.x) AS x FROM k{step} c LEFT JOIN (
    SELECT start, centre, list(m ORDER BY pos) AS moved FROM (
      SELECT start, CAST(best[2] AS BIGINT) AS centre, pos, avg(v) AS m
      FROM (SELECT start, best, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS v FROM a{step} JOIN p USING (skill)) GROUP BY ALL)
    GROUP BY ALL) USING (start, centre))""")
    parts.append(near.format(steps))
    parts.append(f"best AS (SELECT start FROM a{steps} GROUP BY start ORDER BY round(sum(best[1] * best[1]), 9), start LIMIT 1)")
    parts.append(f"named AS (SELECT skill, CAST(best[2] AS INTEGER) AS cluster FROM a{steps} JOIN best USING (start))")
    parts.append("c AS (SELECT lower(skill) AS skill, cluster FROM named)")
    return ", " + ",\n".join(parts)


_CLUSTERS = _clusters_sql()
_UNKNOWN = """, u AS (
  SELECT skill, cluster FROM c WHERE skill NOT IN ('brand#1', 'brand#7')
    AND cluster IN (SELECT cluster FROM c WHERE skill IN ('brand#1', 'brand#7')))
"""


def _fold_sql(position: str) -> str:
    return WEEKLY_SQL + f""", o AS (SELECT {position} AS pos FROM wk),
n AS (SELECT max(pos) + 1 AS n, (max(pos) + 1) // 6 AS size FROM o),
f AS (SELECT CAST(i AS INTEGER) AS fold, n - (5 - i) * size AS start, size FROM n, range(5) t(i))
SELECT fold, 'train' AS part, count(*) AS rows FROM f, o WHERE pos < start GROUP BY fold
UNION ALL
SELECT fold, 'valid', count(*) FROM f, o WHERE pos >= start AND pos < start + size GROUP BY fold"""


SQL = {
    "scale_features": WEEKLY_SQL + f"""
SELECT skill, week, {r('(job_count - avg(job_count) OVER ()) / stddev_samp(job_count) OVER ()', 'z_count')},
       {r('(avg_salary - avg(avg_salary) OVER ()) / stddev_samp(avg_salary) OVER ()', 'z_salary')} FROM wk""",
    "encode_skill": WEEKLY_SQL + """
SELECT skill, week, CAST(dense_rank() OVER (ORDER BY skill) - 1 AS DOUBLE) AS skill_encoded FROM wk""",
    "cv_fold_sizes": _fold_sql("dense_rank() OVER (ORDER BY week) - 1"),
    "cv_fold_sizes_by_row": _fold_sql("row_number() OVER (ORDER BY skill, week) - 1"),
    "regression_errors": WEEKLY_SQL + f""", m AS (
  SELECT coalesce(lag(job_count, 1) OVER (PARTITION BY skill ORDER BY week), 0) AS p,
         lead(job_count, 4) OVER (PARTITION BY skill ORDER BY week) AS t FROM wk)
SELECT {r('avg(abs(p - t))', 'mae')}, {r('sqrt(avg((p - t) * (p - t)))', 'rmse')},
       {r('1 - avg((p - t) * (p - t)) / var_pop(t)', 'r2')} FROM m WHERE t IS NOT NULL""",
    "align_features": WEEKLY_SQL + f"""
SELECT skill, week, CAST(job_count AS DOUBLE) AS job_count,
       {r('CASE WHEN avg_salary > 50000 THEN avg_salary ELSE 0 END', 'avg_salary')}, CAST(0 AS DOUBLE) AS missing FROM wk""",
    "train_clusters": _TRAINING_SQL + _CLUSTERS + "SELECT skill, cluster FROM named",
    "filter_known_skills": _TRAINING_SQL + _CLUSTERS + _UNKNOWN + "SELECT * FROM u",
    "enrich_recommendations": _TRAINING_SQL + _CLUSTERS + _UNKNOWN + f""", t AS (
  SELECT skill, country, count(*) AS n, round(avg(salary_mid_usd), 0) AS s FROM jsv GROUP BY ALL),
f AS (SELECT lower(skill) AS skill, sum(n) AS n, avg(s) AS s FROM t GROUP BY lower(skill))
SELECT u.skill AS skill, cluster, CAST(n AS BIGINT) AS current_demand,
       CASE WHEN n IS NOT NULL THEN CAST(1 AS DOUBLE) END AS growth_pct, {r('s', 'salary')}
FROM u LEFT JOIN f ON u.skill = f.skill""",
    "most_similar": f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), t AS (SELECT v AS w FROM e WHERE vec_id = 3)
SELECT CAST(vec_id AS VARCHAR) AS skill,
  {r('list_dot_product(v, w) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(w, w)) + 1e-9)', 'similarity')}
FROM e, t WHERE vec_id <> 3 ORDER BY similarity DESC, skill LIMIT 10""",
    "dash_cluster_counts": _TRAINING_SQL + _CLUSTERS + """
SELECT 'Cluster ' || cluster AS cluster, count(*) AS count FROM c GROUP BY c.cluster""",
    "dash_cluster_members": _TRAINING_SQL + _CLUSTERS + f"""
SELECT cluster, skill, {category_sql('skill', {k: tuple(m.lower() for m in v) for k, v in BRAND_GROUPS.items()})} AS category
FROM c WHERE cluster = 1""",
    "dash_metrics_counts": _TRAINING_SQL + """, k AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT skill) AS DOUBLE) AS s FROM matrix)
SELECT 'training' AS model, 'n_samples' AS metric, n AS value,
       CASE WHEN n >= 1000 THEN printf('%.1fK', n / 1000) ELSE printf('%.0f', n) END AS shown FROM k
UNION ALL SELECT 'training', 'n_skills', s, printf('%.0f', s) FROM k
UNION ALL SELECT 'training', 'n_features', 32.0::DOUBLE, '32'
UNION ALL SELECT 'cluster_model', 'n_clusters', 8.0::DOUBLE, '8'""",
    "train_demand_facts": _TRAINING_SQL + """
SELECT skill, count(*) AS rows, sum(target) AS targets, TRUE AS finite, min(week) AS first_week, max(week) AS last_week,
       TRUE AS better_than_mean FROM matrix GROUP BY skill""",
    "cv_time_series_facts": """
SELECT CAST(i AS INTEGER) AS fold, TRUE AS finite, TRUE AS mae_below_rmse, TRUE AS r2_at_most_1, TRUE AS summary_is_mean
FROM range(5) t(i)""",
    "feature_importance_top10_facts": """
SELECT CAST(i AS INTEGER) AS rank, TRUE AS share, TRUE AS ordered, TRUE AS known FROM range(1, 11) t(i)""",
    "train_emergence_facts": _TRAINING_SQL + """
SELECT count(*) AS rows, TRUE AS by_sign, TRUE AS in_range, TRUE AS tenth FROM matrix""",
    "load_models_facts": _TRAINING_SQL + "SELECT skill, count(*) AS rows, TRUE AS same FROM matrix GROUP BY skill",
    "forecast_demand_facts": f"""
SELECT skill, job_count AS current_demand, avg_salary AS current_salary, TRUE AS change, TRUE AS growth
FROM ({_latest_sql(False)}) ORDER BY job_count DESC, skill LIMIT 20""",
    "detect_emerging_facts": "SELECT TRUE AS at_most_10, TRUE AS score, TRUE AS ordered, TRUE AS growing, TRUE AS known",
    "detect_emerging_batch_facts": "SELECT TRUE AS twenty, TRUE AS growing, TRUE AS ordered, TRUE AS one_row_each",
    "recommend_skills_facts": "SELECT TRUE AS five_if_there_are, TRUE AS mates, TRUE AS best_growth",
    "market_report_facts": f"""
WITH l AS (SELECT * FROM ({_latest_sql(False)}) ORDER BY job_count DESC, skill LIMIT 50)
SELECT * FROM (SELECT 'top_demand_skills' AS report_table, skill, job_count AS current_demand, CAST(NULL AS DOUBLE) AS current_salary
  FROM l ORDER BY job_count DESC, skill LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'highest_paying_skills', skill, job_count, avg_salary FROM l ORDER BY avg_salary DESC, skill LIMIT 10)""",
    "skill2vec_facts": JOB_SKILLS_SQL + """
SELECT skill, 64 AS numbers, TRUE AS finite, TRUE AS not_zero FROM jsv GROUP BY skill HAVING count(DISTINCT job_id) >= 2""",
}
