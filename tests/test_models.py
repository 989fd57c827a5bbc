import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.ml import clusters, demand, embeddings, inference, isoforest
from jobtide.operators import features
from jobtide.plans import training
from jobtide.plans.registered import models as registered


@pytest.fixture(scope="module")
def matrix(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(12):
        level, slope = 20 + 10 * s, rng.uniform(-1, 2)
        for w in range(40):
            count = max(int(level + slope * w + rng.normal(0, 3)), 1)
            rows.append((f"s{s:02d}", w, count, float(rng.uniform(6e4, 1.8e5))))
    weekly = spark.createDataFrame(rows, "skill string, w int, job_count long, avg_salary double").select(
        "skill", F.date_add(F.lit("2024-01-01").cast("date"), F.col("w") * 7).alias("week"), "job_count", "avg_salary"
    )
    path = str(tmp_path_factory.mktemp("matrix"))
    features.feature_matrix(weekly, ("skill",)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def models(matrix):
    return training.train_all(matrix, demand.DemandParams(max_iter=5, step_size=0.3), k=8, folds=3, starts=2)


def test_metrics_are_complete(models, matrix):
    metrics = {(r.model, r.metric): r.value for r in models.metrics.collect()}
    assert all(np.isfinite(v) for v in metrics.values())
    assert metrics["cluster_model", "n_clusters"] == 8 and metrics["training", "n_skills"] == 12
    assert metrics["training", "n_samples"] == matrix.count() and metrics["training", "n_features"] == 32
    assert models.importance.count() == 10


def test_forecast_follows_level(models, matrix):
    scored = models.demand.transform(matrix)
    r2 = demand.regression_errors(scored).first().r2
    assert r2 > 0.5


def test_outlier_share(models, matrix):
    share = models.forest.score(matrix).agg(F.avg(F.col("is_outlier").cast("int"))).first()[0]
    assert abs(share - 0.1) < 0.02


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, rng.normal(0, 1, 3))) for i in range(2000)] + [(10_000 + i, 9.0, -9.0, 9.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    model = isoforest.train_emergence(df, isoforest.ForestParams(trees=50, contamination=0.01, features=("a", "b", "c")))
    top = model.score(df).orderBy(F.desc("anomaly_score")).limit(10).collect()
    assert all(r.id >= 10_000 for r in top)


def test_samples_are_bounded_and_repeatable(spark):
    df = spark.range(20_000).select(F.col("id"), F.rand(1).alias("a"))
    params = isoforest.ForestParams(trees=7, sample=64, features=("a",))
    sizes = {r.tree: r["count"] for r in isoforest.draw_samples(df, params).groupBy("tree").count().collect()}
    assert sizes == {t: 64 for t in range(7)}
    first, again = (sorted(map(str, isoforest.draw_samples(d, params).collect())) for d in (df, df.repartition(9)))
    assert first == again


def test_clusters_cover_all_skills(models):
    assert models.clusters.count() == 12
    profiles = clusters.cluster_profiles(models.clusters).collect()
    assert sum(r["count"] for r in profiles) == 12 and all(len(r.skills) == r["count"] for r in profiles)


def test_save_and_load(spark, models, matrix, tmp_path):
    training.save_models(models, str(tmp_path))
    loaded = training.load_models(spark, str(tmp_path))
    key = lambda m: sorted((r.skill, str(r.week), round(r.demand_forecast, 9), round(r.emergence_score_model, 12)) for r in inference.batch_score(m.demand, m.forest, matrix).collect())
    assert key(models) == key(loaded) and loaded.clusters.count() == 12


def test_inference(spark, models, matrix):
    latest = features.latest_per_skill(matrix).withColumns({"job_count": F.lit(30), "avg_salary": F.lit(1000.0)})
    forecast = inference.forecast_demand(models.demand, latest, top_n=5)
    rows = forecast.collect()
    assert len(rows) == 5 and all(r.demand_change == r.predicted_demand - r.current_demand for r in rows)
    assert [r.growth_pct for r in rows] == sorted((r.growth_pct for r in rows), reverse=True)
    named = inference.forecast_demand(models.demand, latest, skills=["s01", "s02"])
    assert {r.skill for r in named.collect()} == {"s01", "s02"}
    known = models.clusters.first()
    recommended = inference.recommend_skills(models.clusters, forecast, [known.skill.upper()], 3).collect()
    assert all(r.cluster == known.cluster and r.skill != known.skill for r in recommended)
    report = inference.market_report(forecast, inference.detect_emerging_batch(models.forest, matrix, 5))
    summary = report["market_summary"].first()
    assert summary.total_skills_tracked == 5 and set(report) == {
        "market_summary", "top_demand_skills", "fastest_growing_skills", "emerging_skills", "highest_paying_skills"
    }


def test_folds_expand_in_time(matrix):
    folds = demand.time_folds(matrix, 3)
    for train, valid in folds:
        assert train.agg(F.max("week")).first()[0] < valid.agg(F.min("week")).first()[0]
    counts = [train.count() for train, _ in folds]
    assert counts == sorted(counts)


def test_embeddings(spark):
    sentences = [(["a", "b", "c"],)] * 30 + [(["x", "y"],)] * 30 + [(["once"],)]
    vectors = embeddings.skill2vec(spark.createDataFrame(sentences, "skills array<string>"), vector_size=8, epochs=3)
    rows = {r.skill: r.vector for r in vectors.collect()}
    assert set(rows) == {"a", "b", "c", "x", "y"} and all(len(v) == 8 for v in rows.values())
    nearest = embeddings.most_similar(vectors, "a", 3).collect()
    cosine = lambda u, v: float(np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v) + 1e-9))
    expected = sorted(((cosine(rows["a"], v), s) for s, v in rows.items() if s != "a"), reverse=True)[:3]
    assert [r.skill for r in nearest] == [s for _, s in expected]
    assert embeddings.most_similar(vectors, "unknown").collect() == []


def test_registered_models_are_not_cut(spark, monkeypatch, tmp_path):
    """The registered queries train with the library's own parameters and return every table and vector."""
    calls = []
    for table in ("lineitem", "part", "orders", "customer", "nation"):
        (tmp_path / f"{table}.parquet").mkdir()

    def recorder(name, result=None):
        def record(first, *args, **kwargs):
            calls.append((name, args, kwargs))
            return result

        return record

    frame = spark.createDataFrame([("s1", 1)], "skill string, cluster int")
    trained = training.TrainedModels(None, None, frame, frame, frame, frame)
    monkeypatch.setattr(registered, "matrix", lambda spark, sf: "matrix")
    monkeypatch.setattr(training, "train_all", recorder("train_all", trained))
    monkeypatch.setattr(embeddings, "skill2vec", recorder("skill2vec", frame))
    monkeypatch.setattr(registered, "job_skill_sets", lambda spark, sf: "sets")
    assert registered._models(spark, str(tmp_path)) is registered._models(spark, str(tmp_path)) is trained
    assert registered.QUERIES["skill2vec"](spark, "sf") is frame
    assert calls == [("train_all", (), {}), ("skill2vec", (), {})]
    part = tmp_path / "lineitem.parquet" / "part-0.parquet"  # changed data are not answered from the old models
    part.write_bytes(b"changed")
    registered._models(spark, str(tmp_path))
    assert [name for name, _, _ in calls].count("train_all") == 2


def test_report_has_five_tables(spark):
    forecast = spark.createDataFrame(
        [("s1", 20, 25, 9e4, 25.0), ("s2", 30, 15, 8e4, -50.0)],
        "skill string, current_demand long, predicted_demand long, current_salary double, growth_pct double",
    )
    emerging = spark.createDataFrame([("s1", 20, 0.9, 12.0, 9e4)], "skill string, current_jobs long, emergence_score double, monthly_growth_pct double, avg_salary double")
    rows = registered._report_rows(inference.market_report(forecast, emerging)).collect()
    counts = {name: sum(r.report_table == name for r in rows) for name in {r.report_table for r in rows}}
    assert counts == {
        "market_summary": 1, "top_demand_skills": 2, "fastest_growing_skills": 2, "emerging_skills": 1, "highest_paying_skills": 2,
    }


def test_forest_of_few_and_of_close_values(spark):
    close = [(float(np.nextafter(1.0, 2.0)) if i % 2 else 1.0, 5e-324 * (i % 2)) for i in range(40)]
    df = spark.createDataFrame(close, "a double, b double")
    model = isoforest.train_emergence(df, isoforest.ForestParams(trees=10, features=("a", "b")))
    assert model.params.sample == 40 and model.score(df).count() == 40
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert isoforest.train_emergence(one, isoforest.ForestParams(trees=2, features=("a", "b"))).score(one).count() == 1
