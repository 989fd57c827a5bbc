"""Training of all models, their metrics and their storage."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.ml.clusters import train_clusters
from jobtide.ml.boosting import BoostedTrees, DemandParams
from jobtide.ml.demand import feature_importance_top10, train_and_validate
from jobtide.ml.isoforest import ForestParams, IsolationForestModel, emergence_metrics, train_emergence
from jobtide.operators.features import FEATURES


@dataclass
class TrainedModels:
    demand: BoostedTrees
    forest: IsolationForestModel
    clusters: DataFrame
    metrics: DataFrame
    fold_errors: DataFrame
    importance: DataFrame


def model_metrics(matrix: DataFrame, demand: DataFrame, emergence: DataFrame, clusters: DataFrame) -> DataFrame:
    """(model, metric, value) of all models and of the training table."""

    def labelled(df: DataFrame, model: str) -> DataFrame:
        return df.select(F.lit(model).alias("model"), "metric", F.col("value").cast("double").alias("value"))

    counts = matrix.agg(
        F.count(F.lit(1)).cast("double").alias("n_samples"), F.countDistinct("skill").cast("double").alias("n_skills"),
        F.lit(float(len(FEATURES))).alias("n_features"),
    )
    groups = clusters.agg(F.countDistinct("cluster").cast("double").alias("n_clusters"))
    return (
        labelled(demand, "demand_model").unionAll(labelled(emergence, "emergence_model"))
        .unionAll(labelled(groups.unpivot([], ["n_clusters"], "metric", "value"), "cluster_model"))
        .unionAll(labelled(counts.unpivot([], list(counts.columns), "metric", "value"), "training"))
    )


def train_all(
    matrix: DataFrame, demand: DemandParams = DemandParams(), forest: ForestParams = ForestParams(), k: int = 8,
    folds: int = 5, starts: int = 10,
) -> TrainedModels:
    """Fit the three models on a stored feature matrix with its target."""
    model, fold_errors, scores = train_and_validate(matrix, demand, folds)
    outliers = train_emergence(matrix, forest)
    clusters = train_clusters(matrix, k, starts)
    metrics = model_metrics(matrix, scores, emergence_metrics(outliers, matrix), clusters)
    return TrainedModels(model, outliers, clusters, metrics, fold_errors, feature_importance_top10(model, matrix))


def save_models(models: TrainedModels, folder: str) -> None:
    """Write every part below *folder*, replacing what is there."""
    models.demand.save(models.clusters.sparkSession, f"{folder}/demand")
    models.forest.nodes.write.mode("overwrite").parquet(f"{folder}/forest_nodes")
    settings = asdict(models.forest.params) | {"threshold": models.forest.threshold}
    spark = models.clusters.sparkSession
    schema = (
        "trees int, sample int, contamination double, seed int, features array<string>, threshold double"
    )
    row = tuple(settings[name] if name != "features" else list(settings[name]) for name in
                ("trees", "sample", "contamination", "seed", "features", "threshold"))
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{folder}/forest_settings")
    models.clusters.write.mode("overwrite").parquet(f"{folder}/clusters")
    models.metrics.write.mode("overwrite").parquet(f"{folder}/metrics")
    models.fold_errors.write.mode("overwrite").parquet(f"{folder}/fold_errors")
    models.importance.write.mode("overwrite").parquet(f"{folder}/importance")


def load_models(spark: SparkSession, folder: str) -> TrainedModels:
    settings = spark.read.parquet(f"{folder}/forest_settings").first()
    params = ForestParams(
        settings["trees"], settings["sample"], settings["contamination"], settings["seed"], tuple(settings["features"])
    )
    forest = IsolationForestModel(spark.read.parquet(f"{folder}/forest_nodes"), params, settings["threshold"])
    return TrainedModels(
        BoostedTrees.load(spark, f"{folder}/demand"), forest, spark.read.parquet(f"{folder}/clusters"),
        spark.read.parquet(f"{folder}/metrics"), spark.read.parquet(f"{folder}/fold_errors"),
        spark.read.parquet(f"{folder}/importance"),
    )
