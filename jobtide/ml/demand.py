"""Demand forecasting with gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.ml.boosting import BoostedTrees, DemandParams, fit_boosted
from jobtide.operators.features import FEATURES
from jobtide.plans.store import stored


def _vector_stages(columns: Sequence[str] = FEATURES) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def scale_features(matrix: DataFrame, columns: Sequence[str] = FEATURES) -> PipelineModel:
    """Fitted z-score scaling of the feature columns into ``features``."""
    return Pipeline(stages=_vector_stages(columns)).fit(matrix)


def encode_skill(matrix: DataFrame) -> DataFrame:
    """``skill_encoded``: position of the skill in name order."""
    indexer = StringIndexer(inputCol="skill", outputCol="skill_encoded", stringOrderType="alphabetAsc")
    return indexer.fit(matrix).transform(matrix)


def train_demand(
    matrix: DataFrame, params: DemandParams = DemandParams(), columns: Sequence[str] = FEATURES
) -> BoostedTrees:
    """Boosted trees fitted on the matrix and its ``target``. Splits depend on the order of values only, so nothing is scaled."""
    return fit_boosted(matrix, columns, "target", params)[0]


def _ordinals(matrix: DataFrame, chronological: bool) -> DataFrame:
    """Add ``_position``, which the folds split: the rank of the week, or of the row in skill order.

    The week ranks come from the distinct weeks, one row per Monday. The row ranks add the row number within the
    skill to the number of rows of the skills before it; only the per-skill counts share a window.
    """
    if chronological:
        weeks = matrix.select("week").distinct()
        ranked = weeks.withColumn("_position", F.row_number().over(Window.orderBy("week")) - 1)
        return matrix.join(F.broadcast(ranked), "week")
    order = [c for c in ("week", "country") if c in matrix.columns]
    counts = matrix.groupBy("skill").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("skill").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("skill", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = matrix.withColumn("_row", F.row_number().over(Window.partitionBy("skill").orderBy(*order)))
    return numbered.join(offsets, "skill").withColumn("_position", F.col("_before") + F.col("_row") - 1)


def fold_bounds(placed: DataFrame, folds: int) -> list[tuple[int, int]]:
    """Start and end of the validation positions of each fold; training takes all positions before the start."""
    total = placed.agg(F.max("_position")).first()[0] + 1
    size = total // (folds + 1)
    if size == 0:
        raise ValueError(f"{total} positions are too few for {folds} folds")
    return [(total - (folds - i) * size, total - (folds - i - 1) * size) for i in range(folds)]


def time_folds(matrix: DataFrame, folds: int = 5, chronological: bool = True) -> list[tuple[DataFrame, DataFrame]]:
    """Expanding (training, validation) splits; validation parts have equal length at the end of the order."""
    placed = _ordinals(matrix, chronological)
    splits = []
    for start, end in fold_bounds(placed, folds):
        train = placed.filter(F.col("_position") < start)
        valid = placed.filter((F.col("_position") >= start) & (F.col("_position") < end))
        splits.append((train.drop("_position"), valid.drop("_position")))
    return splits


def regression_errors(scored: DataFrame, *keys: str) -> DataFrame:
    """One row of MAE, RMSE and R² (per *keys*, if any)."""
    error = F.col("predicted") - F.col("target")
    spread = F.var_pop("target")
    mse = F.avg(error * error)
    return scored.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(mse).alias("rmse"), (F.lit(1.0) - F.try_divide(mse, spread)).alias("r2")
    )


def train_and_validate(
    matrix: DataFrame, params: DemandParams = DemandParams(), folds: int = 5, chronological: bool = True,
    columns: Sequence[str] = FEATURES,
) -> tuple[BoostedTrees, DataFrame, DataFrame]:
    """The model over all rows, (fold, mae, rmse, r2), and their summary as (metric, value).

    The folds' training rows are prefixes of one order, so all fits and the last one share every pass over the matrix; the
    validation parts are scored together, each row by the model of its fold.
    """
    placed = stored(_ordinals(matrix, chronological), "placed")
    bounds = fold_bounds(placed, folds)
    before = [F.col("_position") < start for start, _ in bounds]
    final, *models = fit_boosted(placed, columns, "target", params, [F.lit(True), *before])
    parts = []
    for fold, ((start, end), model) in enumerate(zip(bounds, models)):
        valid = placed.filter((F.col("_position") >= start) & (F.col("_position") < end))
        parts.append(model.transform(valid).select(F.lit(fold).alias("fold"), "target", "predicted"))
    errors = stored(regression_errors(reduce(DataFrame.unionAll, parts), "fold"), "fold-errors")
    summary = errors.agg(
        F.avg("mae").alias("cv_mae_mean"), F.stddev_pop("mae").alias("cv_mae_std"), F.avg("rmse").alias("cv_rmse_mean"),
        F.avg("r2").alias("cv_r2_mean"),
    )
    return final, errors, summary.unpivot([], list(summary.columns), "metric", "value")


def cv_time_series(
    matrix: DataFrame, params: DemandParams = DemandParams(), folds: int = 5, chronological: bool = True,
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """Cross-validated (metric, value) rows. *chronological* off splits the skill-sorted rows instead of the weeks."""
    return train_and_validate(matrix, params, folds, chronological, columns)[2]


def feature_importance_top10(model: BoostedTrees, df: DataFrame, n: int = 10) -> DataFrame:
    """(rank, feature, importance) of the strongest inputs: their mean gain per split, as a share of all columns' gains."""
    ranked = sorted(model.importance().items(), key=lambda p: (-p[1], p[0]))
    rows = [(i + 1, name, float(value)) for i, (name, value) in enumerate(ranked[:n])]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")
