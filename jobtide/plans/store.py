"""Written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobtide.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write *df* below the shared scratch folder and read it back.

    For results that several branches read: the lineage is cut, a lost executor costs nothing upstream, columns
    are pruned per branch, and the size is known to the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
