"""Skill co-occurrence within postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of different skills that share *keys*, with the product of their row counts."""
    b = right.select(*keys, F.col("skill").alias("skill_b"), F.col("_n").alias("_m"))
    a = left.select(*keys, F.col("skill").alias("skill_a"), F.col("_n"))
    return (
        a.join(b, keys).filter(F.col("skill_a") < F.col("skill_b"))
        .select("skill_a", "skill_b", (F.col("_n") * F.col("_m")).alias("_pairs"))
    )


def cooccurrence_selfjoin(df: DataFrame, wide_job: int = 1024, block: int = 256) -> DataFrame:
    """How often two skills meet in a posting, over all pairs.

    Rows are counted per posting and skill first, so a posting that holds a large share of the table shrinks to
    its distinct skills, and repeated skills become a weight instead of repeated pairs. Postings with more than
    *wide_job* distinct skills are joined block by block: each left row goes to one block of about *block*
    skills, the right rows to every block, so one posting spreads over many tasks. The pair counts combine on the
    map side before their shuffle.
    """
    weights = (
        df.filter(F.col("skill").isNotNull() & F.col("job_id").isNotNull())
        .groupBy("job_id", "skill").agg(F.count(F.lit(1)).alias("_n"))
    )
    # Counting through _n keeps the column, so this branch reads the same shuffle as the join.
    wide = (
        weights.groupBy("job_id").agg(F.count_if(F.col("_n") > 0).alias("_k")).filter(F.col("_k") > wide_job)
        .select("job_id", F.ceil(F.col("_k") / block).cast("int").alias("_blocks"))
    )
    narrow = weights.join(wide, "job_id", "left_anti")
    spread = weights.join(wide, "job_id")
    left = spread.withColumn("_block", F.pmod(F.xxhash64("skill"), F.col("_blocks")).cast("int"))
    right = spread.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pairs = _joined(narrow, narrow, ["job_id"]).unionAll(_joined(left, right, ["job_id", "_block"]))
    return pairs.groupBy("skill_a", "skill_b").agg(F.sum("_pairs").alias("cooccurrence_count"))


def vw_skill_cooccurrence(df: DataFrame, min_count: int = 3) -> DataFrame:
    return cooccurrence_selfjoin(df).filter(F.col("cooccurrence_count") >= min_count)
