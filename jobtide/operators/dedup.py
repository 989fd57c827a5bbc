"""Duplicate removal that keeps a determined row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

_RANK, _TIE = "_rank", "_tie"


def _first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. Spark limits each key to one row per task before the shuffle, so a hot key stays small."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_latest(df: DataFrame, key: str = "job_id", tie: str | None = None) -> DataFrame:
    """Newest row per key by ``ingested_at``, else ``posted_date``; equal times fall back to *tie*, or a hash of the row."""
    order = []
    for candidate in ("ingested_at", "posted_date"):
        if candidate in df.columns:
            order.append(F.col(candidate).desc_nulls_last())
            break
    tied = df.withColumn(_TIE, F.col(tie) if tie else F.xxhash64(*[F.col(c) for c in df.columns if c != "row_version"]))
    return _first_per_key(tied, [key], order + [F.col(_TIE)]).drop(_TIE)


def newer_than(df: DataFrame, known: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows newer than the *known* version of their key: by ``ingested_at``, missing ones last, then by the lower ``row_version``.

    ``earlier`` is the ``place`` of the known version, NULL where there is none. A key has one row on either side.
    """
    seen = known.select(
        F.col(key), F.col("ingested_at").alias("_seen_at"), F.col("row_version").alias("_seen_version"), F.col("place").alias("earlier")
    )
    at, seen_at = F.col("ingested_at"), F.col("_seen_at")
    later = (at > seen_at) | (at.isNotNull() & seen_at.isNull())
    lower = at.eqNullSafe(seen_at) & (F.col("row_version") < F.col("_seen_version"))
    joined = df.join(seen, key, "left").filter(F.col("_seen_version").isNull() | later | lower)
    return joined.drop("_seen_at", "_seen_version")


def dedup_first_seen(df: DataFrame, position: list[str], key: str = "job_id") -> DataFrame:
    """First occurrence per key in the order of collection given by *position*."""
    return _first_per_key(df, [key], [F.col(c).asc() for c in position])


def dedup_pairs(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(["skill_a", "skill_b"])
