"""Exact discrete quantiles per group without holding a group in memory."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.plans.store import stored


#: The largest finite double.
_MAX = 1.7976931348623157e308


def _part(v: Column, low: Column, high: Column, bins: int) -> Column:
    """Which of *bins* equal parts of a range holds a value; infinities are parts of their own.

    The least and the greatest value of a range are never in one part, so every pass shrinks it.
    """
    low, high = F.greatest(low, F.lit(-_MAX)), F.least(high, F.lit(_MAX))
    wide = (high - low) > F.lit(_MAX)
    share = F.when(wide, F.try_divide(v / 2 - low / 2, high / 2 - low / 2)).otherwise(F.try_divide(v - low, high - low))
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(bins)), F.lit(bins - 1))
    return F.when(v < -_MAX, F.lit(-1)).when(v > _MAX, F.lit(bins)).otherwise(inside)


def quantiles_disc(df: DataFrame, keys: list[str], value: str, fractions: dict[str, str], bins: int = 4096) -> DataFrame:
    """One row per group with a column per fraction: the smallest value whose rank reaches ``ceil(p * n)``.

    Each wanted rank has a range of values that holds it, at first the whole range of its group. A pass counts the
    values of each range in *bins* equal parts, which combines on the map side to at most *bins* rows per rank, and
    the range becomes that between the smallest and the largest value of the part that holds the rank. This goes on
    until a range is one value, a few passes for any distribution: no task holds a group, a part or its distinct
    values. Keys and values are written once, for all passes. Ranges are
    written out, so their size is known and a small table of them is broadcast.
    """
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    values = stored(df.filter(known).select(*keys, F.col(value).cast("double").alias("_v")), "quantile_values")
    wanted = F.array(*[
        F.struct(
            F.lit(name).alias("_name"),
            F.greatest(F.ceil(F.col("_n") * F.lit(Decimal(p))).cast("long"), F.lit(1)).alias("_rank"),
        )
        for name, p in fractions.items()
    ])
    groups = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    ranges = stored(groups.select(*keys, F.inline(wanted), "_low", "_high"), "quantile_ranges")
    done = ranges.filter("_low = _high")
    place = [*keys, "_name"]
    while not (open_ranges := ranges.filter("_low < _high")).isEmpty():
        part = _part(F.col("_v"), F.col("_low"), F.col("_high"), bins)
        counted = (
            values.join(open_ranges, keys).filter(F.col("_v").between(F.col("_low"), F.col("_high")))
            .groupBy(*place, "_rank", part.alias("_part"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
            .withColumn("_upto", F.sum("_n").over(Window.partitionBy(*place).orderBy("_part")))
        )
        holds = (F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n"))
        left = (F.col("_rank") - (F.col("_upto") - F.col("_n"))).alias("_rank")
        ranges = stored(counted.filter(holds).select(*place, left, "_low", "_high"), "quantile_ranges")
        done = done.unionByName(ranges.filter("_low = _high"))
    return done.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_name") == name, F.col("_low"))).alias(name) for name in fractions]
    )
