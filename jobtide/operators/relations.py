"""Joins and set operations between postings, skills and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.operators.normalize import impute_posted_date
from jobtide.plans.store import stored

JUNCTION = ("job_id", "posted_date", "salary_mid", "skill", "country", "year", "month")


def _trimmed_id(df: DataFrame) -> DataFrame:
    return df.withColumn("job_id", F.trim(F.col("job_id").cast("string")))


def join_skills_jobs(skills: DataFrame, jobs: DataFrame, country: str = "US", impute_dates: bool = False) -> DataFrame:
    """Junction of a skill list and its postings; the skills alone when no id is common.

    Whether any id is common is one semi-join over the ids alone; the choice falls once for the table, not per row.
    """
    named = _trimmed_id(skills.select("job_id", "skill").filter(F.col("skill").isNotNull()))
    dated = _trimmed_id(jobs.select("job_id", "posted_date", "salary_mid", "year", "month"))
    if named.join(dated, "job_id", "left_semi").isEmpty():
        alone = named.withColumns({"posted_date": F.lit(None).cast("date"), "salary_mid": F.lit(None).cast("double")})
        if impute_dates:
            alone = impute_posted_date(alone, days=730)
        joined = alone.withColumns({"year": F.year("posted_date"), "month": F.month("posted_date")})
    else:
        joined = named.join(dated, "job_id")
    return joined.withColumn("country", F.lit(country)).select(*JUNCTION)


def key_overlap(left: DataFrame, right: DataFrame, key: str = "job_id") -> DataFrame:
    """Distinct keys on the left, on the right and on both sides.

    Each side is reduced to one row per key and side before the shuffle; no join is needed.
    """

    def side(df: DataFrame, bit: int) -> DataFrame:
        return df.select(F.trim(F.col(key).cast("string")).alias("k"), F.lit(bit).alias("side"))

    both = side(left, 1).unionAll(side(right, 2)).filter(F.col("k").isNotNull())
    seen = both.groupBy("k").agg(F.bit_or("side").alias("sides"))

    def counted(test: Column) -> Column:
        return F.count(F.when(test, F.lit(1)))

    return seen.agg(
        counted(F.col("sides") != 2).alias("left_keys"),
        counted(F.col("sides") != 1).alias("right_keys"),
        counted(F.col("sides") == 3).alias("common_keys"),
    )


def _grams(column: str, sizes: Column) -> Column:
    """The distinct substrings of the given sizes."""
    def of_size(n: Column) -> Column:
        begins = F.when(F.length(column) >= n, F.sequence(F.lit(1), F.length(column) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(begins, lambda begin: F.substring(F.col(column), begin, n))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def key_partial_match(left: DataFrame, right: DataFrame, key: str = "job_id", size: int = 3, rows_per_block: int = 10_000) -> DataFrame:
    """All pairs of a left and a right key of which one contains the other.

    A key that another one contains shares with it every substring of *size* characters (a shorter key: itself). The one
    that the fewest other keys have is its seed; keys with that seed are candidates, and containment decides. So the
    work grows with the length of a key, not with its square. The keys that have a frequent seed are dealt to blocks of
    about *rows_per_block*, and a key with that seed meets each block. Take a top-k of the result to show some.
    """

    def keys(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).cast("string").alias(name)).filter(F.length(name) > 0).distinct()

    def within(outer: DataFrame, inner: DataFrame, whole: str, piece: str) -> DataFrame:
        had = outer.select(whole, F.explode(_grams(whole, F.sequence(F.lit(1), F.lit(size)))).alias("gram"))
        counts = stored(had.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram_counts")
        own = inner.select(piece, F.explode(_grams(piece, F.array(F.least(F.lit(size), F.length(piece))))).alias("gram"))
        ranked = own.join(counts, "gram", "left").select(piece, F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("seed"))
        seeds = ranked.groupBy(piece).agg(F.min("seed").alias("seed")).select(piece, "seed.n", "seed.gram").filter("n > 0")
        seeds = stored(seeds.withColumn("blocks", F.ceil(F.col("n") / rows_per_block)), "seeds")
        wanted = had.join(seeds.select("gram", "blocks").distinct(), "gram")
        wanted = wanted.select(whole, "gram", F.pmod(F.xxhash64(whole), "blocks").alias("block"))
        asked = seeds.select(piece, "gram", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        return wanted.join(asked, ["gram", "block"]).filter(F.contains(whole, piece)).select("left_key", "right_key")

    lefts, rights = keys(left, "left_key"), keys(right, "right_key")
    both = within(rights, lefts, "right_key", "left_key").unionAll(within(lefts, rights, "left_key", "right_key"))
    return both.distinct()


def common_keys(left: DataFrame, right: DataFrame, key: str = "job_id") -> DataFrame:
    return left.select(key).intersect(right.select(key))


def union_sources(*junctions: DataFrame) -> DataFrame:
    """UNION ALL of junction tables by column name; either salary name is accepted."""
    aligned = []
    for df in junctions:
        if "salary_mid_usd" not in df.columns and "salary_mid" in df.columns:
            df = df.withColumnRenamed("salary_mid", "salary_mid_usd")
        aligned.append(df.withColumn("posted_date", F.col("posted_date").cast("date")))
    result = aligned[0]
    for df in aligned[1:]:
        result = result.unionByName(df)
    return result


def features_target_join(features: DataFrame, target: DataFrame, on_country: bool = True) -> DataFrame:
    """Put the target beside its features.

    *on_country* off joins on skill and week only, which pairs every country of a week with every other.
    """
    keys = ["skill", "week"] + (["country"] if on_country else [])
    return features.join(target.select(*keys, "target"), keys)


def filter_known_skills(clusters: DataFrame, known: list[str]) -> DataFrame:
    """Skills that share a cluster with a known skill and are not known themselves."""
    lowered = [name.lower() for name in known]
    is_known = F.lower("skill").isin(lowered)
    own = clusters.filter(F.col("skill").isin(lowered)).select("cluster").distinct()
    return clusters.filter(~is_known).join(own, "cluster", "left_semi").select("skill", "cluster")


def enrich_recommendations(recommended: DataFrame, forecast: DataFrame) -> DataFrame:
    """Attach demand, growth and salary where a forecast exists."""
    details = forecast.select(
        "skill", "current_demand", "growth_pct", F.col("current_salary").alias("salary")
    )
    return recommended.join(details, "skill", "left")
