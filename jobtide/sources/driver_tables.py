"""Canonical views built over the generic order, document, event and embedding tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.vocabulary import Vocabulary

#: The generated texts hold ordinary words, so extraction is exercised with these terms and one alias.
TEXT_VOCABULARY = Vocabulary(("the", "and", "of", "le", "la", "que", "der", "und", "mit", "rest", "r"), {"les": "le"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Newest order day, the stand-in for the current date."""
    return table(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate"))).scalar()


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer and nation columns the views need."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("o_date", F.to_date("o_orderdate"))
    )


def job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: its order is the job, its part's brand the skill."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("job_id"),
            F.col("o_date").alias("posted_date"),
            F.col("n_name").alias("country"),
            F.col("l_extendedprice").alias("salary_mid_usd"),
            F.col("p_brand").alias("skill"),
            F.year("o_date").alias("year"),
            F.month("o_date").alias("month"),
        )
    )


def job_skill_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, skills): the distinct skills of a job, at most as many as there are skills."""
    return (
        job_skills(spark, sf_dir)
        .groupBy("job_id")
        .agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    )


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the collection API, with every optional field missing somewhere."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    urgent, low = priority == "1-URGENT", priority == "5-LOW"
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return _orders(spark, sf_dir).select(
        F.when(~low, F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(priority, F.lit(" "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(~urgent, F.struct(F.col("c_name").alias("display_name"))).alias("company"),
        F.when(status != "P", F.concat(F.lit("Rest of the "), F.col("c_mktsegment"))).alias("description"),
        F.struct(
            F.col("n_name").alias("display_name"), F.array("n_name", "c_mktsegment").alias("area")
        ).alias("location"),
        F.when(status != "P", F.col("c_acctbal") * 10).alias("salary_min"),
        F.when(~urgent, F.col("o_totalprice")).alias("salary_max"),
        F.when(~low, F.when(status == "F", 1).otherwise(0)).alias("salary_is_predicted"),
        F.when(~low, F.lit("permanent")).alias("contract_type"),
        F.lit(None).cast("string").alias("contract_time"),
        F.when(~urgent, F.struct(F.col("c_mktsegment").alias("label"), F.lower("c_mktsegment").alias("tag"))).alias(
            "category"
        ),
        F.concat(F.lit("https://example.com/job/"), F.col("o_orderkey").cast("string")).alias("redirect_url"),
        F.when(low, F.lit("soon")).otherwise(iso).alias("created"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.element_at(F.array(F.lit("us"), F.lit("gb"), F.lit("de"), F.lit("fr"), F.lit("in")), F.col("n_regionkey") + 1)
        .alias("search_country"),
        F.lower("c_mktsegment").alias("search_query"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as postings with whole texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("country"),
    )


def event_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as repeated deliveries of one posting per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.col("ts").alias("ingested_at"),
        F.col("event_id"),
        F.col("event_type").alias("title"),
        F.col("value"),
        F.col("props"),
    )


def skill_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("skill"), F.col("embedding").cast("array<double>").alias("vector")
    )
