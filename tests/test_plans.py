"""What the physical plans may and may not contain."""

import re

import pytest
from pyspark.sql import functions as F

from jobtide.operators import demand, features, pairs
from jobtide.operators.dedup import dedup_latest
from jobtide.plans import etl
from jobtide.schema import JOB_SKILLS, RAW_POSTING


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_junction(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("junction"))
    rows = spark.range(1000).select(
        (F.col("id") % 100).cast("string").alias("job_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("posted_date"),
        F.lit("US").alias("country"), F.col("id").cast("double").alias("salary_mid_usd"),
        F.concat(F.lit("s"), F.col("id") % 20).alias("skill"),
    )
    dated = rows.withColumns({"year": F.year("posted_date"), "month": F.month("posted_date")})
    dated.write.mode("overwrite").partitionBy("year", "month").parquet(path)
    return spark.read.schema(JOB_SKILLS).parquet(path)


def test_views_prune_columns_and_partitions(stored_junction):
    text = plan(demand.vw_skill_trends(stored_junction, "2024-10-01", 4))
    assert "ReadSchema: struct<posted_date:date,country:string,salary_mid_usd:double,skill:string>" in text
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(posted_date,2024-09-03\)", text)
    assert re.search(r"PartitionFilters: \[.*year#\d+ \* 100.*>= 202409", text)


def test_extraction_is_native_and_local(spark, tmp_path):
    raw = spark.createDataFrame([], RAW_POSTING)
    text = plan(etl.etl_jobs(raw))
    assert "EvalPython" not in text and text.count("Exchange") <= 1


def test_newest_row_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "2024", 1)], "job_id string, ingested_at string, v int")
    text = plan(dedup_latest(df))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning(job_id") < text.index("Partial")


def test_feature_windows_share_one_shuffle_and_sort(spark, tmp_path):
    weekly = "skill string, week date, country string, job_count long, avg_salary double"
    spark.createDataFrame([], weekly).write.parquet(str(tmp_path / "w"))
    stored = spark.read.parquet(str(tmp_path / "w"))
    df = features.feat_ema4(stored)
    for block in (features.feat_lags, features.feat_rolling, features.feat_growth, features.feat_salary_growth, features.feat_trend_strength):
        df = block(df)
    text = plan(features.make_target(df))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_pairs_do_not_pair_before_counting(stored_junction):
    text = plan(pairs.cooccurrence_selfjoin(stored_junction))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert re.search(r"Exchange hashpartitioning\(job_id#\d+, skill#\d+", text)


def test_top_k_takes_ordered(stored_junction):
    assert "TakeOrderedAndProject" in plan(demand.top_skills(stored_junction))


def test_pairs_join_the_tables_once(spark, sf):
    """Both kinds of pairs read stored rows, not the joined tables over again."""
    from jobtide.plans.registered.postings import QUERIES

    found = QUERIES["dedup_pairs"](spark, sf)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    assert found.count() == found.distinct().count() > 0
