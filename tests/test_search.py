"""Pages of the index against the scan, row by row."""

import datetime as dt
import random

import pytest

from jobtide.operators import normalize as nz
from jobtide.operators import search


@pytest.fixture(scope="module")
def jobs(spark):
    rng = random.Random(1)
    words = ["python", "java", "sql", "rust", "été"]
    rows = []
    for k in range(400):
        day = None if k % 40 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60))
        text = " ".join(rng.choices(words, [50, 20, 10, 2, 5], k=rng.randrange(0, 6)))
        rows.append((f"j{k:03d}", day, f"Job {k % 7}", "Co", rng.choice(["Paris", "New York", None]), text or None, rng.choice(["FR", "US"]),
                     rng.choice(["it", "ops"]), float(rng.randrange(1, 9) * 10_000), None))
    schema = ("job_id string, posted_date date, title string, company string, location string, description string, country string, "
              "category string, salary_min_usd double, salary_max_usd double")
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def index(jobs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    search.write_search_index(jobs, path, buckets=4)
    return path


@pytest.mark.parametrize("options", [
    {"what": "Python java"}, {"what": "été"}, {"what": "rust sql"}, {"what": "missing python"}, {"what": "job"}, {},
    {"what": "python", "country": "fr", "where": "paris", "category": "it", "salary_min": 30_000.0},
    {"what": "python", "max_days_old": 20, "as_of": dt.date(2024, 2, 20)},
])
def test_all_pages_equal_the_scan(spark, jobs, index, options):
    options = {"max_days_old": None} | options
    whole = [r.job_id for r in nz.search_postings(jobs, results_per_page=1_000, **options).collect()]
    found, after = [], None
    while rows := search.search_index(spark, index, results_per_page=37, after=after, **options).collect():
        found += [r.job_id for r in rows]
        after = (rows[-1].posted_date, rows[-1].job_id)
        assert len(rows) == 37 or len(found) == len(whole)
    assert found == whole


def test_reads_only_the_words_folders(spark, index):
    page = search.search_index(spark, index, what="rust", max_days_old=None, after=(dt.date(2024, 1, 20), "j100"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(word,rust)" in plan and "GreaterThanOrEqual(day" in plan


def test_postings_are_packed_tightly(spark, index):
    """Ids and places stand once with every word, so the files are compressed harder than by default."""
    files = spark.read.parquet(f"{index}/postings").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
