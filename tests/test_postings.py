import datetime as dt
import gzip
import hashlib
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators import dedup, normalize as nz, relations
from jobtide.plans import etl
from jobtide.plans.registered import streams
from jobtide.schema import API_PAYLOAD, JOBS, RAW_POSTING
from jobtide.session import scratch_path
from jobtide.sources import readers, sinks
from jobtide.streaming import ingest

RECORDS = [
    {
        "job_id": "p-17", "source": "adzuna", "title": "Platform Developer", "company": "Harbour Tools",
        "description": "Our services run on kubernetes and docker; most code is Go, some python.",
        "location": {"display_name": "Porto", "area": ["PT", "Norte", "Porto"], "country": "PT"},
        "salary": {"min": 41000.0, "max": 52000.0, "currency": "LOCAL", "is_predicted": True},
        "posted_date": "2025-11-03T08:30:00Z", "url": "https://jobs.invalid/17", "ingested_at": "2025-11-05T00:00:00Z",
    },
    {
        "job_id": "p-17", "title": "Developer (first draft)", "description": "rust", "posted_date": "2025-10-20T00:00:00Z",
        "ingested_at": "2025-10-21T00:00:00Z",
    },
    {
        "job_id": "p-18", "title": "Analyst", "description": "Reports from mysql, pipelines in airflow",
        "location": {"display_name": "Lyon", "country": "FR"}, "salary": {"max": 39000.0}, "posted_date": "next week",
        "ingested_at": "2025-11-05T00:00:00Z",
    },
    {"job_id": "p-19", "title": "Without a text", "ingested_at": "2025-11-05T00:00:00Z"},
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RECORDS, RAW_POSTING)


def payloads(spark, *items):
    return spark.createDataFrame(list(items), API_PAYLOAD)


def test_etl_nested(raw, rows):
    jobs = etl.etl_jobs(raw)
    assert jobs.columns == JOBS.fieldNames()
    got = {r.job_id: r for r in jobs.collect()}
    assert set(got) == {"p-17", "p-18"}
    newest, poor = got["p-17"], got["p-18"]
    assert (newest.title, newest.country, newest.salary_mid_usd) == ("Platform Developer", "PT", 46500.0)
    assert (newest.posted_date, newest.year, newest.month) == (dt.date(2025, 11, 3), 2025, 11)
    assert newest.extracted_skills == ["docker", "go", "kubernetes", "python"] and newest.skill_count == 4
    assert (poor.salary_min_usd, poor.salary_max_usd, poor.salary_mid_usd, poor.posted_date) == (None, 39000.0, None, None)
    assert poor.extracted_skills == ["airflow", "mysql"]
    assert rows(etl.etl_job_skills(jobs), "job_id", "skill")[:2] == [("p-17", "docker"), ("p-17", "go")]


def test_etl_flat_and_poor_schemas(spark):
    flat = spark.createDataFrame(
        [("1", "Berlin", "DE", 10.0, 20.0, "2024-01-05", ["x"], "u")],
        "job_id string, location string, country string, salary_min double, salary_max double, posted_date string, "
        "extracted_skills array<string>, redirect_url string",
    )
    row = etl.etl_jobs(flat).first()
    assert (row.location, row.country, row.salary_mid_usd, row.url, row.skill_count) == ("Berlin", "DE", 15.0, "u", 1)
    bare = spark.createDataFrame([("t", "50"), ("t", "50")], "title string, salary string")
    row, = etl.etl_jobs(bare, as_of="2024-02-03").collect()
    assert row.job_id == hashlib.sha256(b"t||50").hexdigest()
    assert (row.salary_min_usd, row.salary_max_usd, row.posted_date, row.extracted_skills) == (50.0, 50.0, dt.date(2024, 2, 3), [])


def test_etl_without_some_ids(spark):
    df = spark.createDataFrame([(None, f"t{k}", "sql") for k in range(5)] + [("x", "t", "sql")], "job_id string, title string, description string")
    ids = [r.job_id for r in etl.etl_jobs(df).collect()]
    assert len(set(ids)) == 6 and hashlib.sha256(b"t3||sql").hexdigest() in ids


def test_etl_half_a_salary_struct(spark):
    df = spark.createDataFrame([("a", "sql", (5.0,))], "job_id string, description string, salary struct<max:double>")
    row = etl.etl_jobs(df).first()
    assert (row.salary_min_usd, row.salary_max_usd) == (None, 5.0)


def test_normalize_payload(spark):
    df = payloads(
        spark,
        {"id": "88", "title": "Welder", "company": {"display_name": "Arc"}, "description": "steel",
         "location": {"display_name": "Leeds", "area": ["UK", "Leeds"]}, "salary_is_predicted": 1},
        {"title": "Baker", "company": {"display_name": "Crumb"}},
    )
    out = nz.normalize_posting_nested(df, F.lit("gb"), F.lit("q"), F.lit("now")).collect()
    first, second = out
    assert first.job_id == hashlib.md5(b"88-Welder-Arc").hexdigest()
    assert second.job_id == hashlib.md5(b"-Baker-Crumb").hexdigest()
    assert first.location.country == "GB" and first.salary.currency == "GBP" and first.salary.is_predicted is True
    assert second.salary.min is None and second.location.area == [] and second.source_id == ""
    older = nz.normalize_posting_nested(df, F.lit("us"), F.lit("q"), F.lit("now"), with_details=False).collect()[1]
    assert older.job_id == hashlib.md5(b"None-Baker").hexdigest() and "currency" not in older.salary.asDict()


def test_flat_ids_and_salaries(spark):
    df = payloads(
        spark,
        {"id": "907", "title": "a", "salary_min": 10.0, "salary_max": 20.0},
        {"title": "Gardener", "company": {"display_name": "Fern"}, "location": {"display_name": "Bath"},
         "salary_min": 0.0, "salary_max": 30.0, "description": "some rust and sql"},
    )
    one, two = nz.parse_posting_flat(df, F.lit("us"), F.lit("now")).collect()
    assert one.job_id == "adzuna_907" and one.salary_mid == 15.0
    assert two.job_id == "adzuna_" + hashlib.md5(b"Gardener-Fern-Bath").hexdigest()[:12]
    assert two.salary_mid == 30.0 and two.extracted_skills == ["rust", "sql"] and two.posted_date is not None


def test_salary_backfill_needs_lower_ends(spark):
    schema = "salary_min double, salary_max double, salary_mid double"
    only_max = spark.createDataFrame([(None, 10.0, None)], schema)
    assert nz.salary_mid_backfill(only_max).first().salary_mid is None
    some_mid = spark.createDataFrame([(4.0, 10.0, None), (1.0, 1.0, 9.0)], schema)
    assert [r.salary_mid for r in nz.salary_mid_backfill(some_mid).collect()] == [None, 9.0]
    empty_mid = spark.createDataFrame([(4.0, 10.0, None), (4.0, None, None), (None, None, None)], schema)
    assert [r.salary_mid for r in nz.salary_mid_backfill(empty_mid).collect()] == [7.0, 2.0, None]


def test_imputed_dates_are_stable(spark, rows):
    df = spark.createDataFrame([(str(i), None) for i in range(50)] + [("x", dt.date(2020, 1, 1))], "job_id string, posted_date date")
    once, again = rows(nz.impute_posted_date(df)), rows(nz.impute_posted_date(df.repartition(7)))
    assert once == again and sum(r[2] for r in once) == 50


def test_map_columns_first_wins(spark):
    df = spark.createDataFrame([(1, 2, 3)], "job_link int, job_posting_url int, job_title int")
    assert nz.map_columns(df, nz.POSTING_COLUMNS).columns == ["job_id", "job_posting_url", "title"]


def test_dedup_latest(spark, rows):
    df = spark.createDataFrame(
        [("a", "2024-01-02", 1), ("a", None, 2), ("a", "2024-01-03", 3), ("b", None, 4), ("c", "2024-01-01", 5), ("c", "2024-01-01", 6)],
        "job_id string, ingested_at string, v int",
    )
    first = rows(dedup.dedup_latest(df))
    assert first == rows(dedup.dedup_latest(dedup.dedup_latest(df))) == rows(dedup.dedup_latest(df.repartition(5)))
    assert [r[:1] + r[2:] for r in first][:2] == [("a", 3), ("b", 4)]


def test_join_without_overlap(spark):
    skills = spark.createDataFrame([("a ", "x"), ("b", "y")], "job_id string, skill string")
    jobs = spark.createDataFrame([("a", dt.date(2024, 1, 1), 5.0, 2024, 1)], "job_id string, posted_date date, salary_mid double, year int, month int")
    assert [tuple(r) for r in relations.join_skills_jobs(skills, jobs).collect()] == [("a", dt.date(2024, 1, 1), 5.0, "x", "US", 2024, 1)]
    alone = relations.join_skills_jobs(skills, jobs.filter("job_id = 'z'"), impute_dates=True).collect()
    assert len(alone) == 2 and all(r.posted_date.year in (2023, 2024) and r.salary_mid is None for r in alone)


def test_raw_zone_of_mixed_layouts(spark, tmp_path, raw):
    root = str(tmp_path / "raw")
    raw.limit(1).write.parquet(f"{root}/year=2024/month=1")
    day = tmp_path / "raw" / "date=2026-03-16"
    day.mkdir(parents=True)
    (day / "jobs.json").write_text("\n".join(json.dumps(r) for r in RECORDS[1:]) + "\n{broken\n")
    read = readers.read_raw_auto(spark, root)
    assert read.filter("job_id IS NOT NULL").count() == 4 and {"date", "year", "month"} <= set(read.columns)
    assert readers.corrupt_records(readers.read_ndjson(spark, str(day)).cache()).count() == 1
    jobs = etl.run_etl(spark, root, str(tmp_path / "jobs"), str(tmp_path / "skills"))
    assert (jobs.jobs.rows, jobs.corrupt_lines) == (2, 1)
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_raw_auto(spark, str(tmp_path / "empty"))


def test_raw_zone_of_both_collectors(spark, tmp_path, raw):
    """Nested lines, flat lines and flat Parquet below one prefix, with every known ending."""
    root = tmp_path / "raw"
    day = root / "source=a" / "date=2025-11-05"
    day.mkdir(parents=True)
    (day / "one.json").write_text(json.dumps(RECORDS[0]) + "\n" + json.dumps({"title": "no id", "description": "sql", "location": "Graz"}))
    (day / "two.ndjson").write_text(json.dumps({
        "job_id": "f1", "description": "go", "location": "Oslo", "country": "NO", "salary_min": 7, "salary_max": 9,
        "redirect_url": "u", "extracted_skills": ["given"], "posted_date": "2025-01-02",
    }))
    with gzip.open(day / "three.jsonl.gz", "wt") as lines:
        lines.write(json.dumps({"job_id": "f2", "description": "redis", "salary": 12}))
    spark.createDataFrame(
        [("f3", "docker", "Rome", "IT", 1.0, 3.0, dt.date(2025, 3, 4))],
        "job_id string, description string, location string, country string, salary_min double, salary_max double, posted_date date",
    ).write.parquet(str(day / "flat.parquet"))
    result = etl.run_etl(spark, str(root), str(tmp_path / "jobs"), str(tmp_path / "skills"))
    got = {r.job_id: r for r in spark.read.parquet(str(tmp_path / "jobs")).collect()}
    assert result.jobs.rows == len(got) == 5 and result.corrupt_lines == 0
    found = {k: (r.location, r.country, r.salary_min_usd, r.salary_max_usd, r.url, r.extracted_skills, str(r.posted_date)) for k, r in got.items()}
    assert found["f1"] == ("Oslo", "NO", 7.0, 9.0, "u", ["given"], "2025-01-02")
    assert found["f2"] == (None, None, 12.0, 12.0, None, ["redis"], "2025-11-05")
    assert found["f3"] == ("Rome", "IT", 1.0, 3.0, None, ["docker"], "2025-03-04")
    assert found["p-17"][:2] == ("Porto", "PT") and "Graz" in {v[0] for v in found.values()}
    (day / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="notes.txt"):
        readers.read_raw_auto(spark, str(root))


def test_json_array_file(spark, tmp_path):
    (tmp_path / "jobs.json").write_text(json.dumps(RECORDS[:1]))
    assert readers.read_ndjson(spark, str(tmp_path / "jobs.json"), multi_line=True).first().location.country == "PT"


def test_dynamic_overwrite_keeps_other_months(spark, tmp_path, raw):
    path = str(tmp_path / "jobs")
    jobs = etl.etl_jobs(raw)
    november = sinks.write_jobs(jobs.filter("month = 11"), path)
    sinks.write_jobs(jobs.filter("month IS NULL"), path)
    assert november.rows == 1 and spark.read.parquet(path).count() == 2


def test_bulk_load_falls_back_to_extraction(spark, tmp_path):
    folder = tmp_path / "bulk"
    folder.mkdir()
    (folder / "postings.csv").write_text(
        'job_link,job_title,company_name,job_location,description,min_salary,max_salary,listed_time\n'
        'u1,Dev,Co,NYC,"Python, ""Java""\nand go",10,20,2024-01-05\nu2,,Co,NYC,python,1,2,2024-01-06\n'
    )
    result = etl.run_bulk(spark, str(folder), str(tmp_path / "jobs"), str(tmp_path / "junction"))
    assert (result.jobs.rows, result.job_skills.rows) == (1, 3)
    got = spark.read.parquet(str(tmp_path / "junction")).collect()
    assert {r.skill for r in got} == {"python", "java", "go"} and {r.salary_mid for r in got} == {15.0}


def test_stream_ingest_resumes(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("raw", "jobs", "state"))
    (tmp_path / "raw").mkdir()

    def deliver(name, *records):
        (tmp_path / "raw" / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))
        ingest.stream_ingest(ingest.read_raw_stream(spark, source), out, state).awaitTermination()

    updated = RECORDS[2] | {"title": "Senior Analyst", "ingested_at": "2025-11-09T00:00:00Z"}
    withdrawn = {"job_id": "p-20", "description": "go", "ingested_at": "2025-11-05T00:00:00Z"}
    deliver("one", RECORDS[0], RECORDS[0], updated, withdrawn)
    deliver("two", RECORDS[0], RECORDS[2], RECORDS[1], withdrawn | {"description": None, "ingested_at": "2025-11-06T00:00:00Z"})
    jobs = ingest.ingested_jobs(spark, out).collect()
    whole = etl.etl_jobs(spark.read.schema(RAW_POSTING).json(source)).collect()
    assert sorted(jobs, key=str) == sorted(whole, key=str) and "Senior Analyst" in {r.title for r in jobs}
    assert sorted(r.job_id for r in jobs) == ["p-17", "p-18"]
    assert ingest.ingested_job_skills(spark, out).count() == 6
    # A read opens one version per job, and only the months' current folders.
    opened = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in ingest.ingested_jobs(spark, out).inputFiles()})
    assert opened.count() == len(jobs)


def test_stream_ingest_moves_retries_and_cleans_up(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("raw", "jobs", "state"))
    (tmp_path / "raw").mkdir()

    def deliver(name, *records):
        (tmp_path / "raw" / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))
        ingest.stream_ingest(ingest.read_raw_stream(spark, source), out, state).awaitTermination()
        got = sorted(ingest.ingested_jobs(spark, out).collect(), key=str)
        assert got == sorted(etl.etl_jobs(spark.read.schema(RAW_POSTING).json(source)).collect(), key=str)
        return got

    def row(job, day, at, title="t", text="python"):
        return {"job_id": job, "title": title, "description": text, "posted_date": f"{day}T00:00:00Z", "ingested_at": f"2025-11-{at:02d}T00:00:00Z"}

    assert len(deliver("one", row("a", "2025-01-05", 1), row("b", "2025-01-06", 1), row("c", "2025-02-01", 5))) == 3
    first = ingest.read_manifest(spark, out)
    moved = deliver("two", row("a", "2025-03-09", 2), row("c", "2025-02-01", 4, "older"), row("d", "2025-02-02", 1))
    assert [(r.job_id, r.month) for r in moved] == [("a", 3), ("b", 1), ("c", 2), ("d", 2)]
    second = ingest.read_manifest(spark, out)
    assert set(first) == {"year=2025/month=1", "year=2025/month=2"} and set(second) == set(first) | {"year=2025/month=3"}
    # A late row that is not newer touches nothing.
    deliver("three", row("a", "2025-05-01", 1, "late"))
    assert ingest.read_manifest(spark, out) == second
    # The last batch again, as after a failure between the folder and the manifest.
    batch = max(second.values())
    again = spark.createDataFrame(
        [(r.job_id, f"year={r.year}/month={r.month}", "year=2025/month=1" if r.job_id == "a" else None, json.dumps(r.asDict(), default=str)) for r in moved if r.job_id in "ad"],
        "job_id string, place string, earlier string, payload string",
    )
    ingest.merge_batch(spark, out, batch, again)
    assert ingest.read_manifest(spark, out, before=batch + 1) == second
    assert sorted(ingest.ingested_jobs(spark, out).collect(), key=str) == moved
    withdrawn = deliver("four", row("b", "2025-01-06", 9, text=None))
    assert "b" not in {r.job_id for r in withdrawn} and "year=2025/month=1" not in ingest.read_manifest(spark, out)
    ingest.remove_old_versions(spark, out, keep=1)
    assert sorted(ingest.ingested_jobs(spark, out).collect(), key=str) == withdrawn
    left = {p.name for p in (tmp_path / "jobs").iterdir() if p.name.startswith("v=")}
    assert left == {f"v={v}" for v in ingest.read_manifest(spark, out).values()}


def test_stream_ingest_runs_no_python_per_job(spark, tmp_path, monkeypatch):
    """Batches are joined with the versions seen before: no state function in Python, whatever the order, ties and gaps of rows."""
    monkeypatch.setattr(ingest, "WHOLE_EVERY", 3, raising=False)
    source, out, state = (str(tmp_path / n) for n in ("raw", "jobs", "state"))
    (tmp_path / "raw").mkdir()
    rng = random.Random(3)

    def row():
        at = rng.choice([None, *[f"2025-11-{d:02d}T00:00:00Z" for d in range(1, 9)]])
        return {"job_id": f"j{rng.randrange(30)}", "title": str(rng.random()), "description": rng.choice([None, "python", "go and java"]),
                "posted_date": rng.choice([None, "2025-01-05", "2025-02-05", "2025-03-05"]), "ingested_at": at}

    for delivery in range(8):
        (tmp_path / "raw" / f"{delivery}.json").write_text("\n".join(json.dumps(row()) for _ in range(12)))
        query = ingest.stream_ingest(ingest.read_raw_stream(spark, source), out, state)
        query.awaitTermination()
        got = sorted(ingest.ingested_jobs(spark, out).collect(), key=str)
        assert got == sorted(etl.etl_jobs(spark.read.schema(RAW_POSTING).json(source)).collect(), key=str)
        assert not query.lastProgress["stateOperators"] and "InPandas" not in query._jsq.explainInternal(False)
        if delivery == 6:
            ingest.remove_old_versions(spark, out)
    assert {p.name for p in (tmp_path / "jobs" / "_seen").iterdir()} == {"2", "3", "4", "5", "6", "7"}


def test_stream_ingest_leaves_no_shuffle_files(spark, tmp_path):
    """The shuffle files of a batch go with it, not when the driver happens to collect its garbage; the caller's setting stays."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = (path.rsplit("/", 1)[-1] for path in disk.getAllFiles().mkString("\n").split("\n"))
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    for delivery in range(2):
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{delivery}.json").write_text("\n".join(map(json.dumps, RECORDS)))
        stream = ingest.read_raw_stream(spark, str(tmp_path / "raw"))
        ingest.stream_ingest(stream, str(tmp_path / "jobs"), str(tmp_path / "state")).awaitTermination()
    assert shuffled() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_ingested_jobs_before_the_first_batch(spark, tmp_path):
    assert ingest.ingested_jobs(spark, str(tmp_path / "none")).collect() == []


def test_partial_match_equals_brute_force(spark):
    rng = random.Random(8)
    letters = "ab-é🙂"
    lefts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 7))) for _ in range(150)] + ["hot-" + str(i) for i in range(60)] + [None]
    rights = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 12))) for _ in range(150)] + [f"x hot-{i} y" for i in range(60)] + ["hot"]
    frames = [spark.createDataFrame([(k,) for k in keys], "job_id string") for keys in (lefts, rights)]
    want = sorted({(a, b) for a in lefts for b in rights if a and b and (a in b or b in a)})
    for block in (10_000, 7):
        assert sorted(map(tuple, relations.key_partial_match(*frames, rows_per_block=block).collect())) == want


def test_composite_ids_of_millions_of_postings(spark):
    """Different postings have different ids, also when there are millions of them, and parts do not run together."""
    title = F.concat(F.lit("Clerk "), F.col("id").cast("string"))
    ids = spark.range(4_000_000).select(nz.job_id_composite(title, F.lit("Harbour Tools"), F.lit("Porto")).alias("job_id"))
    assert ids.agg(F.countDistinct("job_id")).first()[0] == 4_000_000
    parts = [("a:b", "c", "d"), ("a", "b:c", "d"), ("a", "b", "c:d"), ("a", None, "b"), ("a", "b", None), (None, "a", "b")]
    df = spark.createDataFrame(parts, "title string, company string, location string")
    found = df.select(nz.job_id_composite(*[F.col(c) for c in df.columns]).alias("job_id"))
    assert found.distinct().count() == len(parts)


def test_registered_stream_reads_a_compressed_raw_zone(spark, sf, monkeypatch):
    """Three deliveries of every order, written compressed, and read in three batches."""
    paths = {}

    def path(spark, name):
        return paths.setdefault(name, scratch_path(spark, name))

    monkeypatch.setattr(streams, "scratch_path", path)
    monkeypatch.setattr(sinks, "NDJSON_ROWS_PER_FILE", 100)
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert 0 < streams.QUERIES["stream_ingest"](spark, sf).count() <= orders
    files = list(pathlib.Path(paths["raw"]).glob("part-*"))
    assert len(files) >= 3 * orders // 100 and all(f.name.endswith(".json.gz") for f in files)
    assert spark.read.json(paths["raw"]).count() == 3 * orders
    assert {f.name for f in pathlib.Path(paths["jobs"], "_manifests").iterdir() if f.name.isdigit()} == {"0", "1", "2"}


def test_raw_zone_is_compressed_and_dealt_to_files(spark, tmp_path, monkeypatch):
    """Records are written compressed, in files of bounded length, and read back whole."""
    monkeypatch.setattr(sinks, "NDJSON_ROWS_PER_FILE", 100)
    df = spark.range(1000).select(F.col("id").cast("string").alias("job_id"), F.repeat(F.lit("text "), 50).alias("description"))
    sinks.write_ndjson(df.coalesce(1), str(tmp_path / "raw"))
    files = [f for f in (tmp_path / "raw").iterdir() if f.name.startswith("part-")]
    assert len(files) == 10 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 50_000  # of 280,000 bytes of text
    read = readers.read_ndjson(spark, str(tmp_path / "raw"))
    assert read.select("job_id").distinct().count() == read.count() == 1000
