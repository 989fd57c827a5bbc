"""Normalisation, extraction, duplicates and joins over the posting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.text import fmt_number, fmt_salary
from jobtide.functions.vocabulary import (
    ALIASES, ALIAS_TERMS, BULK_TERMS, CATEGORY_SKILLS, ETL_TERMS, FLAT_TERMS, MODEL_CATEGORY_SKILLS, Vocabulary,
    model_category, skill_category,
)
from jobtide.operators import dedup, demand, extract, normalize as nz, pairs, relations, search
from jobtide.plans import etl
from jobtide.plans.store import stored
from jobtide.plans.registered.common import BRAND_GROUPS, JOB_SKILLS_SQL, category_sql, r, rounded
from jobtide.session import scratch_path
from jobtide.sources.driver_tables import (
    TEXT_VOCABULARY, as_of, event_postings, job_skill_sets, job_skills, payload, postings, table,
)

NOW = "2001-12-31"

#: The library's vocabularies together with words that occur in the generated texts.
COMMON = TEXT_VOCABULARY.terms
VOCABULARIES = {
    "extract_skills_alias": Vocabulary(ALIAS_TERMS + COMMON, ALIASES | TEXT_VOCABULARY.aliases),
    "extract_skills_etl": Vocabulary(ETL_TERMS + COMMON),
    "extract_skills_normalized": Vocabulary(FLAT_TERMS + ("der und", "of the"), identifiers=True),
    "extract_skills_bulk": Vocabulary(BULK_TERMS + COMMON),
}


def flat(df: DataFrame) -> DataFrame:
    """Structs as prefixed columns and arrays as joined text, a shape both engines print alike."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            inner = [(f"{field.name}_{f.name}", F.col(f"{field.name}.{f.name}"), f.dataType) for f in field.dataType.fields]
        else:
            inner = [(field.name, F.col(field.name), field.dataType)]
        for name, column, kind in inner:
            columns.append((F.concat_ws("|", column) if isinstance(kind, T.ArrayType) else column).alias(name))
    return rounded(df.select(*columns))


def _raw(spark, sf, with_details=True):
    """Nested raw records."""
    return nz.normalize_posting_nested(
        payload(spark, sf), F.col("search_country"), F.col("search_query"), F.lit("2001-12-31T00:00:00"), with_details
    )


def _flat_record(spark, sf):
    return nz.parse_posting_flat(
        payload(spark, sf), F.col("search_country"), F.lit("2001-12-31T00:00:00"), now=F.lit(NOW).cast("timestamp")
    )


def _ids(expression):
    return lambda spark, sf: payload(spark, sf).select(
        F.col("redirect_url"), expression(F.col("id"), F.col("title"), F.col("company.display_name")).alias("job_id")
    )


def _jobs(spark, sf):
    return etl.etl_jobs(_raw(spark, sf), Vocabulary(ETL_TERMS + ("rest",)), NOW)


def _salaries(expression):
    return lambda spark, sf: rounded(
        payload(spark, sf).select(
            "redirect_url", expression(F.col("salary_min"), F.col("salary_max")).alias("salary_mid")
        )
    )


def _located(spark, sf, nested):
    df = payload(spark, sf).withColumn("country", F.col("search_country"))
    if not nested:
        df = df.withColumn("location", F.col("location.display_name"))
    return nz.flatten_location(df).select("redirect_url", "location_display_name", "location_country")


def _paid(spark, sf, shape):
    df = payload(spark, sf)
    if shape == "nested":
        df = df.withColumn("salary", F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max")))
    elif shape == "scalar":
        amount = F.when(F.col("salary_max") > 200_000, F.lit("high")).otherwise(F.col("salary_max").cast("int").cast("string"))
        df = df.withColumn("salary", amount)
    return rounded(nz.flatten_salary(df).select("redirect_url", "salary_min_usd", "salary_max_usd"))


def _backfill(spark, sf):
    df = payload(spark, sf).withColumn("salary_mid", F.lit(None).cast("double"))
    return rounded(nz.salary_mid_backfill(df).select("redirect_url", "salary_mid"))


def _text_salaries(spark, sf):
    df = payload(spark, sf).select(
        "redirect_url", F.when(F.col("salary_min") > 50_000, F.lit("n/a")).otherwise(F.lit("1250.5")).alias("salary_min"),
        F.lit("7").alias("salary_max"),
    )
    return nz.coerce_numeric(df)


def _dated(spark, sf):
    df = payload(spark, sf).withColumn("posted_date", F.col("created"))
    return nz.resolve_posted_date(df).select("redirect_url", "posted_date", "year", "month")


def _dated_or_today(spark, sf):
    df = payload(spark, sf).select("redirect_url")
    return nz.resolve_posted_date(df, NOW)


def _coerced(spark, sf):
    stamp = nz.coerce_posted_date(F.col("created"))
    return payload(spark, sf).select("redirect_url", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("posted_date"))


def _imputed(spark, sf):
    df = payload(spark, sf).select(
        F.col("redirect_url").alias("job_id"), F.col("created").try_cast("date").alias("posted_date")
    )
    inside = F.col("posted_date").between(F.lit("2023-01-01").cast("date"), F.lit("2023-12-31").cast("date"))
    return nz.impute_posted_date(df).groupBy("date_imputed").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(inside, F.lit(1))).alias("in_range"),
        F.count("posted_date").alias("dated"),
    )


def _ensured(spark, sf):
    return nz.ensure_columns(payload(spark, sf).select("title", "redirect_url"))


def _mapped(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("job_link"), F.col("o_custkey").cast("string").alias("job_posting_url"),
        F.col("o_orderpriority").alias("job_title"), F.col("o_totalprice").alias("max_salary"),
    )
    return nz.map_columns(orders, nz.POSTING_COLUMNS)


def _bulk(spark, sf):
    source = payload(spark, sf).select(
        F.col("redirect_url").alias("job_link"),
        F.when(F.col("salary_max").isNotNull(), F.col("title")).alias("job_title"),
        F.col("company.display_name").alias("company_name"), "description",
        F.col("location.display_name").alias("job_location"), F.col("salary_min").alias("min_salary"),
        F.col("salary_max").alias("max_salary"), F.col("created").alias("first_seen"),
    )
    return etl.bulk_jobs(source, F.lit(NOW), Vocabulary(BULK_TERMS + ("rest",)))


def _project_bulk(spark, sf):
    stamp = F.date_format("posted_date", "yyyy-MM-dd HH:mm:ss")
    return flat(_bulk(spark, sf).withColumn("posted_date", stamp))


def _dirty_skills(spark, sf):
    return job_skills(spark, sf).select(
        "job_id",
        F.when(F.col("skill") == "Brand#1", F.lit("nan")).when(F.col("skill") == "Brand#2", F.lit("  "))
        .when(F.col("skill") == "Brand#3", F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("skill"), F.lit(" ")))
        .alias("skill"),
    )


def _search(spark, sf):
    page = nz.search_postings(
        _jobs(spark, sf), what="rest building", where="nation_1", max_days_old=1000, salary_min=20_000, page=2,
        results_per_page=20, as_of=as_of(spark, sf),
    )
    return rounded(page.select("job_id", "title", "posted_date", "salary_min_usd"))


def _indexed_search(spark, sf):
    """The second page of the same search, behind the last row of the first one."""
    path = scratch_path(spark, "index")
    search.write_search_index(_jobs(spark, sf), path)
    options = dict(what="rest building", where="nation_1", max_days_old=1000, salary_min=20_000, results_per_page=20, as_of=as_of(spark, sf))
    first = search.search_index(spark, path, **options).collect()
    after = (first[-1]["posted_date"], first[-1]["job_id"]) if first else None
    page = search.search_index(spark, path, after=after, **options)
    return rounded(page.select("job_id", "title", "posted_date", "salary_min_usd"))


def _extracted(key):
    def query(spark, sf):
        found = extract.extract_skills(postings(spark, sf), "description", VOCABULARIES[key])
        return found.select("job_id", F.concat_ws("|", "extracted_skills").alias("skills"))

    return query


def _extracted_from_table(spark, sf):
    """Terms of the data: the first one, two and three words of the benchmark's texts, searched for in all documents."""
    begins = F.split(F.lower("text"), " ")
    phrases = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.array_join(F.slice(begins, 1, n), " "))
    terms = table(spark, sf, "benchmark").select(F.explode(phrases).alias("spelling")).where(F.length("spelling") > 0).distinct()
    vocabulary = terms.select(F.replace("spelling", F.lit(" "), F.lit("_")).alias("name"), "spelling")
    found = extract.extract_skills_from(postings(spark, sf), vocabulary, "description")
    return found.select("job_id", F.concat_ws("|", "extracted_skills").alias("skills"))


def _skill_lists(spark, sf):
    """Skill sets written in each of the accepted text forms, by the size of the set."""
    sets = job_skill_sets(spark, sf)
    n = F.size("skills")
    quoted = F.concat(F.lit("['"), F.array_join("skills", "', '"), F.lit("']"))
    text = (
        F.when(n == 1, F.array_join("skills", ","))
        .when(n == 2, F.array_join("skills", " | "))
        .when(n == 3, F.array_join("skills", ";"))
        .when(n == 4, F.concat(F.lit(" "), F.array_join("skills", ", "), F.lit(" ,")))
        .otherwise(quoted)
    )
    return sets.select("job_id", extract.parse_skill_list(text).alias("skill_list"))


def _counted(spark, sf):
    found = extract.extract_skills(postings(spark, sf), "description", TEXT_VOCABULARY)
    return extract.skill_count(found).select("job_id", "skill_count")


def _passed(spark, sf):
    sets = job_skill_sets(spark, sf).withColumnRenamed("skills", "extracted_skills")
    return flat(extract.skills_passthrough(sets, "description", TEXT_VOCABULARY))


def _exploded(spark, sf):
    sets = job_skill_sets(spark, sf).withColumnRenamed("skills", "extracted_skills")
    return extract.explode_skills(sets, keep=("job_id",), country="US")


def _latest_events(spark, sf):
    events = dedup.dedup_latest(event_postings(spark, sf))
    return events.select("job_id", "event_id", "title", F.get_json_object("props", "$.k").alias("k"))


def _first_events(spark, sf):
    return dedup.dedup_first_seen(event_postings(spark, sf), ["event_id"]).select("job_id", "event_id", "title")


def _pairs_once(spark, sf):
    """Pairs without repeats, from the pairs of each country."""
    js = stored(job_skills(spark, sf).select("job_id", "country", "skill"), "rows")  # read for both kinds of pairs
    by_country = js.withColumn("job_id", F.concat_ws("/", "country", "job_id"))
    both = pairs.cooccurrence_selfjoin(js).unionAll(pairs.cooccurrence_selfjoin(by_country))
    return dedup.dedup_pairs(both).select("skill_a", "skill_b")


def _order_jobs(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.to_date("o_orderdate").alias("posted_date"), F.col("o_totalprice").alias("salary_mid"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )


def _joined(spark, sf, prefix=""):
    skills = job_skills(spark, sf).select(F.concat(F.lit(prefix), F.col("job_id")).alias("job_id"), "skill")
    return rounded(relations.join_skills_jobs(skills, _order_jobs(spark, sf)))


def _overlap(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("job_id"))
    return relations.key_overlap(lines, table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id")))


def _partial(spark, sf):
    left = table(spark, sf, "supplier").select(F.col("s_name").alias("job_id"))
    right = table(spark, sf, "supplier").select(F.concat(F.lit("x-"), F.col("s_name"), F.lit("-y")).alias("job_id"))
    return relations.key_partial_match(left, right)


def _common(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("job_id"))
    return relations.common_keys(lines, table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id")))


def _united(spark, sf):
    js = job_skills(spark, sf)
    bulk = js.withColumnRenamed("salary_mid_usd", "salary_mid").withColumn(
        "posted_date", F.col("posted_date").cast("timestamp")
    )
    return rounded(relations.union_sources(js, bulk))


def _from_raw(spark, sf):
    dirty = job_skills(spark, sf).select(
        F.when(F.col("salary_mid_usd") < 90_000, F.col("job_id")).alias("job_id"), "skill",
        F.when(F.col("month") != 12, F.col("country")).alias("country"),
        F.when(F.col("month") == 1, F.lit("unknown")).otherwise(F.col("posted_date").cast("string")).alias("posted_date"),
        F.when(F.col("skill") == "Brand#1", F.lit("-")).otherwise(F.col("salary_mid_usd").cast("int").cast("string"))
        .alias("salary_mid"),
    )
    return rounded(demand.weekly_demand_from_raw(dirty))


#: Groups that the data's own words and brands fall into, besides the built-in ones.
DATA_GROUPS = BRAND_GROUPS | {"English": COMMON[:3], "French": COMMON[3:6], "German": COMMON[6:9]}


def _data_categories(function, groups):
    """Category and mentions of every skill in the data: those extracted from the texts, and the brands of the parts."""

    def query(spark, sf):
        found = extract.extract_skills(postings(spark, sf), "description", VOCABULARIES["extract_skills_alias"])
        in_texts = extract.explode_skills(found, keep=("job_id",)).select("skill")
        brands = table(spark, sf, "part").select(F.col("p_brand").alias("skill"))
        counted = in_texts.unionAll(brands).groupBy("skill").agg(F.count(F.lit(1)).alias("mentions"))
        return counted.select("skill", "mentions", function(F.col("skill"), groups).alias("category"))

    return query


def _formatted(spark, sf):
    value = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        fmt_salary(F.when(F.col("c_mktsegment") != "BUILDING", F.floor(F.abs(value)).cast("double"))).alias("salary"),
        fmt_number(F.col("c_custkey") * 1000).alias("number"),
    )


QUERIES = {
    "normalize_posting_nested": lambda spark, sf: flat(_raw(spark, sf)),
    "normalize_posting_lambda": lambda spark, sf: flat(_raw(spark, sf, with_details=False)),
    "parse_posting_flat": lambda spark, sf: flat(
        _flat_record(spark, sf).withColumn("posted_date", F.date_format("posted_date", "yyyy-MM-dd HH:mm:ss"))
    ),
    "record_defaults": lambda spark, sf: flat(
        nz.record_defaults(_raw(spark, sf, with_details=False).withColumn("url", F.nullif("category", F.lit("BUILDING"))))
    ),
    "job_id_md5_2": _ids(lambda id_, title, company: nz.job_id_md5_2(id_, title)),
    "job_id_md5_3": _ids(nz.job_id_md5_3),
    "job_id_prefixed": _ids(lambda id_, title, company: nz.job_id_prefixed(id_, title, company, F.col("location.display_name"))),
    "job_id_rowhash": lambda spark, sf: (lambda df: df.select("o_orderkey", nz.job_id_rowhash(df).alias("job_id")))(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ),
    "job_id_composite": lambda spark, sf: payload(spark, sf).select(
        nz.job_id_composite(F.col("title"), F.col("company.display_name"), F.col("location.display_name")).alias("job_id")
    ).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("job_id").alias("ids")),
    "currency_for_country": lambda spark, sf: payload(spark, sf).select(
        "redirect_url", nz.currency_for_country(F.col("search_country")).alias("currency")
    ),
    "flatten_location": lambda spark, sf: _located(spark, sf, nested=True),
    "flatten_location_scalar": lambda spark, sf: _located(spark, sf, nested=False),
    "flatten_salary": lambda spark, sf: _paid(spark, sf, "nested"),
    "flatten_salary_scalar": lambda spark, sf: _paid(spark, sf, "scalar"),
    "flatten_salary_flat": lambda spark, sf: _paid(spark, sf, "flat"),
    "salary_mid_strict": _salaries(nz.salary_mid_strict),
    "salary_mid_fallback": _salaries(
        lambda low, high: nz.salary_mid_fallback(F.when(low > 10_000, low).otherwise(F.lit(0.0)), high)
    ),
    "salary_mid_backfill": _backfill,
    "coerce_numeric": _text_salaries,
    "resolve_posted_date": _dated,
    "resolve_posted_date_default": _dated_or_today,
    "coerce_posted_date": _coerced,
    "impute_posted_date": _imputed,
    "ensure_columns": _ensured,
    "map_columns": _mapped,
    "filter_has_description": lambda spark, sf: nz.filter_has_description(payload(spark, sf)).select("redirect_url"),
    "filter_has_title": lambda spark, sf: nz.filter_has_title(
        payload(spark, sf).select("redirect_url", F.col("company.display_name").alias("title"))
    ).select("redirect_url"),
    "filter_has_date": lambda spark, sf: nz.filter_has_date(_dated(spark, sf)).select("redirect_url"),
    "project_jobs": lambda spark, sf: flat(_jobs(spark, sf)),
    "project_bulk_jobs": _project_bulk,
    "clean_skill": lambda spark, sf: nz.clean_skill(_dirty_skills(spark, sf)),
    "search_postings": _search,
    "search_index": _indexed_search,
    "list_categories": lambda spark, sf: nz.list_categories(_jobs(spark, sf)),
    "salary_histogram": lambda spark, sf: rounded(nz.salary_histogram(_jobs(spark, sf), 25_000.0, what="rest")),
    **{key: _extracted(key) for key in VOCABULARIES},
    "extract_skills_from": _extracted_from_table,
    "skill_count": _counted,
    "skills_passthrough": _passed,
    "parse_skill_list": lambda spark, sf: flat(_skill_lists(spark, sf)),
    "explode_skills": _exploded,
    "skill_list_stats": lambda spark, sf: rounded(extract.skill_list_stats(_skill_lists(spark, sf))),
    "categorize_skill": _data_categories(skill_category, CATEGORY_SKILLS | DATA_GROUPS),
    "categorize_skill_ml": _data_categories(model_category, MODEL_CATEGORY_SKILLS | DATA_GROUPS),
    "dedup_latest": _latest_events,
    "dedup_first_seen": _first_events,
    "dedup_pairs": _pairs_once,
    "join_skills_jobs": _joined,
    "join_skills_jobs_no_overlap": lambda spark, sf: _joined(spark, sf, "other-"),
    "key_overlap": _overlap,
    "key_partial_match": _partial,
    "common_keys": _common,
    "union_sources": _united,
    "weekly_demand_from_raw": _from_raw,
    "fmt_salary_number": _formatted,
}

PAYLOAD_SQL = """
WITH p AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END AS id,
    o_orderpriority || ' ' || o_orderkey AS title,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN c_name END AS company,
    CASE WHEN o_orderstatus <> 'P' THEN 'Rest of the ' || c_mktsegment END AS description,
    n_name AS place, n_name || '|' || c_mktsegment AS area,
    CASE WHEN o_orderstatus <> 'P' THEN c_acctbal * 10 END AS salary_min,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS salary_max,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END END AS predicted,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'permanent' END AS contract_type,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN c_mktsegment END AS label,
    'https://example.com/job/' || o_orderkey AS redirect_url,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END AS created,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS created_day,
    CAST(c_nationkey AS DOUBLE) AS latitude,
    ['us', 'gb', 'de', 'fr', 'in'][n_regionkey + 1] AS search_country, lower(c_mktsegment) AS search_query
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)
"""

_ID3 = "md5(coalesce(id, '') || '-' || title || '-' || coalesce(company, ''))"
_MID = "(salary_min + salary_max) / 2"
_CURRENCY = "CASE search_country WHEN 'us' THEN 'USD' WHEN 'gb' THEN 'GBP' ELSE 'LOCAL' END"

#: The jobs table of the nested records. Ids are unique, and a missing description was stored as ''.
JOBS_SQL = PAYLOAD_SQL + f""", jobs AS (
  SELECT {_ID3} AS job_id, title, coalesce(company, '') AS company, coalesce(description, '') AS description,
         place AS location, upper(search_country) AS country, salary_min AS salary_min_usd, salary_max AS salary_max_usd,
         {_MID} AS salary_mid_usd, coalesce(label, '') AS category, redirect_url AS url, created_day AS posted_date,
         CASE WHEN description IS NULL THEN '' ELSE 'rest' END AS extracted_skills,
         CASE WHEN description IS NULL THEN 0 ELSE 1 END AS skill_count,
         CAST(year(created_day) AS INTEGER) AS year, CAST(month(created_day) AS INTEGER) AS month
  FROM p)
"""
_JOBS = (
    "job_id, title, company, description, location, country, "
    + ", ".join(r(c) for c in ("salary_min_usd", "salary_max_usd", "salary_mid_usd"))
    + ", category, url, posted_date, extracted_skills, skill_count, year, month"
)

_WORD = r"[\p{L}\p{N}_]"


def _boundary_pattern(term: str) -> str:
    """Whole-word pattern without look-around."""
    before = r"(^|[^\p{L}\p{N}_])" if term[0].isalnum() or term[0] == "_" else _WORD
    after = r"([^\p{L}\p{N}_]|$)" if term[-1].isalnum() or term[-1] == "_" else _WORD
    body = "".join("\\" + c if c in "+.#/-" else c for c in term)
    return before + body + after


def extraction_sql(vocabulary: Vocabulary, column: str = "t") -> str:
    """Joined names found in lower-cased text."""
    parts = []
    for name, spellings in vocabulary.spellings().items():
        tests = " OR ".join(f"regexp_matches({column}, '{_boundary_pattern(s)}')" for s in spellings)
        parts.append(f"CASE WHEN {tests} THEN '{name}' END")
    return f"concat_ws('|', {', '.join(parts)})"


def _documents_sql(select: str) -> str:
    return f"WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS job_id, lower(text) AS t FROM documents) SELECT job_id, {select} FROM d"


_SETS = JOB_SKILLS_SQL + ", sets AS (SELECT job_id, list_sort(list(DISTINCT skill)) AS skills FROM jsv GROUP BY job_id)"


def _categories_sql(groups, default: str, spaced: bool) -> str:
    subject = "replace(skill, '_', ' ')" if spaced else "skill"
    found = extraction_sql(VOCABULARIES["extract_skills_alias"])
    return f"""
WITH s AS (
  SELECT unnest(string_split(skills, '|')) AS skill FROM ({_documents_sql(f"{found} AS skills")}) WHERE skills <> ''
  UNION ALL SELECT p_brand FROM part)
SELECT skill, count(*) AS mentions, {category_sql(subject, groups, default)} AS category FROM s GROUP BY skill"""


SQL = {
    "normalize_posting_nested": PAYLOAD_SQL + f"""
SELECT {_ID3} AS job_id, 'adzuna' AS source, coalesce(id, '') AS source_id, title, coalesce(company, '') AS company,
  coalesce(description, '') AS description, place AS location_display_name, area AS location_area,
  upper(search_country) AS location_country, latitude AS location_latitude, CAST(NULL AS DOUBLE) AS location_longitude,
  {r('salary_min')}, {r('salary_max')}, coalesce(predicted = 1, false) AS salary_is_predicted, {_CURRENCY} AS salary_currency,
  contract_type, CAST(NULL AS VARCHAR) AS contract_time, coalesce(label, '') AS category, redirect_url AS url,
  created AS posted_date, search_query, '2001-12-31T00:00:00' AS ingested_at
FROM p""",
    "normalize_posting_lambda": PAYLOAD_SQL + f"""
SELECT md5(coalesce(id, 'None') || '-' || title) AS job_id, 'adzuna' AS source, coalesce(id, '') AS source_id, title,
  coalesce(company, '') AS company, coalesce(description, '') AS description, place AS location_display_name,
  upper(search_country) AS location_country, latitude AS location_latitude, CAST(NULL AS DOUBLE) AS location_longitude,
  {r('salary_min')}, {r('salary_max')}, coalesce(predicted = 1, false) AS salary_is_predicted,
  coalesce(label, '') AS category, redirect_url AS url, created AS posted_date, search_query,
  '2001-12-31T00:00:00' AS ingested_at
FROM p""",
    "parse_posting_flat": PAYLOAD_SQL + f"""
SELECT 'adzuna_' || coalesce(id, substr(md5(title || '-' || coalesce(company, '') || '-' || place), 1, 12)) AS job_id,
  title, coalesce(company, '') AS company, coalesce(description, '') AS description, place AS location,
  area AS location_area, upper(search_country) AS country, {r('salary_min')}, {r('salary_max')},
  {r(f"coalesce((nullif(salary_min, 0) + nullif(salary_max, 0)) / 2, nullif(salary_min, 0), nullif(salary_max, 0))", 'salary_mid')},
  coalesce(predicted, 0) AS salary_is_predicted, coalesce(contract_type, '') AS contract_type, '' AS contract_time,
  coalesce(label, '') AS category, coalesce(lower(label), '') AS category_tag, redirect_url,
  strftime(coalesce(created_day, DATE '{NOW}'), '%Y-%m-%d %H:%M:%S') AS posted_date, latitude,
  CAST(NULL AS DOUBLE) AS longitude, 'adzuna' AS source, '2001-12-31T00:00:00' AS ingested_at,
  CASE WHEN description IS NULL THEN '' ELSE 'rest' END AS extracted_skills,
  CASE WHEN description IS NULL THEN 0 ELSE 1 END AS skill_count
FROM p""",
    "record_defaults": PAYLOAD_SQL + f"""
SELECT md5(coalesce(id, 'None') || '-' || title) AS job_id, 'adzuna' AS source, title, coalesce(company, '') AS company,
  coalesce(description, '') AS description, place AS location_display_name, '' AS location_area,
  upper(search_country) AS location_country, latitude AS location_latitude, CAST(NULL AS DOUBLE) AS location_longitude,
  {r('salary_min')}, {r('salary_max')}, 'LOCAL' AS salary_currency, coalesce(predicted = 1, false) AS salary_is_predicted,
  created AS posted_date, CASE WHEN label = 'BUILDING' THEN '' ELSE coalesce(label, '') END AS url,
  '2001-12-31T00:00:00' AS ingested_at
FROM p""",
    "job_id_md5_2": PAYLOAD_SQL + "SELECT redirect_url, md5(coalesce(id, 'None') || '-' || title) AS job_id FROM p",
    "job_id_md5_3": PAYLOAD_SQL + f"SELECT redirect_url, {_ID3} AS job_id FROM p",
    "job_id_prefixed": PAYLOAD_SQL + """
SELECT redirect_url,
  'adzuna_' || coalesce(id, substr(md5(title || '-' || coalesce(company, '') || '-' || place), 1, 12)) AS job_id FROM p""",
    "job_id_rowhash": """
SELECT o_orderkey, sha256(concat_ws('||', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) AS job_id FROM orders""",
    "job_id_composite": PAYLOAD_SQL + """
SELECT count(*) AS rows, count(DISTINCT title || '/' || coalesce(company, '') || '/' || place) AS ids FROM p""",
    "currency_for_country": PAYLOAD_SQL + f"SELECT redirect_url, {_CURRENCY} AS currency FROM p",
    "flatten_location": PAYLOAD_SQL + """
SELECT redirect_url, place AS location_display_name, search_country AS location_country FROM p""",
    "flatten_location_scalar": PAYLOAD_SQL + """
SELECT redirect_url, place AS location_display_name, search_country AS location_country FROM p""",
    "flatten_salary": PAYLOAD_SQL + f"""
SELECT redirect_url, {r('salary_min', 'salary_min_usd')}, {r('salary_max', 'salary_max_usd')} FROM p""",
    "flatten_salary_scalar": PAYLOAD_SQL + """, s AS (
  SELECT redirect_url, CASE WHEN salary_max <= 200000 THEN CAST(trunc(salary_max) AS DOUBLE) END AS v FROM p)
SELECT redirect_url, v AS salary_min_usd, v AS salary_max_usd FROM s""",
    "flatten_salary_flat": PAYLOAD_SQL + f"""
SELECT redirect_url, {r('salary_min', 'salary_min_usd')}, {r('salary_max', 'salary_max_usd')} FROM p""",
    "salary_mid_strict": PAYLOAD_SQL + f"SELECT redirect_url, {r(_MID, 'salary_mid')} FROM p",
    "salary_mid_fallback": PAYLOAD_SQL + f""", s AS (
  SELECT redirect_url, CASE WHEN salary_min > 10000 THEN salary_min END AS a, nullif(salary_max, 0) AS b FROM p)
SELECT redirect_url, {r('coalesce((a + b) / 2, a, b)', 'salary_mid')} FROM s""",
    "salary_mid_backfill": PAYLOAD_SQL + f"""
SELECT redirect_url, {r('nullif((coalesce(salary_min, 0) + coalesce(salary_max, 0)) / 2, 0)', 'salary_mid')} FROM p""",
    "coerce_numeric": PAYLOAD_SQL + """
SELECT redirect_url, CASE WHEN salary_min > 50000 THEN NULL ELSE CAST(1250.5 AS DOUBLE) END AS salary_min,
       CAST(7 AS DOUBLE) AS salary_max, CAST(NULL AS DOUBLE) AS salary_mid FROM p""",
    "resolve_posted_date": PAYLOAD_SQL + """
SELECT redirect_url, created_day AS posted_date, CAST(year(created_day) AS INTEGER) AS year,
       CAST(month(created_day) AS INTEGER) AS month FROM p""",
    "resolve_posted_date_default": PAYLOAD_SQL + f"""
SELECT redirect_url, DATE '{NOW}' AS posted_date, CAST(2001 AS INTEGER) AS year, CAST(12 AS INTEGER) AS month FROM p""",
    "coerce_posted_date": PAYLOAD_SQL + """
SELECT redirect_url, strftime(created_day, '%Y-%m-%d %H:%M:%S') AS posted_date FROM p""",
    "impute_posted_date": PAYLOAD_SQL + """
SELECT created_day IS NULL AS date_imputed, count(*) AS rows,
       count(CASE WHEN created_day IS NULL OR year(created_day) = 2023 THEN 1 END) AS in_range, count(*) AS dated
FROM p GROUP BY 1""",
    "ensure_columns": PAYLOAD_SQL + """
SELECT title, redirect_url, CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS category, redirect_url AS url FROM p""",
    "map_columns": """
SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS VARCHAR) AS job_posting_url, o_orderpriority AS title,
       o_totalprice AS salary_max FROM orders""",
    "filter_has_description": PAYLOAD_SQL + "SELECT redirect_url FROM p WHERE description IS NOT NULL",
    "filter_has_title": PAYLOAD_SQL + "SELECT redirect_url FROM p WHERE company IS NOT NULL",
    "filter_has_date": PAYLOAD_SQL + "SELECT redirect_url FROM p WHERE created_day IS NOT NULL",
    "project_jobs": JOBS_SQL + f"SELECT {_JOBS} FROM jobs",
    "project_bulk_jobs": PAYLOAD_SQL + f"""
SELECT redirect_url AS job_id, title, company, description, place AS location, {r('salary_min')}, {r('salary_max')},
  {r('nullif((coalesce(salary_min, 0) + coalesce(salary_max, 0)) / 2, 0)', 'salary_mid')},
  strftime(created_day, '%Y-%m-%d %H:%M:%S') AS posted_date,
  CASE WHEN description IS NULL THEN '' ELSE 'rest' END AS extracted_skills,
  CASE WHEN description IS NULL THEN 0 ELSE 1 END AS skill_count, 'bulk' AS source, '{NOW}' AS ingested_at,
  CAST(year(created_day) AS INTEGER) AS year, CAST(month(created_day) AS INTEGER) AS month
FROM p WHERE salary_max IS NOT NULL""",
    "clean_skill": JOB_SKILLS_SQL + """
SELECT job_id, lower(skill) AS skill FROM jsv WHERE skill NOT IN ('Brand#1', 'Brand#2', 'Brand#3')""",
    "search_postings": JOBS_SQL + f"""
SELECT job_id, title, posted_date, {r('salary_min_usd')} FROM jobs
WHERE lower(title || ' ' || description) LIKE '%rest%' AND lower(title || ' ' || description) LIKE '%building%'
  AND lower(location) LIKE '%nation_1%' AND salary_min_usd >= 20000
  AND posted_date >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 1000
ORDER BY posted_date DESC, job_id LIMIT 20 OFFSET 20""",
    "search_index": JOBS_SQL + f"""
SELECT job_id, title, posted_date, {r('salary_min_usd')} FROM jobs
WHERE list_has_all(regexp_split_to_array(lower(title || ' ' || description), '[^a-z0-9_]+'), ['rest', 'building'])
  AND lower(location) LIKE '%nation_1%' AND salary_min_usd >= 20000
  AND posted_date >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 1000
ORDER BY posted_date DESC, job_id LIMIT 20 OFFSET 20""",
    "list_categories": JOBS_SQL + "SELECT country, category, count(*) AS job_count FROM jobs GROUP BY country, category",
    "salary_histogram": JOBS_SQL + """
SELECT floor(salary_mid_usd / 25000) * 25000 AS salary_from, count(*) AS job_count FROM jobs
WHERE salary_mid_usd IS NOT NULL AND lower(title || ' ' || description) LIKE '%rest%' GROUP BY 1""",
    **{key: _documents_sql(f"{extraction_sql(vocabulary)} AS skills") for key, vocabulary in VOCABULARIES.items()},
    "extract_skills_from": r"""
WITH w AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark),
t AS (SELECT DISTINCT array_to_string(w[:n], ' ') AS s FROM w, range(1, 4) r(n)),
v AS (
  SELECT s, CASE WHEN regexp_matches(s, '^[\p{L}\p{N}_]') THEN '(^|[^\p{L}\p{N}_])' ELSE '[\p{L}\p{N}_]' END
    || regexp_escape(s) || CASE WHEN regexp_matches(s, '[\p{L}\p{N}_]$') THEN '([^\p{L}\p{N}_]|$)' ELSE '[\p{L}\p{N}_]' END AS p
  FROM t WHERE s <> ''),
d AS (SELECT doc_id, lower(text) AS t FROM documents),
f AS (SELECT doc_id, string_agg(replace(s, ' ', '_'), '|' ORDER BY encode(replace(s, ' ', '_'))) AS skills
  FROM d JOIN v ON contains(t, s) AND regexp_matches(t, p) GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS job_id, coalesce(skills, '') AS skills FROM documents LEFT JOIN f USING (doc_id)""",
    "skill_count": _documents_sql(
        f"CAST(CASE WHEN {extraction_sql(TEXT_VOCABULARY)} = '' THEN 0 "
        f"ELSE len(string_split({extraction_sql(TEXT_VOCABULARY)}, '|')) END AS INTEGER) AS skill_count"
    ),
    "skills_passthrough": _SETS + "SELECT job_id, array_to_string(skills, '|') AS extracted_skills FROM sets",
    "parse_skill_list": _SETS + "SELECT job_id, lower(array_to_string(skills, '|')) AS skill_list FROM sets",
    "explode_skills": _SETS + "SELECT job_id, 'US' AS country, unnest(skills) AS skill FROM sets",
    "skill_list_stats": _SETS + f"""
SELECT CAST(sum(len(skills)) AS BIGINT) AS total_skills, {r('avg(len(skills))', 'avg_skills')},
       (SELECT count(DISTINCT skill) FROM jsv) AS unique_skills FROM sets""",
    "categorize_skill": _categories_sql(CATEGORY_SKILLS | DATA_GROUPS, "Other", False),
    "categorize_skill_ml": _categories_sql(MODEL_CATEGORY_SKILLS | DATA_GROUPS, "other", True),
    "dedup_latest": """
SELECT CAST(user_id AS VARCHAR) AS job_id, event_id, event_type AS title, json_extract_string(props, '$.k') AS k
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "dedup_first_seen": """
SELECT CAST(user_id AS VARCHAR) AS job_id, event_id, event_type AS title
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "dedup_pairs": JOB_SKILLS_SQL + """
SELECT DISTINCT a.skill AS skill_a, b.skill AS skill_b FROM jsv a JOIN jsv b ON a.job_id = b.job_id AND a.skill < b.skill""",
    "join_skills_jobs": JOB_SKILLS_SQL + f"""
SELECT job_id, posted_date, {r('o_totalprice', 'salary_mid')}, skill, 'US' AS country, year, month
FROM jsv JOIN orders ON job_id = CAST(o_orderkey AS VARCHAR)""",
    "join_skills_jobs_no_overlap": JOB_SKILLS_SQL + """
SELECT 'other-' || job_id AS job_id, CAST(NULL AS DATE) AS posted_date, CAST(NULL AS DOUBLE) AS salary_mid, skill,
       'US' AS country, CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month FROM jsv""",
    "key_overlap": """
SELECT (SELECT count(DISTINCT l_partkey) FROM lineitem) AS left_keys, (SELECT count(DISTINCT o_orderkey) FROM orders) AS right_keys,
       (SELECT count(*) FROM (SELECT l_partkey FROM lineitem INTERSECT SELECT o_orderkey FROM orders)) AS common_keys""",
    "key_partial_match": """
SELECT DISTINCT l.s_name AS left_key, 'x-' || r.s_name || '-y' AS right_key FROM supplier l JOIN supplier r
ON contains('x-' || r.s_name || '-y', l.s_name) OR contains(l.s_name, 'x-' || r.s_name || '-y')""",
    "common_keys": "SELECT l_partkey AS job_id FROM lineitem INTERSECT SELECT o_orderkey FROM orders",
    "union_sources": JOB_SKILLS_SQL + f"""
SELECT job_id, posted_date, country, {r('salary_mid_usd')}, skill, year, month FROM (SELECT * FROM jsv UNION ALL SELECT * FROM jsv)""",
    "weekly_demand_from_raw": JOB_SKILLS_SQL + f"""
SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, country,
       count(CASE WHEN salary_mid_usd < 90000 THEN job_id END) AS job_count,
       {r("avg(CASE WHEN skill <> 'Brand#1' THEN trunc(salary_mid_usd) END)", 'avg_salary')}
FROM jsv WHERE month NOT IN (1, 12) GROUP BY 1, 2, 3""",
    "fmt_salary_number": """
SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/A' ELSE format('${:,}', CAST(floor(abs(c_acctbal)) AS BIGINT)) END AS salary,
  CASE WHEN c_custkey >= 1000 THEN printf('%.1fM', c_custkey / 1000.0)
       WHEN c_custkey >= 1 THEN printf('%.1fK', CAST(c_custkey AS DOUBLE)) ELSE '0' END AS number
FROM customer""",
}
