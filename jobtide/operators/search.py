"""Search by words over an inverted index, with pages that go on behind the last row seen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.dates import reference_date
from jobtide.functions.text import split_words
from jobtide.sources.sinks import ROWS_PER_FILE

#: What an index row holds of its posting, so that a page needs no other table.
SHOWN = ("job_id", "posted_date", "title", "company", "location", "country", "category", "salary_min_usd", "salary_max_usd")


def words_in(*columns: str) -> Column:
    """The distinct words of some text columns, in small letters."""
    return F.array_remove(F.array_distinct(split_words(F.lower(F.concat_ws(" ", *columns)))), "")


def write_search_index(jobs: DataFrame, path: str, buckets: int = 64) -> None:
    """Write the postings of each word of title and description below *path*, and how many each word has.

    Rows are ordered by word, then newest first, over all tasks, so the files of a frequent word are many and a reader skips
    those of other words and of other days. Folders are hash buckets of words. A posting without any word is
    found under the empty word, as all others are.
    """
    words = F.explode(F.array_append(words_in("title", "description"), F.lit("")))
    rows = jobs.select(*[c for c in SHOWN], words.alias("word"))
    rows = rows.withColumns({"bucket": F.pmod(F.hash("word"), F.lit(buckets)), "day": -F.coalesce(F.unix_date("posted_date"), F.lit(-(1 << 30)))})
    order = ["bucket", "word", "day", "job_id"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").options(maxRecordsPerFile=ROWS_PER_FILE, compression="zstd").partitionBy(
        "bucket"
    ).parquet(f"{path}/postings")
    counts = jobs.sparkSession.read.parquet(f"{path}/postings").groupBy("bucket", "word").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{path}/words")
    jobs.sparkSession.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{path}/settings")


def search_index(
    spark: SparkSession, path: str, what: str | None = None, country: str | None = None, where: str | None = None,
    category: str | None = None, max_days_old: int | None = 30, salary_min: float | None = None, results_per_page: int = 50,
    after: tuple[dt.date | None, str] | None = None, as_of: Column | dt.date | str | None = None,
) -> DataFrame:
    """One page of postings that hold all words of *what*, newest first, undated ones last, then by id.

    The rarest word's postings are read, those of the other words only thin them out by id. *after* is day and id of the last
    row of the page before: what stands before it is not read, so any page costs what the first one does. The filters are
    those of :func:`jobtide.operators.normalize.search_postings`, whose words may also be parts of words.
    """
    wanted = sorted(set((what or "").lower().split())) or [""]
    buckets = spark.read.parquet(f"{path}/settings").first()[0]
    counts = {r["word"]: r["n"] for r in spark.read.parquet(f"{path}/words").where(F.col("word").isin(wanted)).collect()}  # the words asked for
    rarest = min(wanted, key=lambda w: (counts.get(w, 0), w))

    def postings(word: str) -> DataFrame:
        bucket = spark.range(1).select(F.pmod(F.hash(F.lit(word)), F.lit(buckets))).first()[0]
        return spark.read.parquet(f"{path}/postings").where((F.col("bucket") == bucket) & (F.col("word") == word))

    df = postings(rarest)
    day = F.col("day")
    if after is not None:
        last = 1 << 30 if after[0] is None else -(after[0] - dt.date(1970, 1, 1)).days
        df = df.where((day >= last) & ((day > last) | (F.col("job_id") > after[1])))
    if max_days_old is not None:
        df = df.where(F.col("posted_date") >= F.date_sub(reference_date(as_of), max_days_old))
    if country:
        df = df.where(F.lower("country") == country.lower())
    if where:
        df = df.where(F.lower("location").contains(where.lower()))
    if category:
        df = df.where(F.col("category") == category)
    if salary_min:
        df = df.where(F.col("salary_min_usd") >= salary_min)
    for word in wanted:
        if word != rarest:
            df = df.join(postings(word).select("job_id"), "job_id", "left_semi")
    return df.orderBy("day", "job_id").limit(results_per_page).select(*SHOWN)
