"""Skill extraction from free text and from skill lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import contains_word, split_words, words_of
from jobtide.functions.vocabulary import ALIAS_VOCABULARY, Vocabulary
from jobtide.plans.store import stored

_LOWERED, _WORDS, _ENTRIES = "_lowered_text", "_known_words", "_entries"


def _known_words(lowered: Column, vocabulary: Vocabulary) -> Column:
    """The words of the text that some spelling of the vocabulary contains."""
    wanted = sorted({w for spellings in vocabulary.spellings().values() for s in spellings for w in words_of(s)})
    return F.array_intersect(split_words(lowered), F.array(*[F.lit(w) for w in wanted]))


def skills_in(lowered: Column, words: Column, vocabulary: Vocabulary) -> Column:
    """Names found in lower-cased text, sorted and distinct because each is tested once, in name order."""
    hits = []
    for name, spellings in vocabulary.spellings().items():
        found = reduce(lambda a, b: a | b, [contains_word(lowered, words, spelling) for spelling in spellings])
        hits.append(F.when(found, F.lit(name)))
    return F.array_compact(F.array(*hits))


def extract_skills(
    df: DataFrame, text: str = "description", vocabulary: Vocabulary = ALIAS_VOCABULARY, out: str = "extracted_skills"
) -> DataFrame:
    """Add the array of skills named in *text*; NULL and empty text give an empty array.

    The text is split once and reduced to the few words the vocabulary knows; all tests run on those. Everything is
    native, so extraction needs neither a Python worker nor a shuffle, and its cost hardly grows with the vocabulary.
    """
    lowered = df.withColumn(_LOWERED, F.lower(F.col(text)))
    split = lowered.withColumn(_WORDS, _known_words(F.col(_LOWERED), vocabulary))
    return split.withColumn(out, skills_in(F.col(_LOWERED), F.col(_WORDS), vocabulary)).drop(_LOWERED, _WORDS)


def vocabulary_rows(vocabulary: DataFrame) -> DataFrame:
    """(name, spelling, anchor, whole, pattern) of a vocabulary table of (name, spelling).

    The anchor is the word of the spelling that the fewest spellings have, the longest of those; a text without it cannot hold
    the spelling. *whole* tells that the spelling is one word, so that its presence is all there is to test. A spelling
    without any word has the empty anchor.
    """
    word = r"[\p{L}\p{N}_]"
    known = vocabulary.select("name", F.lower("spelling").alias("spelling")).where(F.length("spelling") > 0).dropna().distinct()
    words = known.withColumn("words", F.array_distinct(F.regexp_extract_all("spelling", F.lit(f"{word}+"), F.lit(0))))
    counts = words.select(F.explode("words").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    ranked = words.select("name", "spelling", F.explode_outer("words").alias("anchor")).join(counts, "anchor", "left")
    rarest = F.min(F.struct("n", -F.length("anchor"), "anchor")).alias("best")
    chosen = ranked.groupBy("name", "spelling").agg(rarest).select("name", "spelling", F.coalesce("best.anchor", F.lit("")).alias("anchor"))
    first, last = F.substring("spelling", 1, 1).rlike(word), F.substring("spelling", -1, 1).rlike(word)
    before = F.when(first, F.lit(f"(?<!{word})")).otherwise(F.lit(f"(?<={word})"))
    after = F.when(last, F.lit(f"(?!{word})")).otherwise(F.lit(f"(?={word})"))
    literal = F.concat(F.lit("\\Q"), "spelling", F.lit("\\E"))  # small letters never end the quotation
    return chosen.withColumns({"whole": F.col("spelling") == F.col("anchor"), "pattern": F.concat(before, literal, after)})


def extract_skills_from(
    df: DataFrame, vocabulary: DataFrame, text: str = "description", out: str = "extracted_skills"
) -> DataFrame:
    """Add the array of names whose spellings stand in *text* as whole words, for a vocabulary in a table (name, spelling).

    The same as :func:`extract_skills` for thousands of terms: the plan does not grow with the vocabulary, which reaches the
    tasks as one value (about 200 bytes a spelling). A text is split once; its words are intersected with the
    anchors, and only spellings whose anchor it holds are searched for. Names are sorted and distinct, spellings inside
    longer ones count too. NULL and empty text give an empty array. No Python, no shuffle of the texts.
    """
    rows = stored(vocabulary_rows(vocabulary), "vocabulary")
    entry = F.struct("name", "spelling", "anchor", "whole", "pattern")
    kind = rows.select(entry.alias("e")).schema["e"].dataType.simpleString()
    entries = F.coalesce(rows.agg(F.array_sort(F.collect_list(entry))).scalar(), F.array().cast(f"array<{kind}>"))
    anchors = F.coalesce(rows.agg(F.collect_set("anchor")).scalar(), F.array().cast("array<string>"))
    split = df.withColumn(_LOWERED, F.lower(F.col(text)))
    split = split.withColumn(_WORDS, F.array_intersect(F.array_append(split_words(F.col(_LOWERED)), F.lit("")), anchors))

    def stands(e: Column) -> Column:
        spelled = F.contains(F.col(_LOWERED), e["spelling"]) & F.rlike(F.col(_LOWERED), e["pattern"])
        return F.array_contains(_WORDS, e["anchor"]) & (e["whole"] | spelled)

    split = split.withColumn(_ENTRIES, entries)
    found = F.filter(_ENTRIES, stands)
    names = F.array_sort(F.array_distinct(F.transform(found, lambda e: e["name"])))
    named = F.when(F.size(_WORDS) > 0, names)
    return split.withColumn(out, F.coalesce(named, F.array().cast("array<string>"))).drop(_LOWERED, _WORDS, _ENTRIES)


def skills_passthrough(
    df: DataFrame, text: str = "description", vocabulary: Vocabulary = ALIAS_VOCABULARY
) -> DataFrame:
    """Keep skills that were extracted before; otherwise extract, or give none when there is no text."""
    if "extracted_skills" in df.columns:
        return df
    if text in df.columns:
        return extract_skills(df, text, vocabulary)
    return df.withColumn("extracted_skills", F.array().cast("array<string>"))


def skill_count(df: DataFrame) -> DataFrame:
    """Size of the skill array; an existing count is kept."""
    if "skill_count" in df.columns:
        return df
    return df.withColumn("skill_count", F.coalesce(F.size("extracted_skills"), F.lit(0)))


def parse_skill_list(column: Column) -> Column:
    """Skills of one text cell: a bracketed list, or parts between the first of ``,`` ``|`` ``;`` that occurs.

    Quoted items of a bracketed list are taken as they stand between their quotes, so commas and apostrophes
    inside them are safe. A bracketed text that is not a list of quoted items or numbers is split like any other.
    """
    text = F.trim(column.cast("string"))
    item = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[-+]?[0-9]+(?:\.[0-9]+)?"""
    is_list = text.rlike(rf"(?s)^\[\s*+(?:(?:{item})\s*+(?:,\s*+(?:{item})\s*+)*+,?\s*+)?\]$")
    quoted = F.transform(
        F.regexp_extract_all(text, F.lit(f"({item})"), F.lit(1)),
        lambda part: F.regexp_replace(F.regexp_replace(part, r"""(?s)^['"](.*)['"]$""", "$1"), r"\\(.)", "$1"),
    )
    parts = (
        F.when(is_list, quoted)
        .when(text.contains(","), F.split(text, ","))
        .when(text.contains("|"), F.split(text, r"\|"))
        .when(text.contains(";"), F.split(text, ";"))
        .otherwise(F.array(text))
    )
    tidy = F.filter(F.transform(parts, lambda part: F.lower(F.trim(part))), lambda part: part != "")
    none = F.array().cast("array<string>")
    return F.when(text.isNull() | (text == "") | (F.lower(text) == "nan"), none).otherwise(tidy)


def explode_skills(
    jobs: DataFrame, skills: str = "extracted_skills", keep: tuple[str, ...] = (), country: str | None = None
) -> DataFrame:
    """Junction rows: one per posting and skill, without NULL or empty names.

    The outer form of explode, because the plain one brings a filter on the size of the array, in which the optimizer writes
    out an extraction once more, with the text split for every term.
    """
    columns = [F.col(c) for c in keep or ("job_id", "posted_date", "country", "salary_mid_usd", "year", "month")
               if not (country and c == "country")]
    if country:
        columns.append(F.lit(country).alias("country"))
    exploded = jobs.select(*columns, F.explode_outer(skills).alias("skill"))
    return exploded.filter(F.col("skill").isNotNull() & (F.col("skill") != ""))


def skill_list_stats(df: DataFrame, skills: str = "skill_list") -> DataFrame:
    """Total and mean skills per posting and the number of distinct skills."""
    sized = df.agg(F.sum(F.size(skills)).alias("total_skills"), F.avg(F.size(skills)).alias("avg_skills"))
    distinct = df.select(F.explode_outer(skills).alias("skill")).agg(F.countDistinct("skill").alias("unique_skills"))
    return sized.withColumn("unique_skills", distinct.scalar())
