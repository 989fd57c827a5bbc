import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from jobtide.functions.vocabulary import (
    ALIAS_VOCABULARY, BULK_VOCABULARY, ETL_VOCABULARY, FLAT_VOCABULARY, Vocabulary, identifier, model_category,
    skill_category,
)
from jobtide.operators import extract

TEXTS = [
    "Our stack: AWS lambdas in python, packed with docker, run by Kubernetes; the front end is react.",
    "You train PyTorch and tensorflow models, love machine learning and write SQL",
    "React.js and Node.js on k8s, Postgres; vue.js too", "C++ dev", "C++11 and C#7", "asp.net or .net", "é java éjava",
    "R&D in r", "javascript only", "CI/CD with GitHub Actions", "ci / cd", "machine  learning", "machine\nlearning",
    "scikit-learn, scikit learn", "data pipeline(s) data pipelines", "node_js python_3 python-3", "", None, "   ",
    "go go go rust", "spring boot springboot", "ŕ java, JAVA; jAvA", "x.net.", "sql server/sql  server", "日本java語 java",
    "google cloud, lambda λ", "Python²", "rest-api REST api_v2 ray", "deep learning and machine learning with computer vision",
]


def by_regex(text, vocabulary):
    if not text:
        return []
    lowered = text.lower()
    found = set()
    for name, spellings in vocabulary.spellings().items():
        if any(re.search(r"\b" + re.escape(s) + r"\b", lowered) for s in spellings):
            found.add(name)
    return sorted(found)


@pytest.mark.parametrize("vocabulary", [ALIAS_VOCABULARY, ETL_VOCABULARY, FLAT_VOCABULARY, BULK_VOCABULARY])
def test_matches_regex_word_search(spark, vocabulary):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, description string")
    found = {r.id: r.extracted_skills for r in extract.extract_skills(df, "description", vocabulary).collect()}
    assert found == {i: by_regex(t, vocabulary) for i, t in enumerate(TEXTS)}


def test_whole_documents_match_regex_search(spark, sf):
    vocabulary = Vocabulary(("the", "of the", "le", "la", "que", "r", "rest"), {"les": "le"})
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("description"))
    found = extract.extract_skills(df, "description", vocabulary).collect()
    assert found and all(r.extracted_skills == by_regex(r.description, vocabulary) for r in found)


def test_vocabulary_sizes():
    sizes = [len(v.terms) for v in (ALIAS_VOCABULARY, ETL_VOCABULARY, FLAT_VOCABULARY, BULK_VOCABULARY)]
    assert sizes == [len(set(v.terms)) for v in (ALIAS_VOCABULARY, ETL_VOCABULARY, FLAT_VOCABULARY, BULK_VOCABULARY)]
    assert sizes[1] == 36 and len(ALIAS_VOCABULARY.aliases) == 9


def test_identifiers():
    assert [identifier(n) for n in ("sql server", ".net", "ci/cd")] == ["sql_server", "net", "ci_cd"]


def test_parse_skill_list(spark):
    cases = {
        "python, java": ["python", "java"], "['Python','Java']": ["python", "java"], "python|java": ["python", "java"],
        "python; java ;": ["python", "java"], "Python": ["python"], "": [], "nan": [], "  ": [], None: [],
        '["it\'s", "a, b"]': ["it's", "a, b"], "[python, java]": ["[python", "java]"], "a|b,c": ["a|b", "c"],
        "[]": [], "['one']": ["one"], "[1, 2.5]": ["1", "2.5"], "['a\\'b']": ["a'b"], "['a', ]": ["a"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    parsed = {r.text: r.parsed for r in df.withColumn("parsed", extract.parse_skill_list(F.col("text"))).collect()}
    assert parsed == cases


def test_parse_long_list_does_not_recurse(spark):
    names = [f"skill {i}" for i in range(20_000)]
    text = "[" + ", ".join(repr(n) for n in names) + "]"
    df = spark.createDataFrame([(text,)], "text string").select(extract.parse_skill_list(F.col("text")).alias("s"))
    assert df.first().s == names


def test_skill_count_and_passthrough(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", None)], "job_id string, extracted_skills array<string>")
    assert extract.skills_passthrough(df) is df
    counted = {r.job_id: r.skill_count for r in extract.skill_count(df).collect()}
    assert counted == {"a": 2, "b": 0}
    kept = extract.skill_count(df.withColumn("skill_count", F.lit(7)))
    assert {r.skill_count for r in kept.collect()} == {7}


def test_explode_drops_empty(spark, rows):
    df = spark.createDataFrame([("a", ["x", "", None]), ("b", []), ("c", None)], "job_id string, extracted_skills array<string>")
    assert rows(extract.explode_skills(df, keep=("job_id",), country="US")) == [("a", "US", "x")]


def test_categories(spark):
    df = spark.createDataFrame([("python",), ("machine_learning",), ("machine learning",), ("cobol",)], "skill string")
    got = {r.skill: (r.a, r.b) for r in df.select("skill", skill_category(F.col("skill")).alias("a"), model_category(F.col("skill")).alias("b")).collect()}
    assert got == {
        "python": ("Languages", "languages"), "machine_learning": ("ML & AI", "ml"), "machine learning": ("Other", "ml"),
        "cobol": ("Other", "other"),
    }


def test_vocabulary_of_thousands_equals_a_search_per_term(spark):
    rng = random.Random(4)
    parts = ["java", "c++", "c#", ".net", "node", "é", "ß1", "go", "-", "x_y", "r&d", "\\E", "a.b", "(", "js"]
    words = parts + [f"w{i}" for i in range(3_000)]
    terms = {" ".join(rng.choice(words) for _ in range(rng.choice((1, 1, 2, 3)))) for _ in range(5_500)}
    terms |= {"c++", ".net", "++", "-", "java", "java script", "\\E"}
    text_words = words[:15] * 20 + words
    texts = ["".join(rng.choice(text_words) + rng.choice((" ", " ", ", ", "", "\n")) for _ in range(rng.randrange(0, 120))).upper() for _ in range(60)]
    texts += [None, "", "Java", "C++11 c++ .NET asp.net", " - "]
    vocabulary = spark.createDataFrame([(f"n:{t}", t) for t in sorted(terms)], "name string, spelling string")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, description string")
    out = extract.extract_skills_from(df, vocabulary)
    patterns = {t: regex.compile(python_pattern(t.lower())) for t in terms}
    for row in out.collect():
        lowered = (texts[row.id] or "").lower()
        want = sorted((f"n:{t}" for t in terms if t.lower() in lowered and patterns[t].search(lowered)), key=str.encode)
        assert row.extracted_skills == want, row.id
    small = extract.extract_skills_from(df, vocabulary.limit(3))
    length = lambda frame: len(frame._jdf.queryExecution().analyzed().toString())
    assert length(out) < 2 * length(small)
    assert extract.extract_skills_from(df, vocabulary.limit(0)).select(F.max(F.size("extracted_skills"))).first()[0] == 0


def python_pattern(term):
    word = r"[\p{L}\p{N}_]"
    before = f"(?<!{word})" if regex.match(word, term[0]) else f"(?<={word})"
    return before + regex.escape(term) + (f"(?!{word})" if regex.match(word, term[-1]) else f"(?={word})")


def test_exploding_what_was_extracted_extracts_once(spark):
    """No filter before the explosion repeats the extraction, and empty or missing arrays still give no rows."""
    df = spark.createDataFrame([(1, "spark and sql"), (2, ""), (3, None), (4, "nothing")], "job_id int, description string")
    rows = extract.explode_skills(extract.extract_skills(df, "description", Vocabulary(("spark", "sql"))), keep=("job_id",))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in plan and plan.count("split(") == 1
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "spark"), (1, "sql")]
