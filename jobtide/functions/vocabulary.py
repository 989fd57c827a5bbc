"""Skill vocabularies and category tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the terms, aliases and categories that results must agree with. ---

ALIAS_TERMS = (
    "python", "java", "javascript", "typescript", "c++", "c#", "go", "rust", "ruby", "php", "scala", "kotlin",
    "swift", "r",
    "react", "angular", "vue", "svelte", "nextjs", "html", "css", "tailwind",
    "nodejs", "django", "flask", "fastapi", "spring", "rails", "express",
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch", "dynamodb", "snowflake", "bigquery", "redshift",
    "aws", "azure", "gcp", "kubernetes", "docker", "terraform", "serverless",
    "spark", "airflow", "kafka", "dbt", "etl", "data pipeline",
    "machine learning", "deep learning", "tensorflow", "pytorch", "scikit-learn", "nlp", "computer vision", "llm",
    "mlops", "langchain",
    "ci/cd", "jenkins", "github actions", "ansible", "prometheus", "grafana",
)

ALIASES = {
    "react.js": "react", "reactjs": "react", "vue.js": "vue", "node.js": "nodejs", "k8s": "kubernetes",
    "postgres": "postgresql", "mongo": "mongodb", "ml": "machine learning", "dl": "deep learning",
}

ETL_TERMS = (
    "python", "java", "javascript", "typescript", "c++", "go", "rust",
    "react", "angular", "vue", "nodejs", "django", "flask", "fastapi",
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch",
    "aws", "azure", "gcp", "kubernetes", "docker", "terraform",
    "spark", "airflow", "kafka", "dbt",
    "machine learning", "deep learning", "tensorflow", "pytorch",
    "ci/cd", "jenkins", "github actions",
)

FLAT_TERMS = (
    "python", "java", "javascript", "typescript", "c++", "c#", "go", "golang", "rust", "ruby", "php", "scala",
    "kotlin", "swift", "r", "sql", "bash",
    "react", "angular", "vue", "vuejs", "node", "nodejs", "django", "flask", "fastapi", "spring", "springboot",
    "express", "rails", "nextjs", "nuxt", ".net", "dotnet", "laravel", "tensorflow", "pytorch", "keras",
    "scikit-learn", "pandas", "numpy", "spark", "pyspark",
    "postgresql", "postgres", "mysql", "mongodb", "redis", "elasticsearch", "cassandra", "dynamodb", "snowflake",
    "bigquery", "redshift", "oracle", "sql server", "sqlite", "neo4j", "cockroachdb",
    "aws", "azure", "gcp", "google cloud", "kubernetes", "k8s", "docker", "terraform", "ansible", "jenkins",
    "circleci", "github actions", "gitlab", "cloudformation", "pulumi", "helm", "istio", "serverless", "lambda",
    "machine learning", "deep learning", "nlp", "natural language processing", "computer vision", "mlops", "llm",
    "langchain", "openai", "huggingface", "airflow", "kafka", "flink", "dbt", "hadoop", "hive", "presto", "trino",
    "databricks", "sagemaker", "mlflow", "kubeflow", "ray",
    "git", "linux", "unix", "agile", "scrum", "ci/cd", "rest", "graphql", "microservices", "api", "jira",
    "confluence",
)

BULK_TERMS = (
    "python", "java", "javascript", "typescript", "c++", "c#", "go", "rust", "ruby", "php", "scala", "kotlin",
    "swift", "r", "sql",
    "react", "angular", "vue", "nodejs", "django", "flask", "fastapi", "spring", "express", "rails", "nextjs",
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch", "cassandra", "dynamodb", "snowflake", "bigquery",
    "redshift",
    "aws", "azure", "gcp", "kubernetes", "docker", "terraform", "serverless",
    "spark", "airflow", "kafka", "dbt", "hadoop", "flink",
    "machine learning", "deep learning", "tensorflow", "pytorch", "scikit-learn", "nlp", "computer vision", "llm",
    "mlops", "langchain",
    "ci/cd", "jenkins", "github actions", "gitlab", "ansible", "git", "linux", "agile", "scrum",
)

CATEGORY_SKILLS = {
    "Languages": (
        "python", "java", "javascript", "typescript", "c++", "go", "rust", "ruby", "scala", "kotlin", "swift", "r",
        "sql", "bash", "c#", "php",
    ),
    "Frontend": ("react", "angular", "vue", "vuejs", "nextjs", "nuxt"),
    "Backend": (
        "nodejs", "django", "flask", "fastapi", "spring", "springboot", "express", "rails", "laravel", "dotnet",
        "net",
    ),
    "Cloud & Infra": (
        "aws", "azure", "gcp", "google_cloud", "kubernetes", "k8s", "docker", "terraform", "ansible",
        "cloudformation", "pulumi", "helm", "istio", "serverless", "lambda",
    ),
    "Databases": (
        "postgresql", "postgres", "mysql", "mongodb", "redis", "elasticsearch", "cassandra", "dynamodb",
        "snowflake", "bigquery", "redshift", "oracle", "sql_server", "sqlite", "neo4j", "cockroachdb",
    ),
    "ML & AI": (
        "machine_learning", "deep_learning", "tensorflow", "pytorch", "keras", "scikit-learn", "nlp",
        "natural_language_processing", "computer_vision", "mlops", "llm", "langchain", "openai", "huggingface",
        "sagemaker", "mlflow", "kubeflow", "ray",
    ),
    "Data Engineering": (
        "spark", "pyspark", "airflow", "kafka", "flink", "dbt", "hadoop", "hive", "presto", "trino", "databricks",
    ),
    "DevOps & Tools": ("git", "linux", "unix", "ci_cd", "jenkins", "github_actions", "gitlab", "circleci"),
}

MODEL_CATEGORY_SKILLS = {
    "languages": ("python", "java", "javascript"),
    "frontend": ("react", "angular", "vue"),
    "backend": ("nodejs", "django", "flask"),
    "cloud": ("aws", "azure", "gcp", "kubernetes"),
    "databases": ("postgresql", "mongodb", "redis"),
    "ml": ("machine learning", "deep learning", "pytorch", "tensorflow"),
    "data_eng": ("spark", "airflow", "kafka"),
}

# --- End of fixed values. ---


@dataclass(frozen=True)
class Vocabulary:
    """Terms to look for, aliases that stand for a term, and whether names are written as identifiers."""

    terms: tuple[str, ...]
    aliases: dict[str, str] = field(default_factory=dict)
    identifiers: bool = False

    def spellings(self) -> dict[str, list[str]]:
        """Reported name to the spellings that trigger it, in name order."""
        found: dict[str, list[str]] = {}
        for spelling, name in [(t, t) for t in self.terms] + list(self.aliases.items()):
            label = identifier(name) if self.identifiers else name
            found.setdefault(label, []).append(spelling)
        return dict(sorted(found.items()))


def identifier(name: str) -> str:
    """``sql server`` to ``sql_server``, ``.net`` to ``net``, ``ci/cd`` to ``ci_cd``."""
    return name.replace(" ", "_").replace(".", "").replace("/", "_")


ALIAS_VOCABULARY = Vocabulary(ALIAS_TERMS, ALIASES)
ETL_VOCABULARY = Vocabulary(ETL_TERMS)
FLAT_VOCABULARY = Vocabulary(FLAT_TERMS, identifiers=True)
BULK_VOCABULARY = Vocabulary(BULK_TERMS)


def _lookup(skill: Column, groups: dict[str, tuple[str, ...]], default: str) -> Column:
    chain = None
    for name, members in groups.items():
        test = skill.isin(*members)
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def skill_category(skill: Column, groups: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Display category of a skill, ``Other`` when unlisted."""
    return _lookup(skill, CATEGORY_SKILLS if groups is None else groups, "Other")


def model_category(skill: Column, groups: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Category used by the features; identifiers and spaced names of one skill fall together."""
    spaced = F.replace(skill, F.lit("_"), F.lit(" "))
    return _lookup(spaced, MODEL_CATEGORY_SKILLS if groups is None else groups, "other")
