"""Every registered query against its SQL on the smallest data set."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from jobtide.plans import registered
from tests.oracle import compare, connect

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["skill", "job_count", "avg_salary", "min_salary", "max_salary"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, duck, name):
    ok, note = compare(spark, duck, name, QUERIES[name], SQL[name], sf)
    assert ok, note


def test_core_stands_without_the_text_operators(tmp_path):
    """The library without its text folders, with and without the pipeline module."""
    root = Path(contract.__file__).parent
    for keep_pipeline in (True, False):
        copy = tmp_path / str(keep_pipeline)
        shutil.copytree(root / "jobtide", copy / "jobtide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * keep_pipeline:
            shutil.copy(root / name, copy)
        code = "import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()), any(n.startswith('op') for n in c.queries()))"
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
        assert out.stdout.split() == [str(len(registered.queries())), str(len(registered.oracle_sql())), "False"]
