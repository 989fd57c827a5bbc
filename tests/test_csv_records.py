"""Split multi-line CSV against the reader that gives a file to one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from jobtide.sources import csv_records as cr


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts(rng, rows):
    pieces = ['"', '""', "\n", "\n\n", ",", "word", "ü", " ", "'", "x" * 40, "\n\"quoted\"\n", ";"]
    return [["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 9))) or "v" for _ in range(3)] for _ in range(rows)]


def write(path, rows, header=("a", "b b", "c"), **options):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n", **options).writerows([header, *rows])


@pytest.mark.parametrize("size", [60, 333, 5_000, 1 << 20])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    folder = tmp_path / "postings.csv"
    folder.mkdir()
    for k in range(3):
        write(folder / f"part-{k}.csv", texts(rng, 150), quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL)
    write(folder / "part-8.csv", [["long", "\n".join(["line, \"x\""] * 400), "end"], ["1", "2", "3"]])
    write(folder / "part-9.csv", [])
    small_splits(size)
    got = cr.read_csv_records(spark, str(folder))
    want = spark.read.options(header=True, multiLine=True, escape='"').csv(str(folder))
    assert got.columns == want.columns
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(want)
    tasks = cr._lines(spark, [str(folder)]).rdd.getNumPartitions()
    assert tasks > 20 if size < 1_000 else tasks >= 1


def test_records_across_many_ranges(spark, tmp_path, small_splits):
    path = tmp_path / "one.csv"
    rows = [[str(i), "\n".join(f"{i}-{j}" for j in range(i * 7 % 90)), "e"] for i in range(120)]
    write(path, rows)
    small_splits(64)
    got = cr.read_csv_records(spark, str(path)).collect()
    assert sorted(((r.a, r["b b"] or "", r.c) for r in got), key=lambda r: int(r[0])) == [tuple(r) for r in rows]
    found = cr.csv_records(spark, [str(path)])
    assert found.where("first").count() == 1 and found.count() == 121


def test_windows_line_ends_headers_and_blank_records(spark, tmp_path):
    path = tmp_path / "crlf.csv"
    path.write_bytes('﻿id,"two\nlines",n\r\n1,"a\r\nb",2\r\n\r\n3,,\r\n'.encode())
    got = cr.read_csv_records(spark, str(path))
    assert got.columns == ["id", "two\nlines", "n"]
    assert sorted(map(tuple, got.collect())) == [("1", "a\r\nb", "2"), ("3", None, None)]
    typed = cr.read_csv_records(spark, str(path), spark.createDataFrame([], "id int, t string, n double").schema)
    assert sorted(map(tuple, typed.select("id", "n").collect())) == [(1, 2.0), (3, None)]
    with pytest.raises(ValueError):
        empty = tmp_path / "empty.csv"
        empty.write_bytes(b"")
        cr.read_csv_records(spark, str(empty))


def test_a_range_counts_only_its_own_marks(spark):
    rows = [(1, 0, 'a,"b'), (1, 9, 'c"'), (1, 20, 'd,"e" "'), (1, 30, "f"), (1, 40, '"'), (2, 0, "x")]
    lines = spark.createDataFrame(rows, "file long, block long, line string")
    got = {(r.file, r.block): r.open for r in cr.open_blocks(lines).collect()}
    assert got == {(1, 0): False, (1, 9): True, (1, 20): False, (1, 30): True, (1, 40): True, (2, 0): False}
    assert cr.open_blocks(lines).where(F.col("open")).count() == 3
