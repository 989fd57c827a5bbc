"""Passages across partitions, overlapping ones, and names like the results."""

import random

import pyarrow as pa
import pytest

from jobtide.llm import substrings as sub

SCHEMA = "doc_id long, text string, `start` string, `End` string, words string"


def passages(spark, texts, **options):
    df = spark.createDataFrame([(k, t, "a", "b", "c") for k, t in enumerate(texts)], SCHEMA)
    return sub.repeated_passages(df, **options).collect()


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_planted_passages_whatever_the_partitions(spark, partitions):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    shared = [" ".join(word() for _ in range(rng.randrange(52, 90))) for _ in range(6)]
    texts = []
    for k in range(240):
        lead, tail = (" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(2))
        passage = shared[k % 6]
        texts.append(f"{lead} {passage} {tail}")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = passages(spark, texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.doc_id for r in got) == list(range(240))
    for r in got:  # whole, and beyond it no more than a blank or a short word that stands there by chance
        inside, passage = texts[r.doc_id][r.start : r.end], shared[r.doc_id % 6]
        assert passage in inside and len(inside) <= len(passage) + 10 and r.words == len(inside.split()) and r.n_rows == 40


def test_passages_of_a_row_do_not_overlap(spark):
    texts = [f"start{k} " + "word " * (2_000 + 40_000 * (k == 3)) + f"end{k}" for k in range(8)]
    got = passages(spark, texts)
    assert sorted(r.doc_id for r in got) == list(range(8))
    for r in got:
        inside = texts[r.doc_id][r.start : r.end]
        assert abs(r.words - len(inside.split())) <= 1 and r.words >= 1_900


def test_agreements_across_partitions_equal_those_of_one_table():
    rng = random.Random(2)
    rows = sorted(
        ({"left": False, "h1": rng.randrange(2), "h2": 0, "beside": bytes(rng.choice(b"ab ") for _ in range(rng.randrange(1, 8))), "t": rng.randrange(4), "at": k}
         for k in range(60)),
        key=lambda r: (r["left"], r["h1"], r["h2"], r["beside"], r["t"], r["at"]),
    )
    whole = pa.Table.from_pylist(rows)
    text, agree = whole.column("t").to_numpy(), sub._agreements(whole)
    want = [sub._passed_on(text, agree).tolist(), sub._passed_on(text[::-1], agree[::-1])[::-1].tolist()]
    for _ in range(60):
        cuts = sorted({0, 60, *rng.sample(range(1, 60), rng.randrange(0, 30))})
        parts = []
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            batch = pa.RecordBatch.from_pylist([{**r, "part": number} for r in rows[a:b]])
            parts.append([row for out in sub._grown([batch]) for row in out.to_pylist()])
        ends = [(part[0], part[-1]) for part in parts]
        before, behind = sub._across(ends, False), sub._across(ends, True)
        got = [[], []]
        for part in parts:
            for row in part:
                got[0].append(max(row["forward"], min(before.get(row["part"], 0), row["from_first"])))
                got[1].append(max(row["backward"], min(behind.get(row["part"], 0), row["from_last"])))
        assert got == want
