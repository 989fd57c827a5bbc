"""The manifest against hashlib, by rows of Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from jobtide.llm.manifest import build_tree, dataset_manifest, descend, whole_path


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_above(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    found = []
    for nodes in levels[:-1]:
        start = at // 16 * 16
        found.append((nodes[start:at], nodes[at + 1 : start + 16]))
        at //= 16
    return found


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: levels_above([leaf(r) for r in groups[name]]) for name in names}
    top = levels_above([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            path = siblings(trees[name], at) + siblings(top, k)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf((*row[:4], small(row[4])) if changed else row)
            for left, right in path:
                node = digest("".join(left) + node + "".join(right))
            proof = digest("".join(x for left, right in path for x in left + right))
            out.append((row[0], leaf(row), trees[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, `Digest` string, path string, part string"


@pytest.mark.parametrize("sources, rows", [(1, 1), (1, 16), (1, 17), (1, 700), (16, 16), (17, 40), (300, 900)])
def test_equals_hashlib(spark, sources, rows):
    data = [
        (at * 7 % rows, None if at % sources == 0 else f"é{at % sources}", None if at % 5 else "en", at, f"Text {at} ÄÖ Ω A")
        for at in range(rows)
    ]
    table = spark.createDataFrame([(*row, "a", "b", "c", "d") for row in data], SCHEMA)
    out = dataset_manifest(table)
    assert out.columns == ["doc_id", "source", "lang", "n_chars", "text", "Digest", "path", "part", "leaf", "subroot", "root",
                           "proof_sha256", "folded_root", "verified"]
    got = out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == expected(data)


def test_odd_rows(odd, empty):
    got = dataset_manifest(odd, carry=["doc_id"]).collect()
    rows = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert dataset_manifest(empty).collect() == []


def test_one_source_holds_nearly_all_rows_and_copies(spark):
    rows = [(at // 3, "hot" if at % 50 else f"s{at}", "en", 3, "Abc" * (at % 4)) for at in range(2_000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    got = dataset_manifest(table, carry=["doc_id"]).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_requests_descend_to_their_own_leaves_only(spark):
    nodes = [(tree, size, rank, digest(f"{tree}/{rank}")) for tree, size in ((0, 1), (1, 5), (2, 300), (3, 5_000)) for rank in range(size)]
    tree = build_tree(spark.createDataFrame(nodes, "tree long, size long, rank long, digest string"), "asked")
    records = {r.digest: r.children for r in tree.records().collect()}
    assert all(digest("".join(children)) == key for key, children in records.items())
    tops = tree.tops.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    wanted = [(0, 0), (1, 4), (2, 299), (2, 40), (2, 41), (3, 4_097)]
    found = descend(tree, tops, spark.createDataFrame(wanted, "tree long, rank long"))
    assert sorted((r.tree, r.run) for r in found.collect()) == [(0, 0), (1, 0), (2, 2), (2, 18), (3, 256)]
    asked = spark.createDataFrame(wanted, "t long, rank long").join(found, (F.col("t") == F.col("tree")) & (F.expr("rank div 16") == F.col("run")))
    for row in asked.select("t", "rank", whole_path(F.col("rank")).alias("path")).collect():
        levels = levels_above([d for t, _, _, d in nodes if t == row.t])
        assert [(s.left, s.right) for s in row.path] == [("".join(a), "".join(b)) for a, b in siblings(levels, row.rank)]


def test_paths_are_never_broadcast(spark):
    """Whatever the optimizer takes them for: the paths of millions of runs are gigabytes."""
    nodes = [(0, 300, rank, digest(f"{rank}")) for rank in range(300)]
    tree = build_tree(spark.createDataFrame(nodes, "tree long, size long, rank long, digest string"), "shuffled")
    tops = tree.tops.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    found = descend(tree, tops)
    assert found.count() == 19
    assert "SortMergeJoin [digest" in plan(found) and "Broadcast" not in plan(found)
    table = spark.createDataFrame([(at, "s", "en", 1, "a") for at in range(300)], "doc_id long, source string, lang string, n_chars long, text string")
    joins = [line for line in plan(dataset_manifest(table)).splitlines() if "Join" in line and ("[digest" in line or "run#" in line)]
    assert joins and all("SortMergeJoin" in line for line in joins)
