"""Merkle manifest of a table: digests of rows, trees of digests per source, one root, and proofs by descent from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.frames import packed, with_columns
from jobtide.plans.store import stored

#: Children of a node, and the bits by which a row's number within a partition is shifted in its running number.
FAN, SHIFT = 16, 33
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def joined_digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    texts = [value.cast("string") for value in values]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return joined_digest(*[F.coalesce(part, F.lit("-")) for part in sized])


def height(size: Column) -> Column:
    """Levels above the leaves of a tree of that many leaves."""
    levels = [(size > FAN**level).cast("int") for level in range(15)]
    return sum(levels[1:], levels[0])


def _placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows in global order over partitions, with ``part`` and the running number ``at``, whose rest by part ascends."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(spread.withColumn("at", F.monotonically_increasing_id()), name)
    return placed.withColumn("part", F.shiftright("at", SHIFT))


@dataclass(frozen=True)
class Tree:
    """``levels[i]`` holds the nodes of level i + 1: tree, size, rank, digest, children; ``tops`` one row per tree."""

    levels: list[DataFrame]
    tops: DataFrame

    def records(self) -> DataFrame:
        """(digest, children), each digest once."""
        parts = [level.select("digest", "children") for level in self.levels]
        if not parts:
            return self.tops.select("digest", F.array("digest").alias("children")).limit(0)
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found.dropDuplicates(["digest"])


def build_tree(leaves: DataFrame, name: str) -> Tree:
    """Trees over rows of (tree, size, rank, digest), rank from 0; every run of FAN nodes becomes a node until one is left."""
    columns = ["tree", "size", "rank", "digest"]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    nodes = leaves.select(*columns)
    tops, levels = nodes.where("size = 1"), []
    while FAN ** len(levels) < largest:
        below = FAN ** len(levels)
        run = nodes.where(F.col("size") > below).groupBy("tree", "size", F.expr(f"rank div {FAN}").alias("run"))
        ordered = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        grown = run.agg(F.transform(ordered, lambda node: node["digest"]).alias("children"))
        grown = grown.withColumn("digest", joined_digest(F.array_join("children", "")))
        nodes = stored(grown.select("tree", "size", F.col("run").alias("rank"), "digest", "children"), f"{name}-{len(levels) + 1}")
        levels.append(nodes)
        tops = tops.unionByName(nodes.where((F.col("size") > below) & (F.col("size") <= below * FAN)).select(*columns))
    return Tree(levels, tops.select("tree", "size", "digest"))


def _siblings(children: Column, at: Column) -> Column:
    """The other children of a run: those before the place *at* (from 0) and those behind it."""
    left = F.array_join(F.slice(children, F.lit(1), at), "")
    return F.struct(left.alias("left"), F.array_join(F.slice(children, at + 2, F.lit(FAN)), "").alias("right"))


def descend(tree: Tree, tops: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Follow requests from the tops of the trees down to the runs of leaves.

    *tops* has (tree, size, digest, path); path holds what was collected above, from the root on. A request is (tree,
    rank); without *requests* every leaf is asked for. Requests with common first digits of their rank, in base FAN, are
    one row until they part. Each step looks the digest up among the records of its level, goes on to the child that the
    next digit selects, and adds the children not selected to the path. Returns (tree, size, run, children, path) with
    a row per run of leaves that a request falls in; a tree of one leaf is a run of its own.
    """
    def wanted(found: DataFrame, level: int) -> DataFrame:
        if requests is None:
            return found
        digits = requests.select("tree", F.expr(f"rank div {FAN**level}").alias("run")).distinct()
        return found.join(digits, ["tree", "run"], "left_semi")

    columns = ["tree", "size", "run", "digest", "path"]
    tops = tops.withColumn("run", F.lit(0).cast("long")).withColumn("height", height(F.col("size")))
    alone = wanted(tops.where("height = 0"), 0).select("tree", "size", "run", F.array("digest").alias("children"), "path")
    state = None
    for level in range(len(tree.levels), 0, -1):
        entering = wanted(tops.where(F.col("height") == level).select(*columns), level)
        state = entering if state is None else state.unionByName(entering)
        records = tree.levels[level - 1].select("digest", "children").dropDuplicates(["digest"])
        found = state.join(records.hint("merge"), "digest")  # paths are far longer than the optimizer takes them to be: not to the driver
        if level == 1:
            return found.select("tree", "size", "run", "children", "path").unionByName(alone)
        split = found.select("tree", "size", "run", "path", "children", F.posexplode("children").alias("digit", "child"))
        state = split.select(
            "tree", "size", (F.col("run") * FAN + F.col("digit")).alias("run"), F.col("child").alias("digest"),
            F.concat("path", F.array(_siblings(F.col("children"), F.col("digit")))).alias("path"),
        )
        state = wanted(state, level - 1)
    return alone


def whole_path(rank: Column) -> Column:
    """Siblings from the leaf up to the root, for a leaf of a run that :func:`descend` returned."""
    at = (rank % FAN).cast("int")
    own = F.concat("path", F.array(_siblings(F.col("children"), at)))
    return F.reverse(F.when(F.col("size") > 1, own).otherwise(F.col("path")))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, step: joined_digest(step["left"], node, step["right"]))


def dataset_manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text", tamper_modulus: int = 5, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Root, subroots and a checked proof for every row.

    A leaf is the digest of the row's *fields*. Per *group_col*, leaves ascend by *id_col* and are grouped by sixteens
    until one node, the subroot, is left; subroots in the order of their groups give the root likewise. Proofs come from
    a descent from the root through stored records of digest and children. Rows whose id's crc32 *tamper_modulus* divides
    are checked with the capital letters A-Z of *text_col* made small, all others as they are.

    Returns the columns *carry* (default: all), ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and
    ``verified``; input columns of these names are replaced. NULL groups are one group and come first, NULL ids come
    first in their group and are never tampered with, NULL and empty values have different digests. Rows with equal ids
    are ordered by their digest, so equal tables have equal roots whatever the order of their rows; repeated rows are
    leaves of their own. An empty table gives an empty result.

    Only digests are sorted and shuffled, never texts. The order is global, by range, so a group of any size is spread
    over partitions; ranks come from the partitions' counts.
    """
    columns = list(docs.columns if carry is None else carry)
    value = {name: F.col(f"`{name}`") for name in {*fields, id_col, group_col, text_col}}
    leaf = leaf_digest([value[name] for name in fields])
    changed = leaf_digest([
        F.translate(value[name].cast("string"), UPPER, LOWER) if name == text_col else value[name] for name in fields
    ])
    tampered = F.coalesce(F.crc32(value[id_col].cast("string")) % tamper_modulus == 0, F.lit(False))
    group = F.coalesce(F.concat(F.lit("="), value[group_col].cast("string")), F.lit(""))  # NULL is before all, bytes decide
    leaves = stored(docs.select(
        group.alias("group"), value[id_col].alias("id"), leaf.alias("digest"), F.when(tampered, changed).alias("tampered"),
        packed(docs, columns).alias("row"),
    ).withColumn("number", F.monotonically_increasing_id()), "merkle-leaves")
    placed = _placed(leaves, ["group", "id", "digest", "number"], "merkle-sorted")

    runs = stored(placed.groupBy("part", "group").agg(F.min("at").alias("start"), F.count("*").alias("rows")), "merkle-runs")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    groups = _placed(runs.groupBy("group").agg(F.sum("rows").alias("size")), ["group"], "merkle-groups")
    parts = groups.groupBy("part").agg(F.count("*").alias("rows")).select("part", before.alias("before"))  # a row per partition
    tree = F.col("at") - F.shiftleft("part", SHIFT) + F.col("before")
    groups = stored(groups.join(parts, "part").select("group", "size", tree.alias("tree")), "merkle-trees")
    in_group = F.coalesce(F.sum("rows").over(earlier.partitionBy("group")), F.lit(0))
    places = runs.select("part", "group", (in_group - F.col("start")).alias("shift")).join(groups, "group")
    leaves = placed.join(stored(places, "merkle-places"), ["part", "group"]).select(
        "tree", "size", (F.col("at") + F.col("shift")).alias("rank"), "digest", "tampered", "row"
    )

    trees = build_tree(leaves, "merkle")
    count = groups.count()
    subroots = trees.tops.select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("size"), F.col("tree").alias("rank"), "digest"
    )
    top = build_tree(stored(subroots, "merkle-subroots"), "merkle-top")
    root = top.tops.first()
    if root is None:
        root_digest = F.lit(None).cast("string")
    else:
        root_digest = F.lit(root["digest"])
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = descend(top, top.tops.withColumn("path", nothing)).select("*", F.posexplode("children").alias("digit", "child"))
    rank = F.col("run") * FAN + F.col("digit")
    above = above.select(rank.alias("tree"), F.reverse(whole_path(F.col("digit"))).alias("path"), F.col("child").alias("digest"))
    starts = stored(above.join(groups.select("tree", "size"), "tree"), "merkle-paths")

    found = descend(trees, starts).join(starts.select("tree", F.col("digest").alias("subroot")), "tree")
    asked = leaves.select("tree", "rank", F.expr(f"rank div {FAN}").alias("run"), F.col("digest").alias("leaf"), "tampered", "row")
    proved = asked.join(found.hint("merge"), ["tree", "run"]).select(
        "row", "leaf", "tampered", "subroot", whole_path(F.col("rank")).alias("siblings")
    )
    proved = proved.select(
        "row", "leaf", "subroot", proof_digest(F.col("siblings")).alias("proof"),
        folded(F.coalesce("tampered", "leaf"), F.col("siblings")).alias("folded"),
    )
    return with_columns(proved, columns, {
        "leaf": F.col("leaf"), "subroot": F.col("subroot"), "root": root_digest, "proof_sha256": F.col("proof"),
        "folded_root": F.col("folded"), "verified": F.col("folded") == root_digest,
    })
