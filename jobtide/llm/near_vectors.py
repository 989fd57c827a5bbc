"""Near-duplicate vectors by collision-counting projections."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.components import connected_components
from jobtide.llm.frames import packed, with_columns
from jobtide.plans.store import stored

#: Half-width of a window over the spread of a projected link at the threshold, and rows of a block of vectors.
WIDTH, BLOCK = 1.75, 512


def calibrated(threshold: float, projections: int, recall: float) -> tuple[float, int]:
    """The window's half-width and the smallest count of collisions for which a link at the threshold is found with *recall*.

    The difference of two unit vectors at that cosine, projected on a Gaussian direction, is normal with the vectors'
    distance as deviation. It stays inside the window with one probability in each projection, so counts are binomial.
    """
    distance = sqrt(max(2 - 2 * threshold, 1e-12))
    inside = erf(WIDTH / sqrt(2))
    missed, count = 0.0, 0
    while count < projections:
        missed += comb(projections, count) * inside**count * (1 - inside) ** (projections - count)
        if missed > 1 - recall:
            break
        count += 1
    return WIDTH * distance, count


@lru_cache(maxsize=8)
def directions(dim: int, projections: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).normal(size=(dim, projections))


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """How many projections of each pair collide: sort each projection of *b*; a window around each of *a* gives the pairs."""
    counts = np.zeros((len(a), len(b) + 1), np.int16)
    rows = np.arange(len(a))
    total = np.zeros((len(a), len(b)), np.int16)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        values = b[order, j]
        # A window is a run in the sorted order: +1 at its begin, -1 behind its end, summed up along the order.
        counts[:] = 0
        np.add.at(counts, (rows, np.searchsorted(values, a[:, j] - width, "left")), 1)
        np.add.at(counts, (rows, np.searchsorted(values, a[:, j] + width, "right")), -1)
        total[:, order] += np.cumsum(counts[:, :-1], axis=1, dtype=np.int16)
    return total


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.98, projections: int = 24, levels: int = 2, recall: float = 0.995, seed: int = 1,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Link vectors of one label whose cosine, in double precision, is at least *threshold*, and group what is linked.

    Every vector is projected on *projections* random directions. The first *levels* projections cut the value range into
    cells; a vector meets the vectors of its own and the adjacent cells, in blocks of bounded size, each pair of blocks in a
    task of its own. There, windows around the vector in every sorted projection give the collisions of each pair; pairs
    with the calibrated count of collisions are verified by their cosine. So no pair below the threshold is linked, and a
    pair at the threshold is found with about *recall*, one above it more often; cells cost less than 0.2 % per level.
    Equal vectors are collapsed to one first and counted. Pairs are counted and joined to groups inside the task.

    Returns the columns *carry* (default: all), ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    of the group) and ``kept`` (id = component_id). Input columns of these names are replaced. A row whose label or
    vector is NULL, whose vector is empty, zero, or holds NULL or a non-finite value links with nothing; its component_id
    is its own id. Only vectors of equal length are compared. Repeated rows are different vectors with one id. NULL ids
    count as larger than all. An empty table gives an empty result.
    """
    columns = list(vectors.columns if carry is None else carry)
    width, least = calibrated(threshold, projections, recall)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col(f"`{label_col}`").isNotNull() & finite & F.exists(vector, lambda x: x != 0.0), F.lit(False)
    )
    rows = stored(
        vectors.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), packed(vectors, columns).alias("row"),
            F.when(usable, vector).alias("vector"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "near-rows",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id")).alias("first")
    groups = stored(
        rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(first, F.min("rid").alias("v"), F.count("*").alias("copies")),
        "near-vectors",
    )

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, cells = [], []
            for values in batch.column("vector").to_pylist():
                x = np.array(values, np.float64)
                x /= np.abs(x).max()
                x /= np.sqrt(x @ x)
                raw.append(x.tobytes())
                # A cell is as wide as a window in which a link at the threshold stays but for 0.1 %.
                cells.append(np.floor(x @ directions(len(x), projections, seed)[:, :levels] / (3.3 * width / WIDTH)).astype(int).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), batch.column("label"), batch.column("copies"), pa.array(raw, pa.binary()), pa.array(cells, pa.list_(pa.int32()))],
                ["v", "label", "copies", "x", "cell"],
            )

    projected = stored(
        groups.select("v", "label", "copies", "vector").mapInArrow(
            project, "v long, label string, copies long, x binary, cell array<int>"
        ).withColumn("dim", F.octet_length("x")),
        "near-projected",
    )
    place = ["label", "dim", "cell"]
    sizes = projected.groupBy(*place).agg(F.count("*").alias("size"))
    blocks = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    # A block of a cell is dealt by the hash of the vector's number.
    homes = projected.join(blocks, place).withColumn("block", F.pmod(F.xxhash64("v"), "blocks"))
    homes = stored(homes.select("v", "copies", "x", *place, "block"), "near-blocks")

    offsets = F.array(F.array().cast("array<int>"))
    for _ in range(levels):
        offsets = F.flatten(F.transform(offsets, lambda o: F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.concat(o, F.array(d)))))
    one = blocks.select(*place, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    towards = one.select("label", "dim", F.col("cell").alias("home"), F.col("block").alias("home_block"), F.explode(offsets).alias("o"))
    towards = towards.withColumn("cell", F.zip_with("home", "o", lambda c, d: c + d)).drop("o").where("cell >= home")
    tiles = towards.join(one, place).where("cell > home OR block >= home_block")
    tiles = stored(tiles.withColumn("tile", F.monotonically_increasing_id()), "near-tiles")
    left = tiles.select("label", "dim", F.col("home").alias("cell"), F.col("home_block").alias("block"), "tile", F.lit(0).alias("side"))
    right = tiles.where("cell <> home OR block <> home_block").select(*place, "block", "tile", F.lit(1).alias("side"))
    members = left.unionByName(right).join(homes, [*place, "block"]).select("tile", "side", "v", "copies", "x")

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        order = np.lexsort((table.column("v").to_numpy(), side))
        side = side[order]
        v, copies = table.column("v").to_numpy()[order], table.column("copies").to_numpy()[order]
        raw = table.column("x").to_pylist()
        x = np.frombuffer(b"".join(raw[at] for at in order), np.float64).reshape(len(order), -1)
        inner = not side.any()
        a = np.flatnonzero(side == 0)
        b = a if inner else np.flatnonzero(side == 1)
        p = x @ directions(x.shape[1], projections, seed)
        linked = collisions(p[a], p[b], width) >= least
        if inner:
            linked = np.triu(linked, 1)
        some_a, some_b = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
        near = linked[np.ix_(some_a, some_b)]
        near &= x[a[some_a]] @ x[b[some_b]].T >= threshold
        links, root = np.zeros(len(v), np.int64), np.arange(len(v))
        np.add.at(links, a[some_a], near @ copies[b[some_b]])
        np.add.at(links, b[some_b], near.T @ copies[a[some_a]])
        while near.any():
            ra, rb = root[a[some_a]], root[b[some_b]]
            low_a = np.minimum(ra, np.where(near, rb[None, :], len(v)).min(1))
            np.minimum.at(root, a[some_a], low_a)
            low_b = np.minimum(root[b[some_b]], np.where(near, root[a[some_a]][:, None], len(v)).min(0))
            np.minimum.at(root, b[some_b], low_b)
            if (root[a[some_a]] == ra).all() and (root[b[some_b]] == rb).all():
                break
        found = links > 0
        return pa.table({"v": v[found], "links": links[found], "root": v[root[found]]})

    found = stored(members.groupBy("tile").applyInArrow(compare, "v long, links long, root long"), "near-found")
    links = found.groupBy("v").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("v").alias("a"), F.col("root").alias("b")))
    grouped = groups.select("v", "first", "copies").join(roots.withColumnRenamed("node", "v"), "v", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "v")).join(links, "v", "left")
    firsts = grouped.groupBy("root").agg(F.min("first").alias("least"))
    classes = groups.select("label", "vector", "v").join(
        grouped.join(firsts, "root").select("v", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "v"
    )
    joined = rows.where("vector IS NOT NULL").join(stored(classes, "near-classes"), ["label", "vector"])
    same = F.col("id").eqNullSafe(F.col("least.id"))
    out = with_columns(joined, columns, {"n_links": F.col("links"), "component_id": F.col("least.id"), "kept": same})
    alone = with_columns(rows.where("vector IS NULL"), columns, {
        "n_links": F.lit(0).cast("long"), "component_id": F.col("id"), "kept": F.lit(True),
    })
    return out.unionByName(alone)
