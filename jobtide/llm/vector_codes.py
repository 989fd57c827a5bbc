"""Short codes for vectors: integer codebooks per part, fitted over Hilbert-sorted blocks with boxes and sums."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import packed, with_columns
from jobtide.plans.store import stored

#: Components are held to this size, so that every distance and sum is exact in 64 bits.
LARGEST = 1 << 26
#: Most points of a block, and bits of a Hilbert key.
BLOCK, KEY_BITS = 256, 62


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of *cells* (n x axes, values below 2**bits) on the Hilbert curve through that grid."""
    x = cells.astype(np.int64).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations of the sub-cubes, from the largest
        for axis in range(len(x)):
            inside = (x[axis] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[axis]) & (bit - 1))
            x[0] ^= np.where(inside, bit - 1, swap)
            x[axis] ^= swap
        bit >>= 1
    for axis in range(1, len(x)):  # Gray code over the axes
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for place in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> place & 1
    return key


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows; products of doubles where every intermediate value is below 2**53."""
    reach = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if points.shape[1] * 4 * reach * reach < 1 << 53:
        p, c = points.astype(np.float64), entries.astype(np.float64)
        found = (p * p).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (p @ c.T)
        return found.astype(np.int64)
    return np.stack([((points - entry) ** 2).sum(1) for entry in entries], 1)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box (rows of *low* and *high*) the entries that may be nearest to a point inside it.

    An entry whose least distance to the box is above another's greatest distance cannot be nearest, nor tie.
    """
    below, above = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
    farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
    return nearest <= farthest.min(1)[:, None]


def _blocks(batches: Iterable[pa.RecordBatch], width: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Cut sorted rows (part, rid, point) into blocks of one part with the box and the sum of their points."""
    for batch in batches:
        part, rid = batch.column("part").to_numpy(), batch.column("rid").to_numpy()
        raw = batch.column("point").to_pylist()
        rows = []
        for k in np.unique(part):
            of = np.flatnonzero(part == k)
            for at in np.array_split(of, -(-len(of) // BLOCK)):
                points = np.frombuffer(b"".join(raw[i] for i in at), np.int32).reshape(len(at), width[k])
                box = points.min(0), points.max(0), points.sum(0, dtype=np.int64)
                rows.append((int(k), len(at), rid[at].tobytes(), points.tobytes(), *[side.astype(np.int64).tobytes() for side in box]))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "rows", "rids", "points", "low", "high", "total"]
        )


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], sums_only: bool) -> Iterator[tuple]:
    """(part, rids, points, entries, distances) of each block; with *sums_only*, a block with a shortlist of one entry
    comes as (part, count, sum, entry) from what it stores, without a look at its points."""
    parts, sizes = batch.column("part").to_numpy(), batch.column("rows").to_numpy()
    low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
    for k in np.unique(parts):
        of, entries = np.flatnonzero(parts == k), books[k]
        for chunk in np.array_split(of, -(-len(of) // 32)):
            boxes = [np.frombuffer(b"".join(side[i] for i in chunk), np.int64).reshape(len(chunk), -1) for side in (low, high)]
            for at, listed in zip(chunk, shortlists(*boxes, entries)):
                short = np.flatnonzero(listed)
                if sums_only and len(short) == 1:
                    yield int(k), int(sizes[at]), np.frombuffer(batch.column("total")[at].as_py(), np.int64), int(short[0])
                    continue
                points = np.frombuffer(batch.column("points")[at].as_py(), np.int32).astype(np.int64).reshape(sizes[at], -1)
                found = distances(points, entries[short])
                best = found.argmin(1)  # the first of equal ones, so the lowest index
                rids = None if sums_only else np.frombuffer(batch.column("rids")[at].as_py(), np.int64)
                yield int(k), rids, points, short[best], found[np.arange(len(best)), best]


def _moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: componentwise floors of the means of what is assigned to each entry."""
    widths = [book.shape[1] for book in books]

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            for found in _assigned(batch, books, True):
                if len(found) == 4:
                    k, count, total, entry = found
                    counts[k][entry] += count
                    sums[k][entry] += total
                else:
                    k, _, points, entry, _ = found
                    counts[k] += np.bincount(entry, minlength=len(counts[k]))
                    np.add.at(sums[k], entry, points)
        rows = [(k, e, int(counts[k][e]), sums[k][e].tolist()) for k in range(len(books)) for e in np.flatnonzero(counts[k]).tolist()]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())])],
            ["part", "entry", "count", "total"],
        )

    partial = blocks.drop("rids").mapInArrow(totals, "part int, entry int, count long, total array<long>")
    summed = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(max(widths))]
    moved = [book.copy() for book in books]
    for row in partial.groupBy("part", "entry").agg(F.sum("count").alias("count"), *summed).collect():  # a row per entry
        total = np.array(row[3 : 3 + widths[row["part"]]], np.int64)
        moved[row["part"]][row["entry"]] = total // row["count"]
    return moved


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4,
    entries: int = 256, rounds: int = 4, scale: int = 1024, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Code every vector by the nearest entries of one codebook per part, after *rounds* of exact integer k-means.

    A component x becomes floor(scale * x). Vectors are cut into *parts* equal consecutive parts. A codebook starts with
    that part of the vectors with the smallest ids; a round assigns every part to the nearest entry (ties: the lower index)
    and replaces every used entry by the componentwise floor of the mean.

    The points of a part are sorted along a Hilbert curve and cut into blocks that store their box and their sum. In each
    round the distances between a box and the entries leave a shortlist per block; a shortlist of one needs only the
    block's sum, the others are evaluated exactly for the shortlist. The curve only orders the points; results do not
    depend on it. Equal points are dealt to as many blocks as they need. A task sums per entry, so that a round sends
    one row per task and entry, and one row per entry to the driver.

    Returns, for the rows kept, the columns *carry* (default: all), ``code`` (an index after the other, two hex digits
    each), ``error`` (squared distances summed over the parts), ``label_error`` (the errors of all rows of that label,
    NULL labels together; NULL beyond a long) and ``codebooks_sha256``; input columns of these names are replaced. Dropped
    are rows whose vector is NULL, empty, holds NULL or a non-finite component, or has another length than that of the
    kept row with the smallest id. A length that *parts* does not divide is cut at the floors of its multiples. Scaled
    components are held to +-2**26. Ids may repeat; NULL ids come last among the starting vectors, equal ids in the order
    of their vectors. An empty table gives an empty result.
    """
    columns = list(vectors.columns if carry is None else carry)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    rows = stored(
        vectors.where(F.coalesce(finite & (F.size(vector) > 0), F.lit(False))).select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), packed(vectors, columns).alias("row"),
            whole.alias("v"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "codes-rows",
    )
    order = [F.asc_nulls_last("id"), "v"]
    first = rows.orderBy(*order).select(F.size("v")).first()
    dim = first[0] if first else parts
    rows = rows.where(F.size("v") == dim)
    seeds = np.array([r.v for r in rows.orderBy(*order).select("v").limit(entries).collect()], np.int64).reshape(-1, dim)
    cuts = [dim * k // parts for k in range(parts + 1)]
    books = [seeds[:, a:b] for a, b in zip(cuts, cuts[1:])]
    widths = [b - a for a, b in zip(cuts, cuts[1:])]

    spread = rows.select(F.posexplode("v")).groupBy("pos").agg(F.avg("col").alias("mean"), F.stddev_pop("col").alias("deviation"))
    mean, deviation = np.zeros(dim), np.ones(dim)
    for r in spread.collect():  # a row per component
        mean[r.pos], deviation[r.pos] = r["mean"], max(r.deviation, 1.0)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, dim)
            for k, width in enumerate(widths):
                points = np.ascontiguousarray(values[:, cuts[k] : cuts[k + 1]], np.int32)
                axes = min(width, KEY_BITS)
                bits = max(1, min(KEY_BITS // max(axes, 1), 8))
                at = slice(cuts[k], cuts[k] + axes)
                # Two deviations to each side cover the grid.
                cells = np.clip((points[:, :axes] - mean[at]) / deviation[at] / 4 + 0.5, 0, 1 - 1e-9) * (1 << bits)
                key = hilbert_keys(cells.astype(np.int64), bits) if axes else np.zeros(len(points), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(points), k, np.int32)), pa.array(key), batch.column("rid"),
                     pa.array([p.tobytes() for p in points], pa.binary())],
                    ["part", "key", "rid", "point"],
                )

    points = stored(rows.select("rid", "v").mapInArrow(keyed, "part int, key long, rid long, point binary"), "codes-points")
    curve = points.repartitionByRange("part", "key", "rid").sortWithinPartitions("part", "key", "rid")
    blocks = stored(
        curve.select("part", "rid", "point").mapInArrow(
            lambda batches: _blocks(batches, widths), "part int, rows int, rids binary, points binary, low binary, high binary, total binary"
        ),
        "codes-blocks",
    )
    for _ in range(rounds if len(seeds) else 0):
        books = _moved(blocks, books)
    digest = sha256(",".join(str(x) for book in books for entry in book.tolist() for x in entry).encode()).hexdigest()

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, rids, _, entry, distance in _assigned(batch, books, False):
                code = entry.astype(np.int64) << (8 * (parts - 1 - k))
                yield pa.RecordBatch.from_arrays([pa.array(rids), pa.array(code), pa.array(distance)], ["rid", "code", "error"])

    found = blocks.select("part", "rows", "rids", "points", "low", "high").mapInArrow(coded, "rid long, code long, error long")
    codes = found.groupBy("rid").agg(F.sum("code").alias("code"), F.sum("error").alias("error"))
    out = stored(rows.select("rid", "label", "row").join(codes, "rid"), "codes-found")
    errors = stored(out.groupBy("label").agg(F.try_sum("error").alias("label_error")), "codes-labels")
    errors = errors.withColumnRenamed("label", "of")
    out = out.join(errors, F.col("label").eqNullSafe(F.col("of")))
    return with_columns(out, columns, {
        "code": F.lower(F.lpad(F.hex("code"), 2 * parts, "0")), "error": F.col("error"), "label_error": F.col("label_error"),
        "codebooks_sha256": F.lit(digest),
    })
