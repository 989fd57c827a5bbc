"""Nearest neighbours by largest inner product: multiprobe p-stable hashing, candidates of several tables, exact scores."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5
from math import ceil, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.plans.store import stored

#: Width of a slot in deviations of a projection; the slots of a hash function, four bits of a bucket's code each.
WIDTH, SLOTS, MOST_HASHES = 1.5, 16, 15
#: Distinct vectors that a bucket shall hold on average, rows of a block, and queries of a set.
OCCUPANCY, BLOCK, QUERIES = 256, 2048, 4096
#: A task takes every fourth block of so many blocks.
DEALT, SLAB = 4, 4096
#: Nats that one hash function tells about a vector: the entropy of a normal value in steps of WIDTH.
NATS = 0.5 * log(2 * np.pi * np.e) - log(WIDTH)

#: The normal distribution at steps of 1/500, for estimates of success.
_GRID = np.linspace(-8, 8, 8001)
_PHI = np.array([0.5 * (1 + erf(z / sqrt(2))) for z in _GRID])


@dataclass(frozen=True)
class Index:
    """What all tasks need to hash and to probe: the largest norm of each band of norms, the number of hash functions and
    of probes per table, and the cosine that a neighbour is expected to have."""

    tops: dict[int, float]
    tables: int
    hashes: int
    probes: int
    cosine: float
    seed: int

    def lengths(self, bands: np.ndarray) -> np.ndarray:
        return np.array([self.tops[band] for band in bands.tolist()])

    def functions(self, table: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Directions (p-stable for p = 2) and offsets; the last component is that of the norm."""
        rng = np.random.default_rng([self.seed, table, dim])
        return rng.normal(size=(dim + 1, MOST_HASHES))[:, : self.hashes], rng.uniform(0, WIDTH, MOST_HASHES)[: self.hashes]

    def codes(self, table: int, vectors: np.ndarray, norms: np.ndarray, bands: np.ndarray) -> np.ndarray:
        """Bucket of each vector. A further component lifts all vectors of a band to one length, so that the nearest by
        distance are those of the largest inner product."""
        direction, offset = self.functions(table, vectors.shape[1])
        top = self.lengths(bands)
        share = norms / top
        lifted = np.hstack([vectors / top[:, None], np.sqrt(np.maximum(1 - share * share, 0))[:, None]])
        slots = np.clip(np.floor((lifted @ direction + offset) / WIDTH) + SLOTS // 2, 0, SLOTS - 1).astype(np.int64)
        code = np.zeros(len(vectors), np.int64)
        for k in range(self.hashes):
            code = code * SLOTS + slots[:, k]
        return code

    def sequence(self, table: int, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Codes (n x at most probes) of the buckets in the order of their estimated success.

        The projection of a neighbour of the expected cosine is normal around the query's own, shrunk by that cosine; the
        product over the hash functions of its share in each slot is the estimate. The best products of any number of
        functions begin with best products of the first ones, so extending the best by one function at a time is exact.
        Buckets of an estimate of zero end the list as -1.
        """
        direction, offset = self.functions(table, vectors.shape[1])
        centre = self.cosine * ((vectors / norms[:, None]) @ direction[:-1])
        spread = sqrt(max(1 - self.cosine**2, 1e-4))
        edges = (np.arange(1, SLOTS) - SLOTS // 2) * WIDTH
        below = np.interp((edges - offset[:, None] - centre[:, :, None]) / spread, _GRID, _PHI, left=0.0, right=1.0)
        share = np.diff(below, axis=2, prepend=0.0, append=1.0)
        with np.errstate(divide="ignore"):
            share = np.log(share)
        best, code = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), np.int64)
        for k in range(self.hashes):
            total = (best[:, :, None] + share[:, k, None, :]).reshape(len(vectors), -1)
            order = np.argsort(-total, axis=1, kind="stable")[:, : self.probes]
            best = np.take_along_axis(total, order, 1)
            code = np.take_along_axis(code, order // SLOTS, 1) * SLOTS + order % SLOTS
        return np.where(np.isfinite(best), code, -1)


def _matrix(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def top_scores(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(query, row, score) of the *n* largest inner products of each query, equal ones by id; none that is below the
    query's *floor*.

    The product of the matrices only selects; what may be among the best is computed again term by term, so that a pair
    has the same score wherever it is met.
    """
    rough = queries @ rows.T
    least = np.full(len(queries), -np.inf) if floor is None else floor
    if rough.shape[1] > n:
        least = np.maximum(least, np.partition(rough, rough.shape[1] - n, axis=1)[:, rough.shape[1] - n])
    size = np.abs(queries).max(1, initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
    q, r = np.nonzero(rough >= (least - 1e-12 * size)[:, None])
    score = np.concatenate([
        (queries[a] * rows[b]).sum(1) for a, b in zip(np.array_split(q, len(q) // 8192 + 1), np.array_split(r, len(q) // 8192 + 1))
    ])
    kept = _first(q, score, ids[r], n)
    return q[kept], r[kept], score[kept]


def _first(q: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the *n* largest scores of each query, equal ones by id."""
    order = np.lexsort((ids, -score, q))
    sorted_q = q[order]
    return order[np.arange(len(q)) - np.searchsorted(sorted_q, sorted_q) < n]


class Best:
    """The best rows so far of a set of queries that visit buckets; everything is bounded by the size of the set."""

    def __init__(self, v: np.ndarray, x: np.ndarray, probes: list, n: int) -> None:
        self.v, self.x, self.n = v, x, n
        self.every = np.array([at for at, codes in enumerate(probes) if codes is None], np.int64)
        codes = np.concatenate([np.asarray(c or [], np.int64) for c in probes])
        at = np.repeat(np.arange(len(probes)), [len(c or []) for c in probes])
        order = np.argsort(codes, kind="stable")
        self.codes, self.at = codes[order], at[order]
        self.floor = np.full(len(v), -np.inf)
        self.found, self.waiting = [np.zeros(0, kind) for kind in (np.int64, np.int64, np.float64, np.int64)], []

    def meet(self, code: int, x: np.ndarray, v: np.ndarray, least: np.ndarray) -> None:
        """Rows of one bucket."""
        asking = np.concatenate([self.every, self.at[np.searchsorted(self.codes, code, "left") : np.searchsorted(self.codes, code, "right")]])
        if len(asking):
            q, r, score = top_scores(self.x[asking], x, least, self.n, self.floor[asking])
            self.waiting.append((asking[q], v[r], score, least[r]))
            if sum(len(w[0]) for w in self.waiting) > 32 * len(self.v):
                self.settle()

    def settle(self) -> None:
        q, v, score, least = (np.concatenate(parts) for parts in zip(self.found, *self.waiting))
        kept = _first(q, score, least, self.n)
        self.found, self.waiting = [q[kept], v[kept], score[kept], least[kept]], []
        q, score = self.found[0], self.found[2]
        full = np.flatnonzero(np.bincount(q, minlength=len(self.v)) == self.n)
        self.floor[full] = score[np.searchsorted(q, full, "right") - 1]


def _band(norms: np.ndarray) -> np.ndarray:
    """Powers of two, cut between 1 and its neighbours, so that lengths of about 1 are one band."""
    share, power = np.frexp(norms)
    return (power - (share < 0.75)).astype(np.int32)


def _fitted(groups: DataFrame, sample: DataFrame, tables: int, n: int, probes: int, recall: float, seed: int) -> Index:
    """Hash functions by the number of vectors; probes by the neighbours of a bounded sample of queries.

    The sample's true neighbours come from a scan of all vectors that keeps the best per task. If *probes* probes per table
    do not reach the *recall* among them, there is one hash function less, down to none, which is one bucket.
    """
    queries = sample.select("x", "norm").collect()
    sizes = groups.groupBy("band").agg(F.max("norm").alias("top"), F.count("*").alias("rows")).collect()  # at most 2,099 bands
    tops, count = {r.band: r.top for r in sizes}, sum(r["rows"] for r in sizes)
    hashes = min(MOST_HASHES, max(0, ceil(log(max(count, 1) / OCCUPANCY) / NATS)))
    if not hashes or not queries:
        return Index(tops, tables, 0, 1, 0.0, seed)
    x, norms = np.frombuffer(b"".join(bytes(q.x) for q in queries), np.float64).reshape(len(queries), -1), np.array([q.norm for q in queries])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("x"))
            q, r, score = top_scores(x, rows, batch.column("v").to_numpy(), n + 1)
            taken = batch.take(pa.array(r))
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), pa.array(score), taken.column("x"), taken.column("norm"), taken.column("band"), taken.column("v")],
                ["q", "score", "x", "norm", "band", "v"],
            )

    found = groups.select("v", "x", "norm", "band").mapInArrow(scan, "q int, score double, x binary, norm double, band int, v long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "v"))
    near = found.withColumn("place", place).where(F.col("place") <= n + 1).collect()  # n + 1 for each query of the sample
    near = [r for r in near if bytes(r.x) != bytes(queries[r.q].x)]
    if not near:
        return Index(tops, tables, 0, 1, 0.0, seed)
    rows = np.frombuffer(b"".join(bytes(r.x) for r in near), np.float64).reshape(len(near), -1)
    norm, band, q = np.array([r.norm for r in near]), np.array([r.band for r in near]), np.array([r.q for r in near])
    cosines = np.array([r.score for r in near]) / (norms[q] * [tops[b] for b in band.tolist()])
    cosine = float(np.clip(np.quantile(cosines, 0.25), 0.0, 0.999))
    while hashes:
        index = Index(tops, tables, hashes, probes, cosine, seed)
        first = np.full(len(near), probes)
        for table in range(tables):
            at = index.sequence(table, x, norms)[q] == index.codes(table, rows, norm, band)[:, None]
            first = np.where(at.any(1), np.minimum(first, at.argmax(1)), first)
        needed = np.sort(first)[ceil(recall * len(near)) - 1] + 1
        if needed <= probes:
            return Index(tops, tables, hashes, int(needed), cosine, seed)
        hashes -= 1
    return Index(tops, tables, 0, 1, cosine, seed)


def nearest_neighbours(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_modulus: int = 20, n: int = 20,
    tables: int = 2, max_probes: int = 64, recall: float = 0.96, sample: int = 96, seed: int = 5,
) -> DataFrame:
    """The *n* rows of the largest inner product for every row whose id *query_modulus* divides.

    Every distinct vector is hashed into *tables* tables; a query visits the buckets of each in the order of their estimated
    success, as many as a sample of *sample* queries needed for *recall* of their true neighbours (at most *max_probes*; then there
    are fewer hash functions). What the tables' buckets hold is scored exactly and merged. Vectors are hashed by powers of
    two of their norm, each with buckets of its own, so long vectors do not blur the buckets of short ones.

    Buckets are sorted by code and cut into blocks of bounded size, a large one into many; queries are dealt to sets in the
    same way. A set meets the blocks that hold a bucket which one of its queries visits, streamed through tasks that keep
    the *n* + 1 best per query. Queries that found fewer than *n* rows meet all blocks of the first table. No bucket,
    candidate list or group of copies is cut: copies of a vector are hashed and scored once, and of each group as many of
    the smallest ids are kept as can be among the best.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (in double precision), nearest first, equal scores
    by the smaller id, NULL ids last. A row is never its own neighbour, other rows of its id and its vector are.
    With fewer than *n* other rows all are returned. Rows whose vector is NULL, empty, zero or holds NULL or non-finite
    components take no part, nor do rows of another length than the most frequent one (ties: the longer). An empty table
    gives an empty result. Products beyond the range of a double are not ranked.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(vector, lambda x: x != 0.0), F.lit(False))
    taking = vectors.where(usable).select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, norm = [], []
            for values in batch.column("vector"):
                x = np.asarray(values.values.to_numpy(), np.float64) + 0.0  # no negative zeros
                largest = np.abs(x).max()
                raw.append(x.tobytes())
                norm.append(float(largest * np.sqrt(((x / largest) ** 2).sum())))
            norm = np.minimum(norm, np.finfo(np.float64).max)
            digest = [md5(x).digest() for x in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(raw, pa.binary()), pa.array(digest, pa.binary()), pa.array(norm, pa.float64()), pa.array(_band(norm))],
                ["id", "x", "digest", "norm", "band"],
            )

    rows = stored(
        taking.mapInArrow(measured, "id long, x binary, digest binary, norm double, band int").withColumn("rid", F.monotonically_increasing_id()),
        "ann-rows",
    )
    lengths = rows.groupBy(F.octet_length("x").alias("bytes")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("bytes")).first()
    if lengths is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("norm").alias("score"))
    rows = rows.where(F.octet_length("x") == lengths["bytes"])
    asking = F.coalesce(F.col("id") % query_modulus == 0, F.lit(False))
    # Of equal vectors, only as many of the smallest ids can be among the best of a query, and the query itself.
    place = F.row_number().over(Window.partitionBy("digest").orderBy(F.asc_nulls_last("id"), "rid"))
    least = rows.select("digest", "x", "norm", "band", "id", "rid", place.alias("place")).where(F.col("place") <= n + 1)
    member = F.struct(F.col("id").isNull().alias("unknown"), "id", "rid")
    groups = stored(
        least.groupBy("digest").agg(
            F.any_value("x").alias("x"), F.any_value("norm").alias("norm"), F.any_value("band").alias("band"),
            F.array_sort(F.collect_list(member)).alias("members"),
        ).withColumn("v", F.monotonically_increasing_id()).withColumn("least", F.col("members")[0]),
        "ann-vectors",
    )
    asked = rows.where(asking).select("digest", "id", "rid")
    queries = stored(
        groups.join(asked.select("digest").distinct(), "digest", "left_semi").select("v", "x", "norm", "digest"), "ann-queries"
    )
    picked = queries.orderBy(F.xxhash64("digest"), "v").limit(sample)
    index = _fitted(groups, picked, tables, n, max_probes, recall, seed)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, norms, band = _matrix(batch.column("x")), batch.column("norm").to_numpy(), batch.column("band").to_numpy()
            for table in range(tables):
                code = index.codes(table, x, norms, band)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), table, np.int32)), batch.column("band"), pa.array(code), batch.column("v")], ["table", "band", "code", "v"]
                )

    # Blocks are cut by the order of codes; the vectors join them by number, so that the sort moves numbers only.
    placed = stored(groups.select("v", "x", "norm", "band").mapInArrow(hashed, "table int, band int, code long, v long"), "ann-codes")
    homes = stored(_numbered(placed, ["table", "band"], ["code", "v"], BLOCK, "ann-index"), "ann-homes")
    buckets = stored(homes.select("table", "band", "code", "block").distinct(), "ann-buckets")

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, norms = _matrix(batch.column("x")), batch.column("norm").to_numpy()
            code = index.codes(0, x, norms, _band(norms))
            yield pa.RecordBatch.from_arrays([pa.array(code), batch.column("v")], ["code", "v"])

    ordered = stored(queries.select("v", "x", "norm").mapInArrow(own, "code long, v long"), "ann-asked")
    dealt = _numbered(ordered.withColumn("one", F.lit(0)), ["one"], ["code", "v"], QUERIES, "ann-order").select(
        "v", F.col("block").alias("set")
    )
    queries = stored(queries.join(dealt, "v").select("v", "x", "norm", "set"), "ann-sets")

    def probed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                x, norms = _matrix(some.column("x")), some.column("norm").to_numpy()
                for table in range(tables):
                    probes = [codes[codes >= 0] for codes in index.sequence(table, x, norms)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(some.num_rows, table, np.int32)), some.column("set"), some.column("v"), some.column("x"),
                         pa.array(probes, pa.list_(pa.int64()))],
                        ["table", "set", "v", "x", "probes"],
                    )

    probing = stored(
        queries.select("x", "norm", "set", "v").mapInArrow(probed, "table int, set long, v long, x binary, probes array<long>"), "ann-probes"
    )
    wanted = probing.select("set", "table", F.explode("probes").alias("code")).distinct()
    tiles = wanted.join(buckets, ["table", "code"]).select("set", "table", "band", "block").distinct()
    found = _scored(tiles, probing, homes, groups, n)

    # Whoever found too few rows visits every bucket of one table: sets of queries by blocks of rows.
    best = stored(_best(found, groups, n), "ann-best")
    others = rows.count() - 1
    rich = best.where(F.size("near") > min(n, others)).select("v")
    poor = probing.where("table = 0").join(rich, "v", "left_anti").withColumn("probes", F.lit(None).cast("array<long>"))
    if not poor.isEmpty():
        blocks = buckets.where("table = 0").select("table", "band", "block").distinct()
        tiles = poor.select("set", "table").distinct().join(blocks, "table")
        again = _best(_scored(tiles, poor, homes, groups, n), groups, n)
        best = best.join(poor.select("v"), "v", "left_anti").unionByName(again)

    answers = asked.join(groups.select("digest", "v"), "digest").join(best, "v").select("id", "rid", F.col("near"))
    others = F.slice(F.filter("near", lambda r: r["rid"] != F.col("rid")), 1, n)
    ranked = answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "r"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("r.id").alias("vec_id"), (-F.col("r.minus")).alias("score"))


def _numbered(rows: DataFrame, within: Sequence[str], order: Sequence[str], size: int, name: str) -> DataFrame:
    """Deal rows, in order, to blocks of *size* rows that agree on *within*: adds ``block`` and ``at``, the place in it.

    The order is global, by range; the counts of the partitions give every row its number, so that blocks do not depend on
    the partitions.
    """
    keys = [*within, *order]
    spread = rows.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(spread.withColumn("n", F.monotonically_increasing_id()), name).withColumn("part", F.shiftright("n", 33))
    runs = stored(placed.groupBy("part", *within).agg(F.min("n").alias("start"), F.count("*").alias("rows")), f"{name}-runs")
    earlier = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shift = runs.select("part", *within, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("start")).alias("shift"))
    number = F.col("n") + F.col("shift")
    return placed.join(stored(shift, f"{name}-shifts"), ["part", *within]).select(
        *keys, F.floor(number / size).alias("block"), (number % size).cast("int").alias("at")
    )


def _scored(tiles: DataFrame, probing: DataFrame, homes: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """(q_v, v, score): the best of each query among the rows that it visits, per task.

    *tiles* are the blocks of rows (table, band, block) that a set of queries meets. Rows stream through a task behind the
    queries of their set, sorted by bucket; NULL probes visit all buckets.
    """
    keys = ["set", "table", "band", "slab", "deal"]
    slab = [F.floor(F.col("block") / SLAB).alias("slab"), F.pmod("block", F.lit(DEALT)).alias("deal")]
    tiles = stored(tiles.select("set", "table", "band", "block", *slab), "ann-tiles")
    none = F.lit(None).cast("long")
    asked = tiles.select(*keys).distinct().join(probing, ["set", "table"]).select(
        *keys, F.lit(0).alias("side"), "v", none.alias("code"), "x", none.alias("least"), "probes"
    )
    held = tiles.join(homes, ["table", "band", "block"]).select(*keys, "v", "code")
    rows = held.join(groups.select("v", "x", F.col("least.id").alias("least")), "v").select(
        *keys, F.lit(1).alias("side"), "v", "code", "x", F.coalesce("least", F.lit((1 << 63) - 1)).alias("least"),
        F.lit(None).cast("array<long>").alias("probes"),
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(best: Best | None) -> Iterator[pa.RecordBatch]:
            if best:
                best.settle()
                q, v, score, _ = best.found
                yield pa.RecordBatch.from_arrays([pa.array(best.v[q]), pa.array(v), pa.array(score)], ["q_v", "v", "score"])

        now, waiting, best = None, [], None
        for batch in batches:
            marks = np.array([batch.column(key).to_numpy() for key in [*keys, "side"]] + [batch.column("code").fill_null(0).to_numpy()])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                run = batch.slice(start, end - start)
                if tuple(marks[:5, start]) != now:
                    yield from finished(best)
                    now, waiting, best = tuple(marks[:5, start]), [], None
                v = run.column("v").to_numpy()
                if marks[5, start] == 0:
                    waiting.append((v, _matrix(run.column("x")), run.column("probes").to_pylist()))
                    continue
                if best is None:
                    best = Best(*[np.concatenate(part) for part in list(zip(*waiting))[:2]], [p for w in waiting for p in w[2]], n + 1)
                for at in range(0, len(v), 1024):
                    some = run.slice(at, 1024)
                    best.meet(marks[6, start], _matrix(some.column("x")), v[at : at + 1024], some.column("least").to_numpy())
        yield from finished(best)

    both = asked.unionByName(rows).repartition(*keys).sortWithinPartitions(*keys, "side", "code")
    return both.mapInArrow(compare, "q_v long, v long, score double")


def _best(found: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """(v, near): the best rows of each query vector over all tables, one more than wanted, each row once."""
    merged = found.groupBy("q_v", "v").agg(F.max("score").alias("score"))
    merged = merged.join(groups.select("v", F.col("least.id").alias("least")), "v")
    place = F.row_number().over(Window.partitionBy("q_v").orderBy(F.desc("score"), F.asc_nulls_last("least"), "v"))
    few = merged.select("q_v", "v", "score", place.alias("place")).where(F.col("place") <= n + 1)
    rows = few.join(groups.select("v", F.explode("members").alias("m")), "v")
    near = F.struct((-F.col("score")).alias("minus"), "m.unknown", "m.id", "m.rid")
    return rows.groupBy(F.col("q_v").alias("v")).agg(F.slice(F.array_sort(F.collect_list(near)), 1, n + 1).alias("near"))
