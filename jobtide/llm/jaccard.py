"""N-gram Jaccard join by vertical partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.components import connected_components
from jobtide.llm.frames import Workspace, packed, slices, with_columns
from jobtide.llm.subwords import mixed, words_of
from jobtide.plans.store import stored

#: Fragments of the global order, and rounds in which sets are only compared with one set of each posting list.
FRAGMENTS, HUB_ROUNDS = 8, 2


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and how many each has.

    A text with fewer than *size* words has its whole sequence as one shingle; one without words has none.
    """
    import xxhash

    words, index, counts = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    hashed = np.fromiter((xxhash.xxh64_intdigest(word.encode()) for word in words), np.uint64, len(words))[index]
    ends = np.cumsum(counts)
    grams, owners = [], []
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(hashed), np.uint64)
        for at in range(size):
            ahead = np.zeros(len(hashed), np.uint64)
            ahead[: max(0, len(hashed) - at)] = hashed[at:]
            rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + ahead + np.uint64(1))
            if at + 1 < size:
                short = np.flatnonzero(counts == at + 1)
                grams.append(rolled[ends[short] - counts[short]])
                owners.append(short)
    full = np.repeat(ends, counts) - np.arange(len(hashed)) >= size
    grams = np.concatenate([*grams, rolled[full]])
    owner = np.concatenate([*owners, np.repeat(np.arange(len(counts)), counts)[full]])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new].view(np.int64), np.bincount(owner[new], minlength=len(counts))


def _heads(values: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> pa.ListArray:
    """The first *wanted* values of each run, as a list column."""
    wanted = np.minimum(wanted, counts)
    ends = np.cumsum(wanted)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(np.cumsum(counts) - counts - (ends - wanted), wanted)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[at]))


def _lacking(n, percent: int):
    """How many shingles of a set of *n* a set that it links with may lack (numbers, arrays or columns)."""
    return n * (100 - percent) // 100 if not isinstance(n, Column) else F.floor(n * (100 - percent) / 100)


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: partial overlaps are counted per fragment and summed per pair."""
    left = segments.select(F.col("s").alias("a"), "fragment", F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = segments.select(F.col("s").alias("b"), "fragment", F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    counted = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"])
    partial = counted.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"))
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return summed.where((100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether two sets can link, if the shingle at hand is the first that they share in the global order.

    ``left`` is how many shingles a set has from this one on. A pair that links passes at its first shared shingle.
    """
    most = F.least(F.col(f"{x}.left"), F.col(f"{y}.left"))
    return (100 + percent) * most >= percent * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _links(full: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Links ``(a, b)`` between sets that leave no two linked sets in different components.

    *full*: ``(s, n, tokens)``. Shingles of one set only are left out but counted; the others have a global order, rare
    ones first. A set's prefix in this order, as long as the shingles it may lack plus one, meets the prefix of every
    set it links with. Prefixes make posting lists. First every set of a list is compared with one set of it, the one with
    the smallest share of own shingles (near copies mostly link through it); then all sets of a list that are still in
    different components are compared with each other.
    """
    tokens = work.stored(full.select("s", "n", F.explode("tokens").alias("h")), "jaccard-tokens")
    frequency = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    key = F.col("df") + F.col("h") / F.lit(2.0**64) + F.lit(0.5)
    ranked = work.stored(tokens.join(frequency, "h").select("s", "n", "h", "df", key.alias("key")), "jaccard-ranked")
    shared = ranked.groupBy("s").agg(F.first("n").alias("n"), F.count("*").alias("shared"))
    lacking = _lacking(F.col("n"), percent)
    shared = work.stored(shared.where(F.col("n") - F.col("shared") <= lacking), "jaccard-shared")

    steps = [at / FRAGMENTS for at in range(1, FRAGMENTS)]
    pivots = ranked.agg(F.percentile_approx("key", F.lit(steps), 10_000).alias("p")).first()["p"] or []
    fragment = sum((F.when(F.col("key") >= pivot, 1).otherwise(0) for pivot in sorted(set(pivots))), F.lit(0))
    alive = ranked.join(shared.select("s", "shared"), "s")
    segments = work.stored(
        alive.groupBy("s", "n", fragment.alias("fragment")).agg(F.collect_list("h").alias("tokens")), "jaccard-segments"
    )
    own = F.col("n") - F.col("shared")
    first = F.slice(F.sort_array("all"), F.lit(1), (lacking + 1 - own).cast("int"))
    postings = work.stored(
        alive.groupBy("s", "n", "shared").agg(F.collect_list(F.struct("key", "h")).alias("all"))
        .select("s", "n", "shared", F.posexplode(first).alias("at", "x"))
        .select("s", "n", (own * 1000 / F.col("n")).cast("int").alias("own"), (F.col("shared") - F.col("at")).alias("left"), "x.h"),
        "jaccard-postings",
    )
    components = shared.select("s", F.col("s").alias("c"))
    found = None
    for turn in range(HUB_ROUNDS + 1):
        lists = postings.join(components, "s")
        hubs = lists.groupBy("h").agg(
            F.min(F.struct("own", F.xxhash64(F.lit(turn), "s").alias("hash"), "s", "n", "left", "c")).alias("y"),
            F.min("c").alias("low"), F.max("c").alias("high"),
        ).where("low <> high")
        x = F.struct("s", "n", "left", "c").alias("x")
        if turn < HUB_ROUNDS:
            met = lists.select("h", x).join(hubs.select("h", "y"), "h")
            met = met.where("x.c <> y.c")
        else:
            open_lists = work.stored(lists.join(hubs.select("h"), "h", "left_semi").select("h", x), "jaccard-open")
            met = open_lists.join(open_lists.withColumnRenamed("x", "y"), "h").where("x.c <> y.c AND x.s < y.s")
        pairs = met.where(_possible("x", "y", percent)).select(
            F.least("x.s", "y.s").alias("a"), F.greatest("x.s", "y.s").alias("b")
        ).distinct()
        links = work.stored(_verified(pairs, segments, percent), "jaccard-links")
        found = links if found is None else found.unionAll(links)
        if turn < HUB_ROUNDS:
            roots = connected_components(found)
            components = work.stored(
                shared.join(roots.withColumnRenamed("node", "s"), "s", "left").select("s", F.coalesce("root", "s").alias("c")),
                "jaccard-components",
            )
    return found


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Groups of documents joined by links of Jaccard similarity of *percent* / 100 or more on sets of *size*-word shingles.

    Words are what stands between ASCII white space, A-Z in lower case. Documents with equal sets form a class; classes
    are joined exactly:

    1. Two sets that link share, among the smallest shingles of each in the order of their hashes, a known number. A
       set of which too few of these occur in any other set is out.
    2. The rest is joined by vertical partitioning (see ``_links``) and links become components.

    Returns the columns *carry* (default: all), ``n_shingles`` (size of the set), ``component_id`` (smallest id of the
    group) and ``kept`` (one row per group: the one with the smallest id, NULL ids last). Input columns of these names are
    replaced. NULL, empty and blank texts have no shingles and link with nothing, not even each other; their
    component_id is their own id. A text of fewer than *size* words is one shingle. Repeated rows are linked, one of
    them is kept. An empty table gives an empty result. Whole texts of any length are used.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent is above 50 and at most 100")
    columns = list(docs.columns if carry is None else carry)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), packed(docs, columns).alias("row")
    )
    kind = rows.schema["id"]

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values, counts = shingle_sets(part.column("text"), size)
            lacking = _lacking(counts, percent)
            wanted = lacking + np.maximum(1, lacking)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("row"), pa.array(counts), _digests(values, counts), _heads(values, counts, wanted)],
                ["id", "row", "n", "digest", "prefix"],
            )

    schema = T.StructType([kind, rows.schema["row"]]).add("n", "long").add("digest", "binary").add("prefix", T.ArrayType(T.LongType()))
    light = stored(
        rows.mapInArrow(prefixes, schema).withColumn("rid", F.monotonically_increasing_id()), "jaccard-documents"
    )
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "rid"))
    work = Workspace(docs.sparkSession, "jaccard")
    sets = work.stored(
        light.where("n > 0").groupBy("digest", "n").agg(best.alias("first"), F.min(F.struct("rid", "prefix")).alias("p"))
        .select("digest", "n", "first", F.col("p.rid").alias("s"), F.col("p.prefix").alias("prefix")),
        "jaccard-sets",
    )
    # Step 1. A prefix is what a set may lack and `need` more, where need grows with the set. Of the prefixes of two sets
    # that link, the need of the smaller one agrees; it has at least percent/100 of the larger one's shingles.
    heads = sets.select("s", F.explode("prefix").alias("h"))
    met = heads.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h")
    hits = heads.join(met, "h", "left_semi").groupBy("s").agg(F.count("*").alias("hits"))
    smallest = F.ceil(F.col("n") * percent / 100)
    need = F.greatest(F.lit(1), _lacking(smallest, percent))
    survivors = work.stored(
        sets.join(hits, "s").where(F.col("hits") >= need).select("s", "n", "digest", F.col("first.id").alias("id")),
        "jaccard-survivors",
    )

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values, counts = shingle_sets(part.column("text"), size)
            yield pa.RecordBatch.from_arrays([_digests(values, counts), _heads(values, counts, counts)], ["digest", "tokens"])

    ids = survivors.select(F.col("id").alias("wanted")).distinct()
    again = rows.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets_again = again.mapInArrow(whole, T.StructType().add("digest", "binary").add("tokens", T.ArrayType(T.LongType())))
    full = sets_again.join(survivors, "digest").select("s", "n", "tokens").dropDuplicates(["s"])

    # Step 2.
    roots = connected_components(_links(full, percent, work)).withColumnRenamed("node", "s")
    grouped = sets.select("digest", "s", "first").join(roots, "s", "left").withColumn("root", F.coalesce("root", "s"))
    firsts = grouped.groupBy("root").agg(F.min("first").alias("least"))
    classes = stored(grouped.join(firsts, "root").select("digest", "least"), "jaccard-classes")
    work.clear()
    joined = light.where("n > 0").join(classes, "digest")
    out = with_columns(joined, columns, {
        "n_shingles": F.col("n"), "component_id": F.col("least.id"), "kept": F.col("rid") == F.col("least.rid"),
    })
    alone = with_columns(light.where("n = 0"), columns, {
        "n_shingles": F.col("n"), "component_id": F.col("id"), "kept": F.lit(True),
    })
    return out.unionByName(alone)


def _digests(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A digest of each set."""
    raw, ends = values.tobytes(), np.cumsum(counts) * 8
    return pa.array(
        [hashlib.blake2b(raw[end - count * 8 : end], digest_size=16).digest() for end, count in zip(ends, counts, strict=True)],
        pa.binary(),
    )
