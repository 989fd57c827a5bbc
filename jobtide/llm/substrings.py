"""Substring duplicates by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.frames import slices
from jobtide.plans.store import stored

#: Bytes that the rolling hash sees, bytes that a chunk has at least, and positions of which the least hash is a cut.
SEEN, SHORTEST, WINDOW = 16, 16, 96
#: Bytes beside a run that are compared; a repetition ends within SEEN + 2 * WINDOW bytes of its shared chunks.
BESIDE = 256
#: Contexts that are compared at a time.
PIECE = 10_000
GEAR = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def cuts(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of texts that follow each other in *data*, and how many chunks each has.

    The gear hash of the last 16 bytes, of one text, is built up by doubling. Of every 96 neighbouring positions the one
    with the least hash is a cut, the last of equal ones: cuts depend on near content only and are at most 96 bytes apart.
    Where one stretch repeats without end, as many of its repetitions as fit into 96 bytes make a chunk.
    """
    ends = np.cumsum(lengths)
    place = (np.arange(len(data)) - np.repeat(ends - lengths, lengths)).astype(np.int64)
    rolled, span = GEAR[data], 1
    while span < SEEN:
        earlier = np.zeros_like(rolled)
        earlier[span:] = rolled[:-span] << np.uint64(span)
        earlier[place < span] = 0
        rolled = rolled + earlier
        span *= 2
    # The hash is mixed, so that its high bits depend on all bytes seen, and joined with the position from the end.
    rolled = ((rolled & np.uint64(0xFFFF)) * np.uint64(0x9E3779B97F4A7C15) ^ (rolled * np.uint64(0xD6E8FEB86659FD93))) >> np.uint64(32)
    rolled[place < SEEN - 1] = 0xFFFFFFFF
    least, span = rolled << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(len(data), dtype=np.uint64)), 1
    while span * 2 <= WINDOW:
        least[span:] = np.minimum(least[span:], least[:-span].copy())
        span *= 2
    if (rest := WINDOW - span) and len(data) > rest:
        least[rest:] = np.minimum(least[rest:], least[:-rest].copy())
    found = np.unique((0xFFFFFFFF - (least[place >= WINDOW - 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)))
    if len(found) > 2:
        gap = np.diff(found, prepend=-1)
        again = np.zeros(len(found), bool)
        again[2:] = (gap[2:] == gap[1:-1]) & (rolled[found[2:]] == rolled[found[1:-1]])
        run = np.arange(len(found)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(found))))
        found = found[run % np.maximum(1, WINDOW // gap) == 0]
    found = np.union1d(found + 1, ends[lengths > 0])
    return found, np.diff(np.searchsorted(found, np.concatenate([[0], ends]), "right"))


CONTEXT = ["t", "left", "h1", "h2", "at", "beside"]
#: More than any agreement.
FAR = BESIDE + 2


def _grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How far each of the sorted contexts of a partition agrees with that of another text.

    Rows of the first and the last text of a partition may agree more with rows of its neighbours. They are returned with
    their contexts, what is known so far (``forward``, ``backward``) and what a value from before the partition, or from
    behind it, is limited to on its way to them (``from_first``, ``from_last``); all other rows with their gain.
    """
    parts = [batch.select([*CONTEXT, "part"]) for batch in batches if batch.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    text, agree = rows.column("t").to_numpy(), _agreements(rows)
    n = len(text)
    forward, backward = _passed_on(text, agree), _passed_on(text[::-1], agree[::-1])[::-1]
    first, last = text == text[0], text == text[-1]
    first[np.argmin(first) if not first.all() else n :] = False
    last[: n - np.argmin(last[::-1]) if not last.all() else 0] = False
    limits = np.concatenate([[FAR], agree])
    from_first = np.where(first, np.minimum.accumulate(limits), 0)
    limits = np.concatenate([agree, [FAR]])
    from_last = np.where(last, np.minimum.accumulate(limits[::-1])[::-1], 0)
    edge = first | last
    for begin in range(0, n, PIECE):
        piece = rows.slice(begin, PIECE).combine_chunks()
        at = slice(begin, begin + PIECE)
        gain, words = _gain(piece, np.maximum(forward[at], backward[at]))
        shown = pa.array(edge[at])
        beside = pc.if_else(shown, piece.column("beside").combine_chunks(), pa.scalar(None, pa.binary()))
        numbers = [pa.array(values[at].astype(np.int32)) for values in (forward, backward, from_first, from_last)]
        known = [pc.if_else(shown, pa.scalar(None, pa.int32()), pa.array(values)) for values in (gain, words)]
        place = pa.array(np.arange(begin, begin + piece.num_rows))
        columns = [piece.column(name).combine_chunks() for name in CONTEXT[:-1]]
        yield pa.RecordBatch.from_arrays(
            [*columns, beside, piece.column("part").combine_chunks(), place, *numbers, *known],
            [*CONTEXT, "part", "place", "forward", "backward", "from_first", "from_last", "gain", "words"],
        )


def _passed_on(text: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Agreement of each row with the rows of other texts before it: that of its neighbour, or what the rows of its own text
    in between let through."""
    found, known = [0] * len(text), 0
    for i, (other, a) in enumerate(zip((text[1:] != text[:-1]).tolist(), agree.tolist()), 1):
        known = a if other else min(known, a)
        found[i] = known
    return np.array(found, np.int64)


def _across(ends: list, backwards: bool) -> dict[int, int]:
    """What comes into each partition from those before it, or behind it: *ends* holds its first and its last row, in order."""
    near, far = ("forward", "from_first") if not backwards else ("backward", "from_last")
    known, out = None, {}
    for first, last in reversed(ends) if backwards else ends:
        inner, outer = (last, first) if backwards else (first, last)
        if known is not None:
            before, value = known
            pair = pa.Table.from_pylist([{name: row[name] for name in CONTEXT} for row in ((inner, before) if backwards else (before, inner))])
            agree = int(_agreements(pair)[0])
            out[inner["part"]] = agree if before["t"] != inner["t"] else min(value, agree)
        # The row at the other end passes on what it has, or what came in through rows of one text only.
        known = outer, max(outer[near], min(out.get(inner["part"], 0), outer[far]))
    return out


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    values = rows.column("beside").to_pylist()
    joined = b"".join(value.ljust(BESIDE + 2, b" ") for value in values)
    return np.frombuffer(joined, np.uint8).reshape(-1, BESIDE + 2), np.fromiter(map(len, values), np.int64, len(values))


def _agreements(rows: pa.Table) -> np.ndarray:
    """Bytes in which each of the sorted contexts agrees with the next one, if that is beside the same chunk."""
    agree = [np.zeros(0, np.int64)]
    for begin in range(0, rows.num_rows, PIECE):
        piece = rows.slice(begin, PIECE + 1)
        matrix, size = _matrix(piece)
        same = np.ones(len(size) - 1, bool)
        for name in ("left", "h1", "h2"):
            column = piece.column(name).to_numpy()
            same &= column[1:] == column[:-1]
        differ = matrix[1:] != matrix[:-1]
        common = np.where(differ.any(1), differ.argmax(1), BESIDE + 2)
        agree.append(np.where(same, np.minimum(common, np.minimum(size[1:], size[:-1])), 0))
    return np.concatenate(agree)


def _gain(rows: pa.Table, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points and words in agreements of *found* bytes; contexts begin with the byte of the chunk beside them."""
    matrix, size = _matrix(rows)
    found, wide = np.clip(found, 1, BESIDE + 1), BESIDE + 2
    # Back to a whole word: the context has a blank, or ends, behind the agreement.
    blank = BLANK[matrix]
    at = np.arange(wide)
    stop = blank | (at == np.minimum(size, wide - 1)[:, None])
    stop[:, 0], stop[:, 1] = False, True
    found = np.where(stop & (at <= found[:, None]), at, 0).max(1)
    taken = (at >= 1) & (at < found[:, None])
    gain = (taken & ((matrix & 0xC0) != 0x80)).sum(1).astype(np.int32)
    left = rows.column("left").to_numpy()
    # A word begins where a blank lies before it: the byte behind it in a context to the left, which is reversed.
    ahead, behind = np.ones_like(blank), np.ones_like(blank)
    ahead[:, :-1], behind[:, 1:] = blank[:, 1:] | (at[1:] >= found[:, None]), blank[:, :-1]
    words = (taken & ~blank & np.where(left[:, None], ahead, behind)).sum(1).astype(np.int32)
    return gain, words


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20
) -> DataFrame:
    """Passages of a text that occur in other rows too.

    Whole texts are cut into chunks where their content says so, and chunks with equal 128-bit digests are duplicates. A
    run of chunks that each occur in at least two rows is grown to both sides, by whole words, as far as any other text
    with its outermost chunk agrees; grown runs that overlap are one passage, if it has at least *min_words* words. A repetition of 223 bytes has
    a shared chunk wherever it stands, so all of about 50 words are found, and most shorter ones. In a stretch that repeats itself, which
    agrees with itself when shifted too, less than a chunk may be missing at an end.

    Returns a row per passage: the id column, ``start`` and ``end`` (code points, end exclusive), ``words``, ``n_rows``
    (rows that share its most shared chunk), ``first_id`` (smallest id with its first chunk; NULL ids last) and
    ``original`` (every chunk's first occurrence is in this row). NULL, empty and short texts have no passages. Repeated
    rows are rows of their own, so all of a repeated row is a passage. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("rid"),
    ).withColumn("t", F.xxhash64("text"))
    schema = T.StructType([rows.schema["id"]])
    for name in ("rid", "t", "h1", "h2"):
        schema = schema.add(name, "long")
    for name in ("start", "end", "before", "words"):
        schema = schema.add(name, "integer")

    def chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for part in slices(batches, "text"):
            raw = [(text or "").encode() for text in part.column("text").to_pylist()]
            joined = b"".join(raw)
            data, lengths = np.frombuffer(joined, np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
            ends, counts = cuts(data, lengths)
            row = np.repeat(np.arange(len(raw)), counts)
            text_begin = (np.cumsum(lengths) - lengths)[row]
            # A chunk goes back to the last cut that leaves it SHORTEST bytes, so neighbours may overlap.
            bounds = np.concatenate([[0], ends])
            begins = np.maximum(bounds[np.maximum(np.searchsorted(bounds, ends - SHORTEST, "right") - 1, 0)], text_begin)
            values = np.frombuffer(b"".join([digest(joined[b:e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]), "<i8")
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            space = (data == 32) | ((data >= 9) & (data <= 13))
            head = ~space
            head[1:] &= space[:-1]
            head[(np.cumsum(lengths) - lengths)[lengths > 0]] = ~space[(np.cumsum(lengths) - lengths)[lengths > 0]]
            words = np.concatenate([[0], np.cumsum(head)])
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(row)), part.column("rid").take(pa.array(row)), part.column("t").take(pa.array(row)),
                pa.array(values[0::2].astype(np.int64)), pa.array(values[1::2].astype(np.int64)),
                pa.array((points[begins] - points[text_begin]).astype(np.int32)),
                pa.array((points[ends] - points[text_begin]).astype(np.int32)),
                pa.array((words[begins] - words[text_begin]).astype(np.int32)), pa.array((words[ends] - words[text_begin]).astype(np.int32)),
            ], schema.names)

    chunks = stored(rows.mapInArrow(chunk, schema), "chunks")
    owner = F.struct(F.col("id").isNull().alias("unknown"), "id", "rid")
    shared = chunks.groupBy("h1", "h2").agg(
        F.min(owner).alias("first"), F.min("rid").alias("low"), F.max("rid").alias("high"), F.count("*").alias("n")
    ).where("low <> high").select("h1", "h2", "n", F.col("first.id").alias("first_id"), F.col("first.rid").alias("first_rid"))
    hits = stored(chunks.join(shared, ["h1", "h2"]).select(
        "id", "rid", "t", "h1", "h2", "start", "end", "before", "words", "n", "first_id", (F.col("first_rid") == F.col("rid")).alias("original")
    ), "hits")
    in_row = Window.partitionBy("rid").orderBy("end")
    begins = F.coalesce(F.lag("end").over(in_row) < F.col("start"), F.lit(True)).cast("int")
    runs = hits.withColumn("begins", begins).withColumn("run", F.sum("begins").over(in_row))
    digest = F.struct("h1", "h2")
    runs = stored(runs.groupBy("rid", "t", "run").agg(
        F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("before").alias("before"), F.max("words").alias("words"), F.max("n").alias("n_rows"),
        F.min_by("first_id", "end").alias("first_id"), F.bool_and("original").alias("original"),
        F.min_by(digest, "end").alias("head"), F.max_by(digest, "end").alias("tail"),
    ), "runs")
    gains = _gains(rows, hits, runs)
    side = lambda left, at: gains.where(F.col("left") == left).select(
        "t", F.col("at").alias(at), F.col("gain").alias(f"gain_{at}"), F.col("words").alias(f"words_{at}")
    )
    grown = runs.join(side(True, "start"), ["t", "start"], "left").join(side(False, "end"), ["t", "end"], "left")
    gained = lambda name: F.coalesce(name, F.lit(0))
    grown = grown.select(
        "rid", "id", (F.col("start") - gained("gain_start")).alias("start"), (F.col("end") + gained("gain_end")).alias("end"),
        (F.col("before") - gained("words_start")).alias("before"), (F.col("words") + gained("words_end")).alias("words"),
        "n_rows", "first_id", "original",
    )
    # Grown runs that overlap are one passage.
    earlier = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.max("end").over(earlier) <= F.col("start"), F.lit(True)).cast("int")
    joined = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passages = grown.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(joined)).groupBy("rid", "passage").agg(
        F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("words") - F.min("before")).cast("long").alias("words"), F.max("n_rows").alias("n_rows"),
        F.min_by("first_id", F.struct("start", "end")).alias("first_id"), F.bool_and("original").alias("original"),
    )
    return passages.where(F.col("words") >= min_words).select(
        F.col("id").alias(id_col), "start", "end", "words", "n_rows", "first_id", "original"
    )


def _gains(rows: DataFrame, hits: DataFrame, runs: DataFrame) -> DataFrame:
    """Code points and words by which runs grow: ``(t, left, at, gain, words)`` by text hash, side and place.

    The outermost chunks of runs are looked up in all texts that have them. Their contexts are sorted over all tasks, so
    that a chunk of very many rows is shared out; of each partition, its first and its last row go to the driver.
    """
    ends = runs.select(F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.col("head.h1").alias("h1"), F.col("head.h2").alias("h2")),
        F.struct(F.lit(False).alias("left"), F.col("tail.h1").alias("h1"), F.col("tail.h2").alias("h2")),
    )).alias("e")).select("e.*").distinct()
    wanted = hits.join(ends, ["h1", "h2"]).groupBy("t").agg(F.collect_set(F.struct(
        "left", "h1", "h2", F.when(F.col("left"), F.col("start")).otherwise(F.col("end")).alias("at")
    )).alias("wanted"))
    texts = rows.select("t", "text").dropDuplicates(["t"])
    schema = "t long, left boolean, h1 long, h2 long, at int, beside binary"

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = CONTEXT
        for part in slices(batches, "text"):
            out = [[] for _ in names]
            for t, text, wanted in zip(*(part.column(n).to_pylist() for n in ("t", "text", "wanted")), strict=True):
                for w in wanted:
                    at = w["at"]
                    if w["left"]:
                        beside = text[max(0, at - BESIDE) : at + 1].encode()[::-1]
                        lead = len(text[at].encode())
                    else:
                        beside = text[at - 1 : at + BESIDE].encode()
                        lead = len(text[at - 1].encode())
                    # One byte of the chunk, then at most BESIDE bytes beside it.
                    beside = beside[lead - 1 : lead + BESIDE]
                    for values, value in zip(out, (t, w["left"], w["h1"], w["h2"], at, beside), strict=True):
                        values.append(value)
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, types, strict=True)], names)

    order = ["left", "h1", "h2", "beside", "t", "at"]
    found = texts.join(wanted, "t").select("t", "text", "wanted").mapInArrow(contexts, schema)
    found = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kinds = "part int, place long, forward int, backward int, from_first int, from_last int, gain int, words int"
    grown = stored(found.mapInArrow(_grown, f"{schema}, {kinds}"), "grown")
    # Two rows of each partition: the agreements across partitions follow from them.
    edges = grown.where("beside IS NOT NULL")
    bounds = edges.groupBy("part").agg(F.min("place").alias("low"), F.max("place").alias("high")).withColumnRenamed("part", "of")
    outer = edges.join(bounds, (F.col("part") == F.col("of")) & ((F.col("place") == F.col("low")) | (F.col("place") == F.col("high"))))
    ends: dict[int, list] = {}
    for row in sorted(outer.drop("of", "low", "high").collect(), key=lambda r: (r["part"], r["place"])):
        ends.setdefault(row["part"], []).append(row)
    pairs = [(rows[0], rows[-1]) for _, rows in sorted(ends.items())]
    before, behind = _across(pairs, False), _across(pairs, True)

    def settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = {name: batch.column(name).to_numpy() for name in ("part", "forward", "backward", "from_first", "from_last")}
            far = [np.array([values.get(part, 0) for part in known["part"].tolist()], np.int64) for values in (before, behind)]
            best = np.maximum(
                np.maximum(known["forward"], np.minimum(far[0], known["from_first"])), np.maximum(known["backward"], np.minimum(far[1], known["from_last"]))
            )
            gain, words = _gain(pa.Table.from_batches([batch]), best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("t"), batch.column("left"), batch.column("at"), pa.array(gain), pa.array(words)], ["t", "left", "at", "gain", "words"]
            )

    gains = grown.where("beside IS NULL").select("t", "left", "at", "gain", "words").unionAll(
        edges.drop("gain", "words").mapInArrow(settled, "t long, left boolean, at int, gain int, words int")
    )
    return gains.groupBy("t", "left", "at").agg(F.max("gain").alias("gain"), F.max("words").alias("words"))
