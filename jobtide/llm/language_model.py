"""Scores of texts under a byte model trained on the corpus: context-tree weighting, and a word model beside it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.context_tree import krichevsky_trofimov, levels, mixed_bits, weighted
from jobtide.llm.frames import packed, with_columns
from jobtide.llm.subwords import words_of
from jobtide.plans.store import stored

#: Bytes of context. Six bytes, the next one included, make a key.
DEPTH = 5
#: Bytes of text in a block and in a step of work on a block; bytes of input per part of the model.
BLOCK_BYTES, STEP_BYTES, PART_BYTES = 16 << 20, 1 << 20, 8 << 20
#: Keys that a block gathers before it merges them.
MERGE_KEYS = 1 << 18
#: Tables of a block: byte strings of the context tree, and words.
GRAMS, WORDS = 0, 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _pack(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


class Block:
    """Lower-cased texts in a row; each is preceded by DEPTH zero bytes and followed by an end mark that no text holds."""

    def __init__(self, raw: bytes, sizes: Sequence[int], trains: Sequence[bool]) -> None:
        self.raw, self.trains = raw, np.array(trains, bool)
        self.lengths = np.array(sizes, np.int64)
        self.sizes = self.lengths + DEPTH + 1
        self.ends = np.cumsum(self.sizes)
        self.bytes = np.zeros(int(self.ends[-1]) if len(self.ends) else 0, np.uint8)
        source, read = np.frombuffer(raw, np.uint8), 0
        for end, length in zip(self.ends.tolist(), self.lengths.tolist(), strict=True):
            self.bytes[end - 1 - length : end - 1] = source[read : read + length]
            self.bytes[end - 1] = 255
            read += length

    def keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Context and next byte of every place, some places at a time, and the text that each is in."""
        for begin in range(0, len(self.bytes), STEP_BYTES):
            end = min(begin + STEP_BYTES, len(self.bytes))
            first = np.searchsorted(self.ends, begin, "right")
            last = np.searchsorted(self.ends, end - 1, "right")
            cut = np.clip(self.ends[first : last + 1], begin, end)
            owner = np.repeat(np.arange(first, last + 1), np.diff(cut, prepend=begin))
            scored = np.arange(begin, end) - (self.ends - self.sizes)[owner] >= DEPTH
            # The first text has DEPTH zero bytes before it, so what is read before the block's begin is never scored.
            near = np.concatenate([np.zeros(max(0, DEPTH - begin), np.uint8), self.bytes[max(0, begin - DEPTH) : end]]).astype(np.uint64)
            key = near[DEPTH:].copy()
            for back in range(1, DEPTH + 1):
                key |= near[DEPTH - back : len(near) - back] << np.uint64(8 * (DEPTH + 1 - back))
            yield key[scored], owner[scored]

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hashes of distinct words, the word at every place, and the text that it is in, some texts at a time."""
        import xxhash

        ends, begin = np.cumsum(self.lengths), 0
        while begin < len(ends):
            first = ends[begin] - self.lengths[begin]
            end = max(begin + 1, int(np.searchsorted(ends, first + STEP_BYTES, "right")))
            offsets = np.concatenate([[0], ends[begin:end] - first])
            data = pa.py_buffer(self.raw).slice(int(first), int(ends[end - 1] - first))
            texts = pa.LargeStringArray.from_buffers(end - begin, pa.py_buffer(offsets.astype(np.int64)), data)
            found, index, counts = words_of(texts)
            hashed = np.fromiter((xxhash.xxh64_intdigest(word.encode()) for word in found), np.uint64, len(found))
            yield hashed, index, np.repeat(np.arange(begin, end), counts)
            begin = end

    def table(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys or word hashes of all texts, and their counts in the texts that train."""
        keys, counts, size = [np.zeros(0, np.uint64)], [np.zeros(0)], 0
        for *found, owner in self.keys() if kind == GRAMS else self.words():
            if kind == GRAMS:
                coded = pa.array(found[0]).dictionary_encode()
                found = [coded.dictionary.to_numpy(), coded.indices.to_numpy()]
            some, index = found
            keys.append(some)
            counts.append(np.bincount(index, self.trains[owner], len(some)))
            size += len(some)
            if size > 2 * len(keys[0]) + MERGE_KEYS:
                keys, counts = _merged(keys, counts)
                size = 0
        keys, counts = _merged(keys, counts)
        return keys[0], np.rint(counts[0]).astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct keys in order and their summed counts; by one sort, with as few copies as that needs."""
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    weight = np.concatenate(counts)[order]
    del order
    first = np.flatnonzero(np.concatenate([joined[:1] == joined[:1], joined[1:] != joined[:-1]]))
    return [joined[first]], [np.add.reduceat(weight, first) if len(first) else weight]


def parts(kind: int, keys: np.ndarray, count: int) -> np.ndarray:
    """The part of the model that a key belongs to: all keys with the same last two context bytes are in one."""
    if kind == GRAMS:
        keys = keys >> np.uint64(8 * (DEPTH - 1))
    mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(count)).astype(np.int64)


class Top:
    """The two shallowest depths of the tree, from the sums over each last byte: at most 256 times 255 nodes."""

    def __init__(self, rows: Iterable[tuple[int, int, int, int, float]]) -> None:
        self.zeros, self.ones, below = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64), np.zeros((256, 256))
        for byte, node, zeros, ones, log in rows:
            self.zeros[byte, node], self.ones[byte, node], below[byte, node] = zeros, ones, log
        own = krichevsky_trofimov(self.zeros, self.ones)
        log = np.logaddexp(own, below) - np.log(2)
        self.stay = np.exp(own - np.log(2) - log)
        self.root_zeros, self.root_ones = self.zeros.sum(0), self.ones.sum(0)
        own = krichevsky_trofimov(self.root_zeros, self.root_ones)
        self.root_stay = np.exp(own - np.log(2) - (np.logaddexp(own, log.sum(0)) - np.log(2)))

    def log10(self, last: np.ndarray, byte: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Log probability of each byte after each last byte, given the estimates per bit from longer contexts."""
        out = np.zeros(len(byte))
        for bit in range(8):
            node = ((1 << bit) | (byte.astype(np.int64) >> (8 - bit)))
            one = (byte >> np.uint64(7 - bit)) & np.uint64(1) == 1
            estimate = deeper[bit]
            for zeros, ones, stay in (
                (self.zeros[last, node], self.ones[last, node], self.stay[last, node]),
                (self.root_zeros[node], self.root_ones[node], self.root_stay[node]),
            ):
                own = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1.0)
                both = np.where(np.isnan(estimate), own, stay * own + (1 - stay) * estimate)
                estimate = np.where(zeros + ones > 0, both, np.nan)
            out += np.log10(np.where(np.isnan(estimate), 0.5, estimate))
        return out


def _gathered(table: pa.Table) -> tuple[int, list[np.ndarray], np.ndarray, np.ndarray]:
    """Kind, each block's keys, and all distinct keys of a part with their counts over all blocks."""
    own = [np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64) for raw in table.column("keys").to_pylist()]
    counts = [_unpack(raw, np.int64) for raw in table.column("counts").to_pylist()]
    (keys,), (total,) = _merged(own, counts)
    return table.column("kind")[0].as_py(), own, keys, np.rint(total).astype(np.int64)


def score_texts(
    docs: DataFrame, trains: Column, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """Score every whole text under models learned from the rows for which *trains* holds.

    A-Z are lower-cased. Byte model: for every context of up to DEPTH bytes and every beginning of the next byte's bits,
    zeros and ones are counted in all training texts, each with an end mark. KT estimates of all depths are mixed with the
    weights that context-tree weighting gives the training texts; contexts that no training text has leave the say to
    shorter ones. Word model: (count + 1) / (tokens + distinct + 1) per word between ASCII white space and per end.

    Texts are packed into blocks. A block contributes its distinct byte strings and words once, with counts; parts of the
    model, each a share of the contexts, add them up over all blocks, build their trees and send every block its own
    values, which then scores its texts. Only sums over the last byte reach the driver (at most 65,280 rows).

    Returns the columns *carry* (default: all), ``n_tokens``, ``n_known``, ``train_tokens`` (long), ``base_score``,
    ``score`` (log10 of the text's probability, end included) and ``bits_per_byte``. Input columns of these names are
    replaced. NULL counts as empty; an empty text is its end. Where *trains* is NULL the row does not train; without
    training rows all bits have probability 1/2. Repeated rows count each time. An empty table gives an empty result.
    Words are told apart by 64-bit hashes.
    """
    columns = list(docs.columns if carry is None else carry)
    rows = docs.select(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"),
        packed(docs, columns).alias("row"),
    )
    row_type = rows.schema["row"].dataType
    held = T.StructType().add("text", "binary").add("trains", T.ArrayType(T.BooleanType())).add("sizes", T.ArrayType(T.LongType()))
    held = held.add("rows", T.ArrayType(row_type, False))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy()
            start = 0
            for at, length in enumerate(lengths.tolist()):
                if size and size + length > BLOCK_BYTES:
                    pending.append(batch.slice(start, at - start))
                    yield _filled(pending)
                    pending, size, start = [], 0, at
                size += length + 1
            pending.append(batch.slice(start))
        if size:
            yield _filled(pending)

    def _filled(pending: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches([batch for batch in pending if batch.num_rows]).combine_chunks()
        texts = [text.encode().translate(_LOWER) for text in table.column("text").to_pylist()]
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        flags, kept = table.column("trains").chunk(0), table.column("row").chunk(0)
        return pa.RecordBatch.from_arrays(
            [pa.array([_pack(np.frombuffer(b"".join(texts), np.uint8))], pa.binary()), one(flags),
             one(pa.array([len(text) for text in texts], pa.int64())), one(kept)], ["text", "trains", "sizes", "rows"],
        )

    blocks = stored(rows.mapInArrow(fill, held).withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    made = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("bytes"), F.sum(
        F.size(F.filter("trains", lambda x: x))).alias("train")).first()
    count, train_texts = max(64, -(-(made["bytes"] or 0) // PART_BYTES)), made["train"] or 0

    def opened(raw: bytes, sizes: Sequence[int], flags: Sequence[bool]) -> Block:
        return Block(_unpack(raw, np.uint8).tobytes(), sizes, flags)

    def items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = opened(row["text"], row["sizes"], row["trains"])
                for kind in (GRAMS, WORDS):
                    keys, counts = block.table(kind)
                    part = parts(kind, keys, count)
                    order = np.argsort(part, kind="stable")
                    keys, counts = keys[order], counts[order]
                    bounds = np.searchsorted(part[order], np.arange(count + 1))
                    for at in np.flatnonzero(np.diff(bounds)).tolist():
                        some = slice(bounds[at], bounds[at + 1])
                        yield pa.RecordBatch.from_pylist([{
                            "block": row["block"], "kind": kind, "part": at, "keys": _pack(np.diff(keys[some], prepend=np.uint64(0))),
                            "counts": _pack(counts[some]),
                        }])

    table = stored(
        blocks.select("block", "text", "sizes", "trains").mapInArrow(items, "block long, kind long, part long, keys binary, counts binary"),
        "lm-items",
    )

    def sums(part: pa.Table) -> pa.Table:
        kind, _, keys, total = _gathered(part)
        if kind == WORDS:
            return pa.table({"byte": [-1], "node": [0], "zeros": [int((total > 0).sum())], "ones": [int(total.sum())], "log": [0.0]})
        tree = levels(keys, total, DEPTH, 2)
        logs = weighted(tree)
        out = []
        for bit in range(8):
            level = tree[0][bit]
            gram = np.empty(len(level.zeros), np.int64)
            gram[level.of] = np.arange(len(keys))
            last = (keys[gram] >> np.uint64(8 * DEPTH)).astype(np.int64)
            node = (1 << bit) | ((keys[gram] & np.uint64(255)).astype(np.int64) >> (8 - bit))
            place, inverse = np.unique(last * 256 + node, return_inverse=True)
            out.append(pa.table({
                "byte": place // 256, "node": place % 256, "zeros": np.bincount(inverse, level.zeros).astype(np.int64),
                "ones": np.bincount(inverse, level.ones).astype(np.int64), "log": np.bincount(inverse, logs[0][bit]),
            }))
        return pa.concat_tables(out)

    found = table.groupBy("kind", "part").applyInArrow(sums, "byte long, node long, zeros long, ones long, log double")
    found = found.groupBy("byte", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("log")).collect()
    words = next((row for row in found if row[0] < 0), (0, 0, 0, 0, 0.0))
    train_tokens = words[3] + train_texts
    outcomes = train_tokens + words[2] + (train_texts > 0) + 1
    top = docs.sparkSession.sparkContext.broadcast(Top(row for row in found if row[0] >= 0))

    def values(part: pa.Table) -> pa.Table:
        kind, own, keys, total = _gathered(part)
        if kind == WORDS:
            value = np.where(total > 0, 1, -1) * (total + 1.0)  # the sign tells known words
        else:
            tree = levels(keys, total, DEPTH, 2)
            byte = keys & np.uint64(255)
            deeper = mixed_bits(tree, weighted(tree), np.arange(len(keys)), byte)
            value = top.value.log10((keys >> np.uint64(8 * DEPTH)).astype(np.int64), byte, deeper)
        return pa.table({
            "block": part.column("block"), "kind": part.column("kind"), "part": part.column("part"), "keys": part.column("keys"),
            "values": pa.array([_pack(value[np.searchsorted(keys, some)].astype(np.float64 if kind == WORDS else np.float32)) for some in own], pa.binary()),
        })

    valued = table.groupBy("kind", "part").applyInArrow(values, "block long, kind long, part long, keys binary, values binary")
    answered = valued.withColumns({name: F.lit(None).cast(held[name].dataType) for name in held.names})
    asked = blocks.select("block", *[F.lit(None).cast(t).alias(n) for n, t in (("kind", "long"), ("part", "long"), ("keys", "binary"), ("values", "binary"))], *held.names)
    score_type = T.StructType().add("row", row_type)
    for name in ("n_tokens", "n_known"):
        score_type = score_type.add(name, "long")
    for name in ("base_score", "score", "bytes"):
        score_type = score_type.add(name, "double")

    def score(group: pa.Table) -> pa.Table:
        kinds = np.array(group.column("kind").to_pylist(), object)
        at = next(i for i, kind in enumerate(kinds) if kind is None)
        block = opened(group.column("text")[at].as_py(), group.column("sizes")[at].as_py(), group.column("trains")[at].as_py())
        known = {}
        for kind, dtype in ((GRAMS, np.float32), (WORDS, np.float64)):
            mine = np.flatnonzero(kinds == kind).tolist()
            keys = [np.cumsum(_unpack(group.column("keys")[i].as_py(), np.uint64), dtype=np.uint64) for i in mine]
            vals = [_unpack(group.column("values")[i].as_py(), dtype) for i in mine]
            keys, vals = (np.concatenate(keys), np.concatenate(vals)) if mine else (np.zeros(0, np.uint64), np.zeros(0))
            order = np.argsort(keys)
            known[kind] = keys[order], vals[order]
        texts = len(block.sizes)
        score, base, tokens, seen = np.zeros(texts), np.zeros(texts), np.ones(texts, np.int64), np.zeros(texts, np.int64)
        keys, vals = known[GRAMS]
        for key, owner in block.keys():
            coded = pa.array(key).dictionary_encode()
            found = vals[np.searchsorted(keys, coded.dictionary.to_numpy())][coded.indices.to_numpy()]
            score += np.bincount(owner, found, texts)
        keys, vals = known[WORDS]
        for hashed, index, owner in block.words():
            counted = vals[np.searchsorted(keys, hashed)][index]
            base += np.bincount(owner, np.log10(np.abs(counted) / outcomes), texts)
            tokens += np.bincount(owner, minlength=texts)
            seen += np.bincount(owner, counted > 0, texts).astype(np.int64)
        base += np.log10((train_texts + 1) / outcomes)
        rows_ = group.column("rows")[at].values
        return pa.table({
            "row": rows_, "n_tokens": tokens, "n_known": seen + (train_texts > 0), "base_score": base, "score": score,
            "bytes": (block.sizes - DEPTH).astype(np.float64),
        })

    scored = answered.unionByName(asked).groupBy("block").applyInArrow(score, score_type)
    return with_columns(scored, columns, {
        "n_tokens": F.col("n_tokens"), "n_known": F.col("n_known"), "train_tokens": F.lit(train_tokens).cast("long"),
        "base_score": F.col("base_score"), "score": F.col("score"),
        "bits_per_byte": -F.col("score") * F.lit(float(np.log2(10))) / F.col("bytes"),
    })
