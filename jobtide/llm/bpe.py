"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.frames import packed, slices, with_columns

#: Encoded pieces that a worker remembers before it starts afresh, and pieces or tokens per query.
CACHED_PIECES, QUERY_BYTES, QUERY_TOKENS = 300_000, 1 << 20, 1 << 20
#: Bytes above which a piece is encoded by the query for long pieces.
LONG_PIECE = 64

#: A state row is a token of a piece. Each step joins neighbours with the merge table, contracts every unfinished piece's
#: leftmost pair of least rank, and ends the pieces that have no such pair. Neighbours are found in one order of all rows.
ENCODE = """
WITH RECURSIVE state(piece, pos, id, done) AS (
  SELECT piece, pos, id, false FROM symbols
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT piece, pos, id, lead(id) OVER w AS next_id, lead(piece) OVER w AS next_piece,
            lag(pos) OVER w AS prev_pos, lag(piece) OVER w AS prev_piece
     FROM state WHERE NOT done WINDOW w AS (ORDER BY CAST(piece AS BIGINT) * 1048576 + pos)
   ), least AS (
     SELECT p.piece, min(CAST(m.rank AS BIGINT) * 1048576 + p.pos) AS best
     FROM pairs p LEFT JOIN merges m ON m.left_id = p.id AND m.right_id = p.next_id AND p.piece = p.next_piece
     GROUP BY p.piece
   )
   SELECT p.piece, p.pos, CASE WHEN p.pos = best % 1048576 THEN CAST(best // 1048576 AS INTEGER) ELSE p.id END, best IS NULL
   FROM pairs p JOIN least USING (piece)
   WHERE best IS NULL OR prev_pos IS DISTINCT FROM best % 1048576 OR prev_piece <> p.piece)
)
SELECT piece, id FROM state WHERE done ORDER BY piece, pos
"""

#: The same for long pieces, which would take as many steps as they have tokens: where nothing that a contraction creates
#: can rank below the pair, all its occurrences go in one step, from left to right as one by one they would.
ENCODE_LONG = """
WITH RECURSIVE state(piece, pos, id, done) AS (
  SELECT piece, pos, id, false FROM symbols
  UNION ALL
  SELECT piece, pos, CASE WHEN hit THEN best ELSE id END, best IS NULL
  FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY piece ORDER BY pos) AS eaten
    FROM (
      SELECT c.piece, c.pos, c.id, c.best,
             coalesce(c.rank = c.best AND CASE WHEN u.rank IS NULL THEN (c.idx - c.run) % 2 = 0 ELSE c.nth = 1 END, false) AS hit
      FROM (
        SELECT *, min(idx) OVER (PARTITION BY piece, rank = best, idx - nth) AS run
        FROM (
          SELECT *, row_number() OVER (PARTITION BY piece, rank = best ORDER BY pos) AS nth
          FROM (
            SELECT a.piece, a.pos, a.id, a.idx, m.rank, min(m.rank) OVER (PARTITION BY a.piece) AS best
            FROM (
              SELECT piece, pos, id, row_number() OVER w AS idx, lead(id) OVER w AS next_id
              FROM state WHERE NOT done WINDOW w AS (PARTITION BY piece ORDER BY pos)
            ) a LEFT JOIN merges m ON m.left_id = a.id AND m.right_id = a.next_id
          )
        )
      ) c LEFT JOIN unsafe u ON u.rank = c.best
    )
  ) WHERE NOT eaten
)
SELECT piece, id FROM state WHERE done ORDER BY piece, pos
"""

DECODE = """
SELECT doc, unhex(string_agg(v.bytes, '' ORDER BY pos)) AS bytes
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """One worker's DuckDB connection with the vocabulary, the merge table, and the pieces encoded so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import duckdb
        import regex

        # The pattern's white space is Unicode's property; this library's \s has some control characters more.
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(
            r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.bytes_to_id = np.zeros(256, np.int32)
        for value in range(256):
            self.bytes_to_id[value] = ranks[bytes([value])]
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "bytes": [token.hex() for token in ranks]})
        merges = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items() for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        left, right, rank = (np.array(column, np.int32) for column in zip(*merges, strict=True))
        unsafe = np.union1d(left[rank < left], right[rank < right]).astype(np.int32)
        for name, table in (
            ("vocabulary", vocabulary), ("merges", pa.table({"left_id": left, "right_id": right, "rank": rank})),
            ("unsafe", pa.table({"rank": unsafe})),
        ):
            self.con.register("incoming", table)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.con.unregister("incoming")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not met before, some at a time, and long ones apart."""
        raw = [piece.encode() for piece in pieces]
        begin = size = 0
        for at, piece in enumerate([*raw, b""]):
            is_long, after_long = len(piece) > LONG_PIECE, at > begin and len(raw[at - 1]) > LONG_PIECE
            if at == len(raw) or (at > begin and (is_long or after_long or size + len(piece) > QUERY_BYTES)):
                self._encode(raw[begin:at])
                begin, size = at, 0
            size += len(piece)

    def _encode(self, raw: list[bytes]) -> None:
        if not raw:
            return
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lengths)
        piece = np.repeat(np.arange(len(raw), dtype=np.int32), lengths)
        symbols = pa.table({
            "piece": piece, "pos": (np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)).astype(np.int32),
            "id": self.bytes_to_id[np.frombuffer(b"".join(raw), np.uint8)],
        })
        self.con.register("symbols", symbols)
        found = self.con.sql(ENCODE_LONG if lengths[0] > LONG_PIECE else ENCODE).to_arrow_table()
        self.con.unregister("symbols")
        counts = np.bincount(found["piece"].to_numpy(), minlength=len(raw))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.lengths = np.concatenate([self.lengths, counts])
        self.ids = np.concatenate([self.ids, found["id"].to_numpy().astype(np.int32)])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if len(self.known) > CACHED_PIECES:
            self.forget()
        fresh: list[str] = []
        known, per_text, parts = self.known, [], []
        for text in texts:
            pieces = self.pattern.findall(text)
            try:
                at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            except KeyError:
                for piece in pieces:
                    if piece not in known:
                        known[piece] = len(known)
                        fresh.append(piece)
                at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            parts.append(at)
            per_text.append(len(at))
        self._learn(fresh)
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - lengths), lengths)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        out = [b""] * len(counts)
        ends, begin = np.cumsum(counts), 0
        while begin < len(counts):
            first = ends[begin] - counts[begin]
            stop = max(begin + 1, int(np.searchsorted(ends, first + QUERY_TOKENS, "right")))
            taken = ids[first : ends[stop - 1]]
            if (taken < 0).any():
                raise ValueError("ids are not negative")
            tokens = pa.table({
                "doc": np.repeat(np.arange(begin, stop), counts[begin:stop]), "pos": np.arange(len(taken)), "id": taken,
            })
            self.con.register("tokens", tokens)
            for doc, value in self.con.execute(DECODE).fetchall():
                out[doc] = value
            self.con.unregister("tokens")
            begin = stop
        return out


_CODECS: dict[str, Codec] = {}


def _shared(docs: DataFrame, ranks_path: str, pattern: str):
    """The vocabulary, read by the driver and broadcast (of fixed size), and a key by which a worker keeps its codec."""
    ranks = read_ranks(ranks_path)
    key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    return key, docs.sparkSession.sparkContext.broadcast((ranks, pattern))


def _codec(key: str, shared) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*shared.value)
    return _CODECS[key]


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", carry: Sequence[str] | None = None,
    decode: bool = False,
) -> DataFrame:
    """Encode every whole text; with *decode*, decode the ids again in the same pass.

    *ranks_path*: a rank file; the driver reads it and broadcasts it (a vocabulary, of fixed size). *pattern* splits a
    text into pieces, which are encoded separately. No special tokens.

    Returns the columns *carry* (default: all), ``ids`` (binary: little-endian unsigned 32-bit integers) and, with
    *decode*, ``decoded`` (binary). Input columns of these names are replaced. NULL and empty texts give empty ids and
    bytes; repeated rows are encoded each; an empty table gives an empty result. Pieces of any length are encoded whole.
    """
    columns = list(docs.columns if carry is None else carry)
    key, shared = _shared(docs, ranks_path, pattern)
    rows = docs.select(packed(docs, columns).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared)
        for part in slices(batches, "text"):
            ids, counts = codec.encode([text or "" for text in part.column("text").to_pylist()])
            raw, ends = ids.astype("<u4"), np.cumsum(counts)
            encoded = [raw[end - count : end].tobytes() for end, count in zip(ends, counts, strict=True)]
            decoded = codec.decode(ids, counts) if decode else [None] * len(encoded)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(encoded, pa.binary()), pa.array(decoded, pa.binary())], ["row", "ids", "decoded"]
            )

    new = {"ids": F.col("ids")} | ({"decoded": F.col("decoded")} if decode else {})
    return with_columns(rows.mapInArrow(run, schema), columns, new)


def decode_ids(
    encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", carry: Sequence[str] | None = None
) -> DataFrame:
    """The bytes of encoded texts, as ``decoded`` beside the columns *carry* (default: all).

    NULL and empty ids give empty bytes; an id that the vocabulary lacks adds nothing.
    """
    columns = list(encoded.columns if carry is None else carry)
    key, shared = _shared(encoded, ranks_path, pattern)
    rows = encoded.select(packed(encoded, columns).alias("row"), F.col(f"`{ids_col}`").alias("ids"))
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared)
        for part in slices(batches, "ids"):
            arrays = [np.frombuffer(value or b"", "<u4").astype(np.int32) for value in part.column("ids").to_pylist()]
            decoded = codec.decode(np.concatenate(arrays), np.array([len(a) for a in arrays]))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(decoded, pa.binary())], ["row", "decoded"])

    return with_columns(rows.mapInArrow(run, schema), columns, {"decoded": F.col("decoded")})
