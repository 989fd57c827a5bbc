"""Records of CSV files whose fields hold line breaks, with each file read by many tasks."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.plans.store import stored

#: What a piece of a byte range is: a whole record, the end of one that an earlier range began, the begin of one, or a range
#: inside one.
WHOLE, END, BEGIN, INSIDE = 0, 1, 2, 3
_PIECES = "file long, block long, kind int, first boolean, text string"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with the file and the byte range that they begin in. Carriage returns stay, as fields may hold them."""
    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def open_blocks(lines: DataFrame) -> DataFrame:
    """(file, block, open) for every byte range: whether it begins inside a quoted field.

    That is so after an odd number of quotation marks in the ranges before it; a range counts only its own.
    """
    marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(marks).alias("marks"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per byte range
    return counted.select("file", "block", (F.coalesce(F.sum("marks").over(earlier), F.lit(0)) % 2 == 1).alias("open"))


def _cut(lines: list[str], starts: np.ndarray) -> list[str]:
    """Lines from one start to the next, joined."""
    ends = np.append(starts[1:], len(lines))
    return [lines[a] if b == a + 1 else "\n".join(lines[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def pieces(batches: Iterable[pa.RecordBatch], open_at: dict[tuple[int, int], bool]) -> Iterator[pa.RecordBatch]:
    """Cut the lines of byte ranges, in order, into records and the parts of records at the ranges' ends."""
    now, inside, begun, kept, first = None, False, False, [], False

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "kind", "first", "text"])

    def closed() -> list[tuple]:
        """What is left of a range at its end: an open record, or the last whole one."""
        if now is None or not kept:
            return []
        kind = (BEGIN if begun else INSIDE) if inside else (WHOLE if begun else END)
        return [(*now, kind, first and begun, "\n".join(kept))]

    for batch in batches:
        file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        marks = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        rows = []
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == b:
                continue
            place = (int(file[a]), int(block[a]))
            if place != now:
                rows += closed()
                if place not in open_at:
                    raise RuntimeError("the files were split in another way than when their quotation marks were counted; read them again")
                now, inside, kept, first = place, open_at[place], [], place[1] == 0
                begun = not inside
            lines = batch.column("line").slice(a, b - a).to_pylist()
            before = (int(inside) + np.cumsum(marks[a:b]) - marks[a:b]) % 2  # inside a field where the line begins
            starts = np.flatnonzero(before == 0)
            inside = bool((before[-1] + marks[b - 1]) % 2)
            if not len(starts):
                kept += lines
                continue
            kept += lines[: starts[0]]
            if kept:  # ends here: a record that began in this range, or in an earlier one
                rows.append((*now, WHOLE if begun else END, first and begun, "\n".join(kept)))
                first = first and not begun
            records = _cut(lines, starts)
            for text in records[:-1]:
                rows.append((*now, WHOLE, first, text))
                first = False
            kept, begun = lines[starts[-1] :], True
        yield emit(rows)
    yield emit(closed())


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, first, text): the records of the files; *first* marks the first of each file.

    Quotation marks stand in pairs, as RFC 4180 demands. A first pass counts them per byte range, the running sums tell in
    which state each range begins, and a second pass cuts every range on its own. Only records that cross ranges are
    brought together, by record. The ranges' states (some 100 bytes each) are sent to every task.
    """
    lines = _lines(spark, paths)
    open_at = {(r["file"], r["block"]): r["open"] for r in open_blocks(lines).toLocalIterator()}
    found = stored(lines.mapInArrow(lambda batches: pieces(batches, open_at), _PIECES), "csv-pieces")
    whole = found.where(F.col("kind") == WHOLE).select("file", "first", "text")
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = found.where(F.col("kind") != WHOLE).withColumn("record", F.sum((F.col("kind") == BEGIN).cast("int")).over(order))
    sorted_parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    across = parts.groupBy("file", "record").agg(
        F.bool_or("first").alias("first"), F.array_join(F.transform(sorted_parts, lambda p: p["text"]), "\n").alias("text")
    )
    return whole.unionByName(across.select("file", "first", "text"))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table from CSV files with a header each, equal to the reader's own multi-line mode.

    Columns are texts named by the header of the first file, or those of *schema*. Line breaks inside fields stay as they are;
    blank records are skipped, a missing field is NULL.
    """
    records = csv_records(spark, [path])
    if schema is None:
        # The header is where the file begins: no more than the first lines are read for it.
        names = _header(spark, path)
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    text = F.rtrim(F.col("text"), F.lit("\r"))
    body = records.where(~F.col("first")).select(text.alias("text")).where(F.length(F.trim("text")) > 0)
    parsed = F.from_csv("text", F.lit(_ddl(schema)), {"escape": '"'})
    return body.select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file that is not empty, from its first record."""
    first = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", "_metadata.file_size").distinct().where("file_size > 0")
    name = first.agg(F.min("file_path")).first()[0]
    if name is None:
        raise ValueError(f"no header below {path}")
    for many in (1, 16, 1024):
        lines = [r["value"] for r in spark.read.option("lineSep", "\n").text(name).limit(many).collect()]
        for end in range(1, len(lines) + 1):
            if sum(line.count('"') for line in lines[:end]) % 2 == 0:
                return next(csv.reader(["\n".join(lines[:end]).lstrip("﻿").rstrip("\r")]))
    raise ValueError(f"the header of {name} does not end")
