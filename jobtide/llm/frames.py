"""Shared pieces of the text operators: packed rows, whitespace, and slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import scratch_path

#: The characters of `[\x20\x09-\x0D]`.
WHITESPACE = " \t\n\x0b\x0c\r"


def packed(df: DataFrame, columns: Iterable[str]) -> Column:
    """The named columns as one struct, so that no working column can clash with a column of the input."""
    names = [f"`{name}`" for name in columns]
    return F.struct(*[F.col(name) for name in names]) if names else F.struct(F.lit(None).cast("int").alias("none"))


def without_whitespace(text: Column) -> Column:
    for character in WHITESPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def with_columns(df: DataFrame, columns: Iterable[str], new: dict[str, Column], row: str = "row") -> DataFrame:
    """Unpack *row* and add *new*; a new column replaces an input column of the same name, whatever its case."""
    taken = {name.lower() for name in new}
    kept = [F.col(f"`{row}`.`{name}`").alias(name) for name in columns if name.lower() not in taken]
    return df.select(*kept, *[column.alias(name) for name, column in new.items()])


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most *max_bytes* of *column*, or a single row."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for row, length in enumerate(pc.fill_null(pc.binary_length(values), 0).to_pylist()):
            if row > start and size + length > max_bytes:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if batch.num_rows > start:
            yield batch.slice(start)


class Workspace:
    """Intermediate tables in the shared folder that go when a result no longer reads them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.count = spark, scratch_path(spark, name), 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write *df* and read it back, as ``jobtide.plans.store.stored`` does."""
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
