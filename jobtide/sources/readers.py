"""Readers for the raw zone, bulk files and processed tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.operators.normalize import canonical_postings
from jobtide.schema import RAW_LINE, RAW_POSTING
from jobtide.sources.csv_records import read_csv_records

#: Names a bulk posting file may carry, in order of preference.
POSTING_FILES = ("linkedin_job_postings.csv", "postings.csv", "job_postings.csv")
SKILL_FILES = ("job_skills.csv",)

CORRUPT = "_corrupt_record"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return bool(fs.exists(hadoop_path))


def _data_children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(path, is_directory) of the visible entries directly below *path*."""
    fs, hadoop_path = _filesystem(spark, path)
    entries = []
    for status in fs.listStatus(hadoop_path):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            entries.append((status.getPath().toString(), status.isDirectory()))
    return sorted(entries)


#: What names of data files end in, before the ending of a compression.
FORMATS = {"parquet": ("parquet",), "json": ("json", "ndjson", "jsonl")}
COMPRESSIONS = ("gz", "bz2", "deflate", "snappy", "lz4", "zst")


def _format_of(name: str) -> str | None:
    """Format by a file's name."""
    endings = name.lower().split(".")[1:]
    while endings and endings[-1] in COMPRESSIONS:
        endings.pop()
    return next((kind for kind, known in FORMATS.items() if endings and endings[-1] in known), None)


def _visible(relative: str) -> bool:
    return not any(part.startswith(("_", ".")) for part in relative.split("/") if part)


def _layouts(spark: SparkSession, path: str) -> dict[tuple[str, str], list[str]]:
    """Children of *path* by (partition column, format); a folder that holds both formats is in both lists.

    Mixed partition layouts (``date=…`` beside ``year=…``) cannot be read in one go, so each is read on its own. A
    visible file of unknown format is an error: nothing is left out silently.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for child, is_directory in _data_children(spark, path):
        name = child.rstrip("/").rsplit("/", 1)[-1]
        column = name.split("=", 1)[0] if is_directory and "=" in name else ""
        fs, child_path = _filesystem(spark, child)
        files, kinds = fs.listFiles(child_path, True), set()
        while files.hasNext():
            file = files.next().getPath().toString()
            relative = file[len(child):] if is_directory else name
            if _visible(relative):
                kind = _format_of(relative.rsplit("/", 1)[-1])
                if kind is None:
                    raise ValueError(f"neither Parquet nor JSON by its name: {file}")
                kinds.add(kind)
        for kind in kinds:
            groups.setdefault((column, kind), []).append(child)
    return groups


def read_ndjson(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_POSTING, multi_line: bool = False,
    **options: object,
) -> DataFrame:
    """JSON records, one per line (or one array per file); bad lines are kept in ``_corrupt_record``."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(multiLine=multi_line, **options).json(paths)


def read_raw_auto(spark: SparkSession, path: str) -> DataFrame:
    """The raw zone, whatever its layouts: each is read as it is, brought to the canonical columns, then united by name.

    Parquet and JSON, nested and flat records may be mixed. Partition columns stay. Lines that are not JSON come as rows
    with ``_corrupt_record`` only; see :func:`corrupt_records`.
    """
    groups = _layouts(spark, path)
    if not groups:
        raise FileNotFoundError(f"no Parquet or JSON files below {path}")
    frames = []
    for (_, kind), members in sorted(groups.items()):
        endings = ",".join(f"{end}{dot}" for end in FORMATS[kind] for dot in ("", *(f".{c}" for c in COMPRESSIONS)))
        only = {"basePath": path, "pathGlobFilter": f"*.{{{endings}}}"}
        if kind == "parquet":
            raw = spark.read.options(**only).option("mergeSchema", "true").parquet(*members)
            frames.append(canonical_postings(raw).withColumn(CORRUPT, F.lit(None).cast("string")))
        else:
            lines = canonical_postings(read_ndjson(spark, members, RAW_LINE, **only))
            frames.append(lines.withColumn("job_id", F.when(F.col(CORRUPT).isNull(), F.col("job_id"))))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def _first_existing(spark: SparkSession, folder: str, names: Iterable[str]) -> str:
    """First of *names* found in *folder* or any folder below it."""
    wanted = tuple(names)
    for name in wanted:
        fs, pattern = _filesystem(spark, folder.rstrip("/"))
        files = fs.listFiles(pattern, True)
        matches = []
        while files.hasNext():
            candidate = files.next().getPath()
            if candidate.getName() == name or candidate.getParent().getName() == name:
                matches.append(candidate.toString() if candidate.getName() == name else candidate.getParent().toString())
        if len(set(matches)) > 1:
            raise ValueError(f"several files named {name}: {sorted(set(matches))}")
        if matches:
            return matches[0]
    raise FileNotFoundError(f"none of {', '.join(wanted)} below {folder}")


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | None, multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_postings_csv(
    spark: SparkSession, folder: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Bulk postings; columns stay text until :func:`coerce_numeric` and friends type them.

    Descriptions may hold line breaks; a file is read by many tasks all the same. *multi_line* off saves a pass where no
    field has breaks.
    """
    path = _first_existing(spark, folder, POSTING_FILES)
    return read_csv_records(spark, path, schema) if multi_line else _read_csv(spark, path, schema, False)


def read_skills_csv(
    spark: SparkSession, folder: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Bulk skill lists, one line per posting, so the file is split among tasks."""
    return _read_csv(spark, _first_existing(spark, folder, SKILL_FILES), schema, multi_line)


def read_parquet_multi(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every path that exists, united by column name; an error when none does."""
    existing = [path for path in paths if path_exists(spark, path)]
    if not existing:
        raise FileNotFoundError(f"no data found in {', '.join(paths)}")
    frames = [spark.read.parquet(path) for path in existing]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def read_training_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by suffix, CSV otherwise."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def corrupt_records(df: DataFrame) -> DataFrame:
    """The lines of :func:`read_ndjson` that did not parse."""
    return df.filter(F.col(CORRUPT).isNotNull())
