"""From raw documents to token ids: quality, exact and near duplicates, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run`` writes each result as
Parquet and reads it again. All stages but the last return the columns of their input. NULL texts count as empty, repeated
rows are duplicates of each other, other columns are carried along whatever their names, and an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.llm.bpe import encode_texts
from jobtide.llm.exact_dedup import exact_duplicates
from jobtide.llm.jaccard import jaccard_groups
from jobtide.llm.mixing import mix_sources
from jobtide.llm.quality import fit_quality, score_quality
from jobtide.llm.registered import fold
from jobtide.plans.store import stored


#: Keys of dropped rows up to this many are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1, ..., so that an operator's results cannot clash with them, and the names by column."""
    names = {name: f"c{at}" for at, name in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{name}`").alias(new) for name, new in names.items()]), names


def _restored(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(new).alias(name) for name, new in names.items()])


def _keyed(docs: DataFrame) -> DataFrame:
    """A key for each row beside its columns: the hash of its file's path, and its place in the file."""
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    except AnalysisException:  # not read from files
        return _keyed(stored(docs, "keyed"))


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of a keyed table that a table of keys with ``kept`` keeps; whole rows move only if very many are dropped."""
    dropped = stored(decided.where("NOT kept").select("__file", "__at"), "dropped")
    side = F.broadcast(dropped) if dropped.count() <= BROADCAST_KEYS else dropped
    return docs.join(side, ["__file", "__at"], "left_anti").drop("__file", "__at")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of quality label 1 is at least 0.7."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~fold(4))
    model = fit_quality(docs.select("doc_id", "text"), labels)
    rows, names = _numbered(docs)
    return _restored(score_quality(rows, model, text_col=names["text"]).where("score >= 0.7"), names)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal without white space."""
    keyed = _keyed(docs)
    return _kept(keyed, exact_duplicates(keyed.select("doc_id", "text", "__file", "__at"), carry=["__file", "__at"]))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    keyed = _keyed(docs)
    rows = keyed.select("doc_id", "text", "__file", "__at")
    return _kept(keyed, jaccard_groups(rows, size=5, percent=80, carry=["__file", "__at"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order in which each source always has its share of the square roots of the counts."""
    rows, names = _numbered(docs)
    mixed = mix_sources(rows, source_col=names["source"], id_col=names["doc_id"])
    return _restored(mixed.orderBy("mix_slot", "mix_rank"), names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, its place in the order of the table (NULL if that was not read from files), digests."""
    import public_tokenizers

    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        rows = docs.select("doc_id", "text", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("at"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = rows.where("file IS NOT NULL").groupBy("file").agg((F.max("at") + 1).alias("size"))
    files = stored(files.select("file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")), "files")
    coded = encode_texts(
        rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id", "file", "at"], decode=True
    )
    return coded.join(files, "file", "left").select(
        "doc_id", (F.col("before") + F.col("at")).alias("position"), F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
    ("mixing sources", mix), ("byte-level BPE", tokens),
]

#: Learned scores, hashes of the mix and merges of the encoding are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, f"stage-{at + 1}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
