"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import packed, with_columns, without_whitespace
from jobtide.plans.store import stored


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    prefix_chars: int = 256,
    digest_all: bool = False,
) -> DataFrame:
    """Mark, per group of equal texts, the row that stays.

    Texts are equal when identical without whitespace. One pass counts lengths and prefix hashes: a row that is alone
    with its length or, within its length, with its prefix hash is settled. Only the others are grouped by their full hash,
    and, unless *digest_all* wants it for every row, only they are hashed in full. Of a group the row with the most code points stays, then the one with the smallest id.

    Returns one row per input row: the columns *carry* (default: all), then ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` (NULL for settled rows unless *digest_all*). Input columns of these names are replaced.

    NULL text counts as empty; all empty texts form one group. A NULL id sorts after all others. Of repeated rows
    (equal id and text) exactly one is kept. An empty table gives an empty result.
    """
    columns = list(docs.columns if carry is None else carry)
    norm = without_whitespace(F.col("text"))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        packed(docs, columns).alias("row"),
    ).withColumns({"len": F.length(norm), "prefix": F.xxhash64(F.substring(norm, 1, prefix_chars))})

    digest, chars, rid = F.sha2(norm, 256), F.length("text").alias("chars"), F.monotonically_increasing_id().alias("rid")
    if digest_all:  # every text is hashed in full anyway: in the one scan, so that no text is shuffled
        rows = stored(rows.select("id", "row", "len", "prefix", chars, rid, digest.alias("digest")), "exact-keys")
    by_prefix = rows.groupBy("len", "prefix").agg(F.count("*").alias("n"))
    open_groups = by_prefix.where("n > 1").select("len", "prefix", F.lit(True).alias("open"))
    marked = rows.join(open_groups, ["len", "prefix"], "left")
    if digest_all:
        refined = marked.select("id", "row", "open", "chars", "rid", "digest")
    else:
        refined = stored(marked.select("id", "row", "open", chars, rid, F.when(F.col("open"), digest).alias("digest")), "exact-rows")
    candidates = refined.where("open")
    best = F.min(F.struct((-F.col("chars")).alias("shorter"), F.col("id").isNull().alias("unknown"), "id", "rid"))
    groups = candidates.groupBy("digest").agg(best.alias("best"), F.count("*").alias("n"))

    grouped = with_columns(candidates.join(groups, "digest"), columns, {
        "keep_id": F.col("best.id"), "group_size": F.col("n"), "kept": F.col("rid") == F.col("best.rid"),
        "text_sha256": F.col("digest"),
    })
    settled = with_columns(refined.where("open IS NULL"), columns, {
        "keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True), "text_sha256": F.col("digest"),
    })
    return settled.unionByName(grouped)
