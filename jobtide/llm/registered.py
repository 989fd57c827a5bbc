"""The registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.bpe import encode_texts
from jobtide.llm.exact_dedup import exact_duplicates
from jobtide.llm.jaccard import jaccard_groups
from jobtide.llm.language import fit_language, predict_language
from jobtide.llm.language_model import score_texts
from jobtide.llm.manifest import dataset_manifest
from jobtide.llm.mixing import mix_sources
from jobtide.llm.near_vectors import near_vectors
from jobtide.llm.neighbours import nearest_neighbours
from jobtide.llm.personal import KINDS, counted, listed, personal_spans
from jobtide.llm.quality import fit_quality, score_quality
from jobtide.llm.substrings import repeated_passages
from jobtide.llm.vector_codes import vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return mix_sources(docs)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, ~fold(7), carry=["doc_id"]).withColumn("held_out", fold(7))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_groups(docs, size=3, percent=90, carry=["doc_id"]).drop("kept")


def op5_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    counts = [counted("base", kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_duplicates(docs, carry=["doc_id"], digest_all=True)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_language(docs.select("doc_id", "text", "lang").where(~fold(4)))
    return predict_language(docs.select("doc_id", "text"), model, carry=["doc_id"]).withColumn("held_out", fold(4))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_texts(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id"], decode=True
    )
    return coded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def fold(modulus: int, column: str = "doc_id") -> Column:
    """Whether a row is held out: crc32 of the id as text leaves 2. Rows without an id are not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == 2, F.lit(False))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").where(~fold(4))
    scored = score_quality(docs, fit_quality(docs, labels), carry=["doc_id"])
    return scored.select(
        "doc_id", fold(4).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), carry=["vec_id"])


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"), carry=["vec_id"])


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_manifest(_table(spark, sf_dir, "documents"), carry=["doc_id"])


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_context_tree": op2_context_tree,
    "op3_substrings": op3_substrings,
    "op4_jaccard": op4_jaccard,
    "op5_personal": op5_personal,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language": op7_language,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_near_vectors": op10_near_vectors,
    "op11_vector_codes": op11_vector_codes,
    "op12_neighbours": op12_neighbours,
    "op13_manifest": op13_manifest,
}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _codes_sql() -> str:
    """Four rounds written out; distances as products of doubles, which are exact for integers of this size."""
    near = """a{0} AS MATERIALIZED (
  SELECT vec_id, p.part, min([CAST(list_dot_product(p.x, p.x) + list_dot_product(c.x, c.x) - 2 * list_dot_product(p.x, c.x) AS BIGINT), entry]) AS best
  FROM p JOIN c{0} c ON p.part = c.part GROUP BY ALL
)"""
    move = """m{0} AS (
  SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT p.part, best[2] AS entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS x FROM p JOIN a{0} USING (vec_id, part)) GROUP BY ALL
),
c{1} AS MATERIALIZED (
  SELECT part, entry, coalesce(moved, c.x) AS x FROM c{0} c LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS moved FROM m{0} GROUP BY ALL) USING (part, entry)
)"""
    rounds = ",\n".join(near.format(k) + ",\n" + move.format(k, k + 1) for k in range(4))
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM v, range(4) t(part)),
c0 AS MATERIALIZED (
  SELECT part, entry, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (vec_id) WHERE entry < 256
),
{rounds},
{near.format(4)},
f AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a4 GROUP BY vec_id
),
b AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS x FROM c4)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM f JOIN v USING (vec_id), b
"""


SQL = {
    "op11_vector_codes": _codes_sql(),
    "op13_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.replace('{text}', 'text')} AS leaf,
         {_LEAF.replace('{text}', _SMALL)} AS changed,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x // 2, 3988292384 * (x % 2)))) AS crc
  FROM documents
),
s AS (
  SELECT doc_id, leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN changed ELSE leaf END AS tampered,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS size
  FROM d
),
n AS (
  SELECT tree, 0 AS level, rank, size, leaf AS digest FROM s
  UNION ALL
  SELECT tree, level + 1, rank // 16, any_value((size + 15) // 16), sha256(string_agg(digest, '' ORDER BY rank)) FROM n
  WHERE size > 1 GROUP BY tree, level, rank // 16
),
t AS (
  SELECT tree AS node, 0 AS level, tree AS rank, count(*) OVER () AS size, digest FROM n WHERE size = 1
  UNION ALL
  SELECT any_value(node), level + 1, rank // 16, any_value((size + 15) // 16), sha256(string_agg(digest, '' ORDER BY rank)) FROM t
  WHERE size > 1 GROUP BY level, rank // 16
),
run AS (
  SELECT tree, level, rank // 16 AS run, list(digest ORDER BY rank) AS children FROM n WHERE size > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, rank // 16, list(digest ORDER BY rank) FROM t WHERE size > 1 GROUP BY ALL
),
f AS (
  SELECT doc_id, leaf, tree, tree AS home, rank, size, 0 AS level, tampered AS cur, '' AS proof, FALSE AS done FROM s
  UNION ALL
  SELECT f.doc_id, f.leaf, CASE WHEN f.size = 1 THEN -1 ELSE f.tree END, f.home, CASE WHEN f.size = 1 THEN f.tree ELSE f.rank // 16 END,
         CASE WHEN f.size = 1 THEN (SELECT count(*) FROM n WHERE size = 1) ELSE (f.size + 15) // 16 END,
         CASE WHEN f.size = 1 THEN 0 ELSE f.level + 1 END,
         CASE WHEN f.size = 1 THEN f.cur ELSE sha256(array_to_string(children[:f.rank % 16], '') || f.cur || array_to_string(children[f.rank % 16 + 2:], '')) END,
         CASE WHEN f.size = 1 THEN f.proof ELSE f.proof || array_to_string(children[:f.rank % 16], '') || array_to_string(children[f.rank % 16 + 2:], '') END,
         f.size = 1 AND f.tree = -1
  FROM f LEFT JOIN run ON f.size > 1 AND run.tree = f.tree AND run.level = f.level AND run.run = f.rank // 16
  WHERE NOT f.done AND NOT (f.tree = -1 AND f.size = 1)
)
SELECT doc_id, leaf, n.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.digest AS verified
FROM f JOIN n ON n.tree = f.home AND n.size = 1 JOIN t ON t.size = 1
WHERE f.tree = -1 AND f.size = 1
""",
    "op10_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
),
ok AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE links.a = component.vec_id) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM component
""",
    "op6_exact_dedup": rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256({_NORM}) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
""",
}
