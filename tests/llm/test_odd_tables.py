"""Every operator and stage on NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm.bpe import decode_ids, encode_texts
from jobtide.llm.exact_dedup import exact_duplicates
from jobtide.llm.jaccard import jaccard_groups
from jobtide.llm.language import fit_language, predict_language
from jobtide.llm.language_model import score_texts
from jobtide.llm.mixing import mix_sources
from jobtide.llm.near_vectors import near_vectors
from jobtide.llm.personal import personal_spans
from jobtide.llm.quality import fit_quality, score_quality
from jobtide.llm.substrings import repeated_passages

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def taught(df):
    labels = df.select("doc_id", F.col("doc_id").cast("int").alias("quality"))
    return score_quality(df, fit_quality(df, labels.withColumn("quality", F.col("quality") % 2)))


PER_ROW = {
    "mixing": mix_sources,
    "language model": lambda df: score_texts(df, F.col("doc_id") % 3 != 0),
    "jaccard": lambda df: jaccard_groups(df),
    "personal": personal_spans,
    "exact": lambda df: exact_duplicates(df, digest_all=True),
    "language": lambda df: predict_language(df, fit_language(df), words=True),
    "bpe": lambda df: encode_texts(df, RANKS, PATTERN, decode=True),
    "quality": taught,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_result_for_every_row(odd, name):
    out = PER_ROW[name](odd)
    rows = out.collect()
    assert len(rows) == odd.count()
    assert len({column.lower() for column in out.columns}) == len(out.columns)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd.collect())
    assert all(r.row in ("r", None) for r in rows)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(empty, name):
    assert PER_ROW[name](empty).collect() == []


def test_passages(odd, empty):
    rows = repeated_passages(odd).collect()
    assert {r.doc_id for r in rows} == {5, 6, 7, None} - {6} and repeated_passages(empty).collect() == []
    assert [r.original for r in rows if r.doc_id == 7] == [False]


def test_exact_values(odd):
    rows = exact_duplicates(odd).collect()
    blank = [r for r in rows if not (r.text or "").split()]
    assert {(r.keep_id, r.group_size) for r in blank} == {(2, 5)}
    assert [r.doc_id for r in blank if r.kept] == [2]
    same = [r for r in rows if (r.text or "").split() == "word".split() * 40_000]
    assert [(r.keep_id, r.group_size) for r in same] == [(11, 1)]
    copies = [r for r in rows if r.text and r.text.split() == rows_words(odd)]
    assert len(copies) == 5 and {r.keep_id for r in copies} == {5} and sum(r.kept for r in copies) == 1


def rows_words(odd):
    return odd.where("doc_id = 5").first().text.split()


def test_jaccard_values(odd):
    rows = jaccard_groups(odd).collect()
    groups = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert groups == {at: at for at in range(12)} | {6: 5, 7: 5, 4: 3, 99: 99}
    assert sum(r.kept for r in rows if r.component_id == 5) == 1
    assert {r.n_shingles for r in rows if r.doc_id in (0, 1, 2)} == {0} and {r.n_shingles for r in rows if r.doc_id == 11} == {1}


def test_language_and_tokens(odd):
    rows = {r.doc_id: r for r in PER_ROW["language"](odd).collect()}
    assert {rows[at].lang_pred for at in (0, 1, 2, 8)} == {"und"} and rows[0].score == 0.0 and len(rows[9].word_langs) == 5
    coded = PER_ROW["bpe"](odd)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in coded.collect())
    again = decode_ids(coded.select("doc_id", "text", "ids"), RANKS, PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again.collect())


def test_score_of_nothing(odd):
    rows = score_texts(odd, F.lit(None).cast("boolean")).collect()
    nothing = next(r for r in rows if r.doc_id == 1)
    assert nothing.n_tokens == 1 and nothing.n_known == 0 and nothing.train_tokens == 0 and nothing.base_score == 0.0
    assert nothing.score == pytest.approx(-8 * 0.30102999566)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [2.0, 0.01], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [], 1), (12, [1.0], 1), (None, [1.0, 0.0], 1), (0, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, kept string, v string")
    out = near_vectors(df)
    found = sorted(((r.vec_id is None, r.vec_id), r.n_links, r.component_id, r.kept) for r in out.collect())
    linked = {0, 1, 2}
    assert [f for f in found if f[0] == (False, 0)] == [((False, 0), 4, 0, True)] * 2
    assert all(f[1:3] == ((4, 0) if f[0][1] in linked or f[0][0] else (0, f[0][1])) for f in found)
    assert near_vectors(df.limit(0)).collect() == [] and out.columns.count("v") == 1


def test_pipeline_on_odd_rows(spark, odd, empty, tmp_path):
    for name, df, least in (("odd", odd, 5), ("empty", empty, 0)):
        folder = str(tmp_path / name)
        df.write.parquet(f"{folder}/documents.parquet")
        labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
        labels.limit(0).write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() >= least
        assert corpus_pipeline.STAGES[0][1](spark, docs, folder).count() == 0  # no labels: every score is 0.5
        assert corpus_pipeline.STAGES[4][1](spark, docs, folder).count() == docs.count()
