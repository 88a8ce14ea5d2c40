"""Nulls, empty and very long texts, repeated rows, empty tables, and clashing column names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitchside.llm import queries, stages

LONG = " ".join(f"long{i % 977} word" for i in range(20_000))
TEXT = " ".join(f"some{i} words" for i in range(60))
DOCS = [
    (1, TEXT, "en", "s", 9),
    (1, TEXT, "en", "s", 9),
    (2, TEXT, None, None, None),
    (3, None, "en", "s", None),
    (4, "", "en", None, 0),
    (None, TEXT + " more", "de", "s", 1),
    (None, None, None, None, None),
    (5, LONG, "de", "t", 2),
    (6, "ß\x00 \x0b\n\n12.3", "de", "t", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = [
    "kept", "items", "score", "topic", "n_tokens", "n_words", "pool", "node", "post", "spans",
    "probability", "lang_pred", "d", "v1", "n_found", "digest", "key", "tree", "path", "root", "n",
    "margin", "held_out", "label",
]


@pytest.fixture(scope="module", params=["rows", "none", "clashing"])
def folder(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    docs = spark.createDataFrame(DOCS if request.param != "none" else [], SCHEMA)
    if request.param == "clashing":
        docs = docs.select("*", *[F.lit("other").alias(x) for x in CLASHING])
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (9, 1, 1)]
    spark.createDataFrame(labels if request.param != "none" else [],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, TEXT[20:200]), (None, None), (2, ""), (3, "short")]
    spark.createDataFrame(items if request.param != "none" else [],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    pages = [(1, "http://a/", "x"), (1, "http://a/", "x"), (2, None, None), (None, "??", ""), (3, "", "x")]
    pages = spark.createDataFrame(pages if request.param != "none" else [],
                                  "page_id long, url string, html string")
    if request.param == "clashing":
        pages = pages.withColumn("digest", F.lit(1)).withColumn("newest", F.lit(1))
    pages.write.parquet(f"{path}/pages.parquet")
    vectors = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (2, [1.0, -1.0, 0.0]), (None, [3.0, 0.0, 1.0]),
               (3, None), (4, [1.0, None, 0.0]), (5, [float("nan"), 0.0, 0.0]), (6, []), (7, [1.0])]
    vectors = spark.createDataFrame(vectors if request.param != "none" else [],
                                    "vec_id long, embedding array<float>")
    if request.param == "clashing":
        vectors = vectors.withColumn("x", F.lit(1)).withColumn("component", F.lit(1))
    vectors.write.parquet(f"{path}/embeddings.parquet")
    return request.param, path


#: Rows of the queries that don't read ``documents``.
OTHER_ROWS = {"op7_captures": 5, "op13_whitening": 4 * 3}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_a_row_for_each_row(spark, folder, name):
    kind, path = folder
    n = 0 if kind == "none" else OTHER_ROWS.get(name, len(DOCS))
    assert len(queries.queries()[name](spark, path).collect()) == n


def test_defined_results(spark, folder):
    kind, path = folder
    if kind == "none":
        return

    def told(name, *columns):
        found = queries.queries()[name](spark, path).select("doc_id", *columns).collect()
        return {(r[0], *r[1:]) for r in found}

    near = told("op2_near_duplicates", "component_id", "kept")
    assert {(1, 1, True), (2, 1, False), (3, 3, True), (None, None, True), (4, 4, True)} <= near
    assert told("op3_language", "lang_pred") >= {(3, "und"), (4, "und"), (None, "und")}
    assert {(3, 0), (4, 0)} <= told("op6_token_counts", "n_tokens")
    assert {(1, False), (2, False), (3, True), (5, True)} <= told("op10_benchmark_leaks", "kept")
    assert {(3, True), (1, False)} <= told("op9_quality_outliers", "base_failed")


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, folder, stage):
    _, path = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = stage(spark, docs, path)
    assert found.dtypes == docs.dtypes
    assert {tuple(r) for r in found.collect()} <= {tuple(r) for r in docs.collect()}


def test_near_duplicate_stage_keeps_one_of_a_group(spark, folder):
    kind, path = folder
    if kind == "none":
        return
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = [r["doc_id"] for r in stages.near_duplicates(spark, docs, path).collect()]
    assert 2 not in ids and 1 in ids and ids.count(None) == 2
