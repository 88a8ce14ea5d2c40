"""The pipeline's rows against its stages by other means."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import public_tokenizers

import __spark_entry__ as registry
import corpus_pipeline
from pitchside.llm import decontaminate, sql
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_rows(spark):
    from tokenizers import Tokenizer

    con = duckdb.connect()
    con.sql(f"create table documents as select * from '{SF}/documents.parquet'")
    benchmark = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    con.sql(f"create table sound as with {sql.outliers('documents')}"
            " select doc_id, text, lang, source from judged where kept")
    held = con.sql("select doc_id, text from sound").fetchall()
    near = brute.near_duplicates(held, 80)
    passages = [brute.normal(t)[20:100] for _, t in benchmark]
    # Passages lie in the documents as they are, so a part of one is enough to find them.
    clean = [
        i for i, text in held
        if near[i][2] and not any(p in brute.normal(text) for p in passages if len(p) == 80)
    ]
    con.execute("create table clean as select * from sound where list_contains(?::bigint[], doc_id)",
                [clean])
    mixed = con.sql(f"with {sql.mixing('clean')} select doc_id, text from mixed where kept"
                    " order by doc_id").fetchall()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, wanted = 0, []
    for i, text in mixed:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = registry.queries()["pipeline"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == wanted and len(wanted) > 50


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near-duplicates", "benchmark decontamination", "mixing", "token store",
    ]
    assert decontaminate.Budget().edits(96) == 6
