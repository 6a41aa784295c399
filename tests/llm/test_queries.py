from __future__ import annotations

import public_tokenizers
import pytest
from cases import DATA, rows_of
from oracle_check import connect, differences
from test_exact_dedup import brute as equal_groups
from test_simhash import brute as near_groups

import corpus_pipeline
from postflow.llm import packing, quality_model, quality_rules
from postflow.llm.common import saved
from postflow.llm.registry import ORACLE, QUERIES

SMALL = str(DATA / "sf0.001")


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SMALL), name, SMALL) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs_over_its_table(spark, name):
    source = {"op5": "pages", "op9": "pages", "op11": "conversations"}.get(
        name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SMALL}/{source}.parquet").select(
        "conv_id" if source == "conversations" else "*").distinct().count()
    assert QUERIES[name](spark, SMALL).count() >= rows


def test_pipeline_equals_plain_stages(spark):
    """The stages against brute force over the same documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    passed = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    scores = quality_model.quality_scores(docs, quality_model.trained(docs, labels)).collect()
    passed &= {r.doc_id for r in scores if r.predicted}
    single = {k for k, keep, *_ in equal_groups([(k, texts[k]) for k in passed]) if k == keep}
    first = {c for _, _, c in near_groups([(k, texts[k]) for k in single])}
    frame = docs
    for want, (_, stage) in zip((None, passed, single, first), corpus_pipeline.STAGES):
        frame = saved(stage(spark, frame, SMALL), "stage")
        assert frame.columns == docs.columns
        if want is not None:
            assert {r.doc_id for r in frame.collect()} == want
    rows = corpus_pipeline.run(spark, SMALL)
    again = packing.pack(frame, public_tokenizers.path("byte_bpe_50k.json"))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(rows_of(rows.select(*key))) == sorted(rows_of(again.select(*key)))
    assert {r[0] for r in rows_of(rows)} == first
