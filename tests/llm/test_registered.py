"""Registered queries and the pipeline over given tables."""

import collections

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from lexispark.llm import bpe, decontam, langid, linededup, neardup
from lexispark.llm.common import stage, table
from lexispark.llm.queries import ORACLE, QUERIES, vocabulary

SF0001 = "/root/testdata/sf0.001"


def test_all_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    from compare import compare
    found = compare(spark, SF0001, [name])
    assert found[name].startswith("OK"), found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_sql_return_a_row_for_each_document(spark, name):
    assert QUERIES[name](spark, SF0001).count() == table(spark, SF0001, "documents").count()


def test_the_pipelines_stages_take_effect(spark):
    docs = table(spark, SF0001, "documents")
    columns = docs.columns
    for name, function in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(function(spark, docs, SF0001), "test")
        after = out.collect()
        if name == "language_id":
            assert {r.doc_id for r in after} == {r.doc_id for r in langid.identify(docs, langid.fit(
                docs, docs.doc_id.isNotNull())).collect() if r.lang_pred != "und" and r.score >= P.MIN_LANGUAGE_SCORE}
        if name == "line_dedup":
            assert set(before) == {r.doc_id for r in after}
            lines = collections.Counter(k for r in after for k in set(linededup.keys_of(r.text)) if k)
            assert max(lines.values()) < 10
        if name == "near_dedup":
            classes = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
            assert {r.doc_id for r in after} == set(classes.values())
        if name == "decontamination":
            hit = {r.doc_id for r in decontam.contamination(docs, table(spark, SF0001, "benchmark")).collect() if r.n_hit}
            assert {r.doc_id for r in after} == set(before) - hit
        if name == "byte_bpe":
            tokens = bpe.read_ranks(vocabulary("byte_bpe_multi_50k.tiktoken")[0])
            assert {r.doc_id: b"".join(tokens[i] for i in r.ids).decode() for r in after} == before
        else:
            assert out.columns == columns
        docs = out


def test_run_is_the_stages_in_a_row(spark):
    assert P.run(spark, SF0001).count() > 0
