"""The pipeline's stages on a small table, each against what its operator says, and the queries' SQL."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(os.path.join(folder, name))
        docs = out[name] = spark.read.parquet(os.path.join(folder, name))
    return out


def test_stages_keep_columns_and_clean_documents(stages):
    first = stages["documents"]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(stages[n].columns == first.columns for n in names[:-1])
    assert stages["language_id"].count() >= 0.98 * first.count()
    assert stages["personal_data"].count() == stages["decontamination"].count() < stages["near_duplicates"].count()
    last = stages["mixing"]
    assert last.select("doc_id", "replica").distinct().count() == last.count()


def test_one_document_of_each_group_stays(stages):
    from tests.llm.test_search import brute_groups
    rows = [(r["doc_id"], r["text"]) for r in stages["language_id"].where("doc_id < 400").collect()]
    groups = {d: c for d, _, c in brute_groups(rows, 5, 80)}
    kept = {r["doc_id"] for r in stages["near_duplicates"].where("doc_id < 400").collect()}
    # the smallest id of a group is below 400 if any of its members is
    assert kept == {d for d, c in groups.items() if d == c}


def test_no_personal_data_is_left(stages):
    left = stages["personal_data"].where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]|\+1 \([0-9]{3}\) [0-9]{3}-"))
    assert left.isEmpty()
    assert stages["personal_data"].where(F.col("n_chars") != F.length("text")).isEmpty()


def test_no_benchmark_passage_is_left(stages, spark):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items for i in range(max(len(w) - 10, 0) + 1)}
    for r in stages["decontamination"].collect():
        w = words(r["text"])
        assert not any(tuple(w[i:i + 10]) in windows for i in range(len(w)))


def test_stages_take_odd_and_empty_tables(spark, odd_documents, no_documents):
    labelled = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_documents.unionByName(labelled), SF)
        assert set(odd_documents.columns) <= set(out.columns) and out.count() > 0
        assert stage(spark, no_documents, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    report = compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], SF, duck(SF))
    assert report["ok"], report
