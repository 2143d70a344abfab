"""The corpus pipeline, stage by stage, on planted cases."""

import hashlib
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from stratalake.llm import queries, simhash_golay
from tests.oracle import connect, differences

DATA = contract.SMALL_DATA
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def data(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", queries.SQL)
def test_same_result_as_duckdb(spark, name):
    assert not differences(contract.queries()[name](spark, DATA), connect(DATA), contract.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op2_license_scan", "op5_merkle", "op7_decontaminate", "op9_pii"])
def test_native_operators_run_no_python(spark, name):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin") if node in plan]


def test_stages_in_order():
    assert len(corpus_pipeline.STAGES) == 5 and contract.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in contract.queries() if n.startswith("op")] == list(queries.QUERIES)


def with_rows(spark, data, rows):
    """The data with more rows, and with columns that the operators use themselves."""
    more = spark.createDataFrame(rows, data.schema)
    return data.unionByName(more).withColumn("score", F.lit("a")).withColumn("_key", F.lit(1)).withColumn("key", F.lit("k"))


def test_language_stage_keeps_texts_and_drops_others(spark, data):
    docs = with_rows(spark, data, [(-1, None, "en", "s", 0), (-2, "12 34 !!", "en", "s", 8), (-3, "漢字漢字漢字漢字", None, None, None), (None, "the of and in it is that", None, None, None)])
    kept = STAGE["language ID"](spark, docs, DATA)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in docs.collect()} - {tuple(r) for r in kept.collect()} == {tuple(r) for r in docs.filter("doc_id < 0").collect()}
    assert STAGE["language ID"](spark, docs.limit(0), DATA).count() == 0


def test_one_document_of_each_group_stays(spark, data):
    text = "an own text of several words that nobody else has, said twice and more often than that"
    rows = [(10**6 + n, text, "en", "s", 1) for n in range(50)] + [(10**6, text, "en", "s", 1), (None, text, "en", "s", 1), (None, "unseen words here", "en", "s", 1)]
    docs = with_rows(spark, data, rows)
    kept = STAGE["SimHash near-dedup"](spark, docs, DATA)
    ids = [r.doc_id for r in kept.collect()]
    found = queries.QUERIES["op10_simhash"](spark, DATA)
    assert kept.columns == docs.columns
    assert sorted(i for i in ids if i is not None) == sorted([r[0] for r in found.select("component_id").distinct().collect()] + [10**6])
    assert ids.count(None) == 1


def test_leaks_go_and_clean_documents_stay(spark, data):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    words = item.split()
    words[5] = "changed"
    docs = with_rows(spark, data, [(-1, f"before {item} after", "en", "s", 1), (-2, " ".join(words), "en", "s", 1), (None, item, None, None, None), (-3, None, None, None, None)])
    kept = STAGE["benchmark decontamination"](spark, docs, DATA)
    gone = {r.doc_id for r in docs.select("doc_id").subtract(kept.select("doc_id")).collect()}
    leaked = {r.doc_id for r in queries.QUERIES["op7_decontaminate"](spark, DATA).collect()}
    assert kept.columns == docs.columns and gone == leaked | {-1, -2, None}


def test_personal_data_is_replaced_only_there(spark, data):
    docs = with_rows(spark, data, [(-1, "write to ann.lee@mail.example.org now", "en", "s", 1), (-2, None, None, None, None)])
    changed = {r.doc_id: r for r in STAGE["PII"](spark, docs, DATA).collect()}
    assert changed[-1].text == "write to [EMAIL] now" and changed[-1].n_chars == 20 and changed[-2].text is None
    spans = {r.doc_id: r.spans for r in queries.QUERIES["op9_pii"](spark, DATA).collect()}
    same = {r.doc_id for r in data.collect() if r.text == changed[r.doc_id].text}
    assert same == {i for i, s in spans.items() if not s}


def test_pipeline_runs_its_stages(spark, data):
    docs = data
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in rows} == ids and len(ids) < data.count()
    assert all(r.length <= 1024 for r in rows)


def test_near_duplicate_chooses_the_same_row_in_any_order(spark):
    said = "one two three four five six seven eight nine ten"
    rows = [(3, said, "en", s, 9) for s in ("b", "a", None, "a")] + [(n, t, "en", "a", 0) for n in (1, None) for t in (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = []
    for docs in (frame.coalesce(1), frame.repartition(3, "source"), frame.orderBy(F.desc_nulls_last("source")).repartition(2)):
        found.append(sorted(corpus_pipeline.near_duplicate(spark, docs, DATA).collect(), key=repr))
    assert found[0] == found[1] == found[2]
    assert sorted(r.doc_id for r in found[0]) == [1, 3] and found[0][0] in [Row(*r) for r in rows]


def test_near_duplicates_replace_columns_of_their_names(spark):
    frame = spark.createDataFrame([(1, "a b c d", "x", 5, 6)], "doc_id long, text string, root string, component_id long, fp long")
    found = simhash_golay.near_duplicates(frame)
    assert sorted(found.columns) == ["component_id", "doc_id", "fp", "root"] and found.first().component_id == 1
