"""The registered queries and the pipeline on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from wellspring.llm import decontaminate, jaccard_join, quality
from wellspring.llm.oracles import ORACLES
from wellspring.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_whole_results(spark, name):
    got = QUERIES[name](spark, SF)
    table = "pages" if "html" in name else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    found = got.select(key)
    assert ids.exceptAll(found.distinct()).count() == 0 and found.distinct().exceptAll(ids).count() == 0


def test_verdicts_can_be_filtered(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = quality.judge(docs).collect()
    judged = quality.judge(docs)
    for column in ("kept", "base_failed"):
        want = sorted(r.doc_id for r in rows if r[column])
        assert sorted(r.doc_id for r in judged.where(column).collect()) == want
    for column in set(judged.columns) - {"doc_id", "kept", "base_failed"}:
        assert judged.where(f"{column} >= 0").count() == len(rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontaminated", "packed"]
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    assert first.columns == names and {r.doc_id for r in first.collect()} == good
    groups = jaccard_join.components(first, 5, (80, 100)).collect()
    second = corpus_pipeline.near_duplicates(spark, first, SF).cache()
    assert {r.doc_id for r in second.collect()} == {r.component_id for r in groups}
    third = corpus_pipeline.decontaminated(spark, second, SF).cache()
    marks = decontaminate.scan(second, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in marks.where("NOT contaminated").collect()}
    last = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in third.collect()}
