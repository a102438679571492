"""The pipeline and its stages, and the registered queries on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from junctura.llm import contentsort, mixing, queries, simhash, toxicity

TABLES = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{TABLES}/labels.parquet"))
    first = corpus_pipeline.drop_toxic(spark, docs, TABLES)
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in docs.collect() if model.score(r.text) < 0.5}
    second = corpus_pipeline.drop_copies(spark, first, TABLES)
    assert {r.doc_id for r in second.collect()} == {r.doc_id for r in contentsort.exact_groups(first).where("kept").collect()}
    third = corpus_pipeline.drop_near_copies(spark, second, TABLES)
    left = simhash.simhash_groups(second, exact=False, **simhash.NEAR)
    assert {r.doc_id for r in third.collect()} == {r.component_id for r in left.collect()}
    fourth = corpus_pipeline.mix_sources(spark, third, TABLES)
    copies = {r.doc_id: (2 * r.taken + r.size) // (2 * r.size) if r.size else 0 for r in mixing.mix(third).collect()}
    assert fourth.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict() == {i: n for i, n in copies.items() if n}
    last = corpus_pipeline.pack_sequences(spark, fourth, TABLES).toPandas()
    assert set(last["doc_id"]) == {r.doc_id for r in fourth.collect()}


def test_run(spark):
    got = corpus_pipeline.run(spark, TABLES)
    assert got.count() > 0 and got.columns[0] == "doc_id"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TABLES)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    got, want = entry.queries()[name](spark, TABLES).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    key = list(got.columns[:2])
    plain = lambda f: f[list(got.columns)].sort_values(key).reset_index(drop=True).astype(object).where(lambda x: x.notna(), None)
    pd.testing.assert_frame_equal(plain(got), plain(want))


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in entry.queries()} and "pipeline" in entry.queries()
