"""Registered queries: against their SQL where there is one, and the pipeline on planted rows."""

import os

import pytest
from check_oracle import compare, duck
from cases import prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from courtlens.llm.oracle import ORACLE_SQL
from courtlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
with_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@with_tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, SF) is None


@with_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_has_a_row_for_each_input_row(spark, name):
    table = "pages" if name.split("_")[0] in ("op2", "op3", "op6") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {k.split("_")[0] for k in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, prose(i, 80, 4000)) for i in range(300)]
    toxic = {i for i in range(300) if i % 4 == 0}
    rows = [(i, t + (" what an idiot, moron" if i in toxic else "")) for i, t in rows]
    passage, item = prose(9001, 70, 4000), prose(9002, 30, 4000)
    rows += [(500, prose(1, 80, 4000)), (501, prose(1, 80, 4000)), (501, prose(1, 80, 4000))]
    rows += [(510, f"{prose(600, 40, 4000)} {passage}"), (511, f"{passage} {prose(601, 40, 4000)}")]
    rows += [(520, f"{prose(602, 40, 4000)} {item} {prose(603, 9, 4000)}"), (530, "an 1d10t and a m0r0n " + prose(604, 60, 4000))]
    rows += [(540, None), (541, ""), (None, prose(605, 50, 4000)), (None, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")
    )
    table.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_on_planted_rows(spark, planted, tmp_path):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, planted)
        assert name == "tokens" or out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    toxic = {i for i in range(300) if i % 4 == 0} | {530}
    after = set(seen["toxicity"])
    assert not after & toxic and after >= {i for i in range(300) if i % 4}
    near = set(seen["near_duplicates"])
    assert after - near == {500, 501, 541}
    first, second = (seen["repeated_passages"][i] for i in (510, 511))
    assert first["text"].endswith(prose(9001, 70, 4000)) and second["text"] == prose(601, 40, 4000)
    assert second["n_chars"] == len(second["text"])
    assert set(seen["repeated_passages"]) - set(seen["decontamination"]) == {520}
    assert len(seen["tokens"]) == len(seen["decontamination"])


def test_run_equals_its_stages(spark, planted):
    got = corpus_pipeline.run(spark, planted)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.filter("doc_id = 1").count() == 1


def test_empty_tables(spark, planted, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{planted}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
