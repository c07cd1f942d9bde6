"""The pipeline against brute force on a small fixture, and the SQL of the registered queries."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakejobs.llm import queries as llm
from lakejobs.llm.common import stored
from tests.conftest import SMALL
from tests.llm.test_operators import ROWS, SCHEMA, prose
from tests.oracle import compare, connect


@pytest.mark.parametrize("key", sorted(llm.ORACLE))
def test_equals_sql(spark, key):
    _, reason = compare(llm.QUERIES[key](spark, SMALL), connect(SMALL), llm.ORACLE[key])
    assert reason is None, reason


@pytest.mark.parametrize("key", ["op1_sharding", "op8_toxicity", "op9_simhash"])
def test_one_row_for_each_document(spark, key):
    rows = llm.QUERIES[key](spark, SMALL)
    assert rows.count() == rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(2)
    bench = [(i, prose(900 + i, 30)) for i in range(5)]
    rows, labels = [], []
    for i in range(300):
        words = prose(i, 80).split()
        if i % 5 == 0:
            words[rng.randrange(80)] = words[rng.randrange(80)] = "vilething"
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    near = rows[1][1].split()
    near[40] = "changed"
    rows += [(1001, rows[1][1], "en", "s0", 0), (1002, " ".join(near), "en", "s1", 0)]
    rows += [(2000 + i, f"{prose(3000 + i, 50)} {t} {prose(4000 + i, 50)}", "en", "s2", 0) for i, t in bench]
    rows += [(3000, None, None, None, None), (3001, "", None, None, None)]
    for name, data, schema in (("documents", rows, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    alive = {r.doc_id for r in docs.collect()}
    gone = {"toxicity": {i for i in range(300) if i % 5 == 0}, "simhash": {1001, 1002}, "decontamination": {2000 + i for i in range(5)}}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, corpus), name)
        if name in gone:
            alive -= gone[name]
            assert sorted(r.doc_id for r in docs.collect()) == sorted(alive), name
        if name != "sharding":
            assert docs.columns == columns
    rows = docs.collect()
    assert {r.doc_id for r in rows} <= alive and len(rows) > len(alive) // 2
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_stages_take_odd_and_empty_tables(spark, corpus):
    odd = spark.createDataFrame(ROWS, SCHEMA).withColumn("score", F.lit(1)).withColumn("shard", F.lit("x"))
    for start in (odd, odd.limit(0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, corpus), name)
        assert docs.count() >= 0


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).where("shard BETWEEN 0 AND 39").count() > 200
