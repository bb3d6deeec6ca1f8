"""The registered queries: their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import differences, type_differences
from millrace.llm import simhash
from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.staging import release, stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    assert differences(df.toPandas(), db.execute(ORACLES[name]).df()) is None
    assert type_differences(df, db, ORACLES[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        sizes.append(docs.count())
        if name != "mixing":
            assert docs.exceptAll(before).count() == 0
        if name == "near_duplicates":
            components = simhash.near_duplicates(before)
            assert docs.count() == components.select("component_id").distinct().count()
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    n = out.count()
    assert n > 0 and out.agg(F.max("slot")).first()[0] == n - 1 and out.select("slot").distinct().count() == n


def test_pipeline_with_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, through all stages; twice the same."""
    good = [(i, f"the {i} of and to in a is that it was for on with as be by at this an are or from not " + " ".join(f"w{i * 7 + j}" for j in range(30)), "en", "abc"[i % 3], 1) for i in range(30)]
    odd = [(None, None, None, None, None), (None, "", "en", "a", 0), (101, None, "en", None, 1), (102, "", None, "b", 2), (None, good[3][1], "en", "a", 1),
           (4, good[4][1], "en", "b", 1), (4, good[5][1], "en", "b", 1), (103, "##### $$$$$ %%%%% " * 40, "en", "a", 3), (104, "word another " * 20_000, "xx", "c", 9)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    sizes = []
    for parts in (1, 3):
        docs = stored(spark.createDataFrame(good + odd + good[:4], schema).repartition(parts), "odd-documents")
        counts = []
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF), f"odd-{name}")
            assert docs.schema.names == schema.names
            counts.append(docs.count())
        counts.append(corpus_pipeline.STAGES[-1][1](spark, docs, SF).count())
        sizes.append(counts)
    assert sizes[0] == sizes[1] and sizes[0][-1] > 0
    none = stored(spark.createDataFrame([], schema), "no-documents")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_tables_of_earlier_stages_go(spark):
    a, b = stored(spark.range(5), "release-a"), stored(spark.range(6), "release-b")
    release(spark, b)
    assert b.count() == 6
    with pytest.raises(Exception, match="release-a|FILE_NOT_EXIST|PATH"):
        spark.read.parquet(a.inputFiles()[0]).count()


def test_one_query_an_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
