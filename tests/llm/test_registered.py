"""The registered queries: SQL where there is some, and the pipeline as a whole."""

import pytest
from compare import differences, oracle
from rows import ODD, documents

import corpus_pipeline
from starkit.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), oracle(SMALL), queries.ORACLE[name]) == []


def test_there_is_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of odd rows, one of them long enough to pass the rules."""
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, extra=False).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    passage = next(text for doc_id, text, *_ in ODD if doc_id == 17).split()
    items = [(1, " ".join(passage[30:44])), (None, "x"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_keeps_and_drops(spark, folder):
    docs, ids = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        ids.append(sorted((row["doc_id"] for row in docs.select("doc_id").collect()), key=str))
    assert 17 in ids[1] and 17 not in ids[2]  # holds a passage of the benchmark
    assert 1 in ids[1] and 2 not in ids[1] and 3 not in ids[1]  # near copies of 1
    assert ids[3] == ids[2]
    pieces = corpus_pipeline.run(spark, folder)
    assert {row["doc_id"] for row in pieces.collect()} == set(ids[3])


def test_pipeline_of_empty_tables(spark, tmp_path):
    documents(spark, [], extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_secrets_are_masked_in_the_pipeline(spark, folder):
    docs = documents(spark, extra=False)
    found = {row["doc_id"]: row for row in corpus_pipeline.secrets_masked(spark, docs, folder).where("doc_id > 11").collect()}
    assert found[12]["text"] == "[SECRET] and a@b.example.com" and found[12]["n_chars"] == len(found[12]["text"])
    assert found[16]["n_chars"] == 3
    assert corpus_pipeline.secrets_masked(spark, docs, folder).count() == len(ODD)
