import pytest

import __spark_entry__
import corpus_pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage(apply(spark, docs, sf_dir), "test-stage")
        assert after.columns == docs.columns, name
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(set(ids)) == len(ids)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in packed} == set(ids)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", "en", "s", 0), (1, "a", "en", "s", 1)]])
def test_stages_on_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() <= len(rows)


def test_every_operator_has_a_query():
    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert "pipeline" in names
