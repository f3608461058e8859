"""The pipeline's stages: columns, what each keeps, and the guard."""

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm import queries


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    tokens = corpus_pipeline.tokens(spark, docs, folder).collect()
    assert {r["doc_id"]: r["text"] for r in tokens} == {i: t or "" for i, t in given.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "tokens"]


def test_registered():
    names = set(entry.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))
