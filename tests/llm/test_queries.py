"""The registered queries, and the pipeline, over a given table."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from hitloom.llm import queries

DATA = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = [int(name[2:].split("_")[0]) for name in queries.llm_queries()]
    assert sorted(numbers) == list(range(1, 14)) and queries.llm_oracles().keys() <= queries.llm_queries().keys()


@pytest.mark.parametrize("name", queries.llm_oracles())
def test_oracle(spark, name):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    expected = base.execute(queries.llm_oracles()[name]).fetchdf()
    found = queries.llm_queries()[name](spark, DATA).toPandas()
    assert list(found.columns) == list(expected.columns)
    assert sorted(found.values.tolist(), key=repr) == sorted(expected.values.tolist(), key=repr)


def test_searches_have_recall(spark):
    found = queries.op5_projections(spark, DATA).toPandas()
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{DATA}/embeddings.parquet' ORDER BY 1").fetchnumpy()
    ids, x = table["vec_id"], np.array(list(table["embedding"]), float)
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        hits.append(len(set(ids[np.argsort(-score)[:20]]) & set(found[found["query_id"] == ids[i]]["vec_id"])) / 20)
    assert np.mean(hits) >= 0.9


def test_pipeline_stages(spark):
    docs = queries.documents(spark, DATA)
    columns, before = docs.columns, docs.count()
    work = corpus_pipeline.Workspace(spark, "stages")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = work.keep(stage(spark, docs, DATA), name)
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).toPandas()
    assert packed["doc_id"].nunique() == before and packed.groupby("sequence_id")["length"].sum().max() <= 2048


CLASHES = "doc_id long, text string, lang string, source string, n_chars long, p_toxic string, n_lines int, n_removed_lines int"


def test_pipeline_defined_cases(spark, tmp_path):
    """Nulls, empty and repeated texts, clashing columns, and an empty table, through all stages."""
    prose = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, prose), (4, prose), (5, prose + " end"), (6, "short"), (6, "short"), (None, "no id")]
    rows = [(i, text, "en", f"s{n}", 0, "p", n, 7) for n, (i, text) in enumerate(rows)]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for given in (rows, []):
        docs = spark.createDataFrame(given, CLASHES)
        work = corpus_pipeline.Workspace(spark, "cases")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = work.keep(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == [c.split(" ")[0] for c in CLASHES.split(", ")]
        kept = docs.orderBy("n_lines").collect()
        assert [r["n_lines"] for r in kept if r["doc_id"] in (1, 2)] == ([0, 1] if given else [])
        assert sum(1 for r in kept if r["doc_id"] in (3, 4, 5)) == bool(given)
        assert all((r["p_toxic"], r["n_removed_lines"]) == ("p", 7) for r in kept)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).toPandas()
        assert len(packed) == len(kept) and packed["sequence_id"].nunique() == bool(given)
