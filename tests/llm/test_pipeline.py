"""The registered queries and the pipeline on a small table."""

import pytest

from strata.llm import queries
from strata.testing import compare, duck
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL).toPandas()
    assert compare(got, duck(SF_SMALL).execute(queries.ORACLE_SQL[name]).df()) is None


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF_SMALL)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert ids and ids < {r.doc_id for r in docs.select("doc_id").collect()}
    assert packed.groupBy("bin_id").sum("piece_size").filter("`sum(piece_size)` > 2048").count() == 0


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, awkward, stage):
    import corpus_pipeline
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, awkward, SF_SMALL)
    assert out.columns == awkward.columns
    assert f(spark, awkward.filter("false"), SF_SMALL).count() == 0
