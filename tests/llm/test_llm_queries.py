"""The registered text queries one after another against their SQL twins, and the pipeline's rows."""

import compare
import pytest
import os

import __spark_entry__ as entry_module
import corpus_pipeline
from shelfmark.llm import queries as llm
from shelfmark.session import scratch_scope

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(llm.all_queries()))
def test_text_query(name, spark):
    assert entry_module.queries()[name] is llm.all_queries()[name]
    with scratch_scope(spark) as folder:
        df = entry_module.queries()[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        columns, rows = compare.spark_rows(df)
    assert not os.path.exists(folder)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in llm.ORACLES:
        assert rows
        return
    expected_columns, expected = compare.duck_rows(compare.connect(SF_DIR), llm.ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_pipeline_query(spark):
    with scratch_scope(spark):
        rows = corpus_pipeline.run(spark, SF_DIR).collect()
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert 0 < len(rows) < n and all(r.n_tokens >= 0 and len(r.ids_sha256) == 64 for r in rows)
