"""Plan properties of the registered queries: no cartesian products, no Python
row evaluation, pruned scans."""

import pytest

import __spark_entry__ as E
from conftest import SF0001

# queries that train a model or run a stream are covered by their own tests
SKIP = {"train_lr", "model_accuracy", "score_batch", "score_json", "dedup_score",
        "model_roundtrip", "grid_search", "lexicon_train", "stream_score", "retrain",
        "predict_text", "train_sharded"}
FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
             "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_plan_is_jvm_side_without_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_flagship_scan_reads_two_columns(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,lang:string>" in plan
