"""Plan checks: no Python in the JVM operators, broadcast of the dimensions,
pushed-down scans."""
from sentrel.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_outside_scoring(spark):
    for name in ["p15_to_marked", "a03_aeda", "d03_holdout", "f02_encode", "m02_auprc", "e15_conditional_dist"]:
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, name


def test_label_dimension_is_broadcast(spark):
    p = plan(QUERIES["p12_label_to_num"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["m09_plateau"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in p


def test_vocabulary_has_no_window_over_all_tokens(spark):
    p = plan(QUERIES["f01_build_vocab"](spark, SF_SMALL))
    assert "SinglePartition" not in p and "BroadcastNestedLoopJoin" not in p


def test_records_are_regrouped_once(spark):
    p = plan(QUERIES["f11_to_examples"](spark, SF_SMALL)).split("== Initial Plan ==")[-1]
    assert p.count("Join") == 1 and p.count("Exchange hashpartitioning(id") == 1
