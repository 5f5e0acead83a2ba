"""Plan shape guards: the strategy mixture shuffles only by the function key and broadcasts nothing;
the collect step never broadcasts file texts; scans read only the columns they need."""

import re

from conftest import SF_SMALL

from fimloom.operators.strategies import fim
from fimloom.plans import registry


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mixture_shuffles_texts_once(spark, monkeypatch):
    """Texts that need syntax are shuffled for the bucketed table; its branches and the join read the buckets."""
    from fimloom.operators import strategies
    written, own = [], strategies.materialize_bucketed
    monkeypatch.setattr(strategies, "materialize_bucketed", lambda df, *a, **k: (written.append(df), own(df, *a, **k))[1])
    df = fim(registry.functions(spark, SF_SMALL))
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\(\d+\) (\w*Exchange)[^\n]*\n(Input \[[^\n]*)", text)
    assert moved and all(kind == "Exchange" and "func_def" not in cols for kind, cols in moved), moved       # candidate spans alone
    assert set(re.findall(r"Exchange\nInput[^\n]*\nArguments: (\w+)\(", text)) <= {"hashpartitioning"}
    assert "Bucketed: true" in text
    assert len(written) == 1 and "Exchange" not in plan_of(written[0])          # the write's own shuffle is all


def test_collect_never_broadcasts_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 30))
    try:
        plan = plan_of(registry.functions_lazy(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" not in plan
    assert "SortMergeJoin" in plan


def test_scan_prunes_columns(spark):
    plan = plan_of(registry.functions_lazy(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all(s == "struct<doc_id:bigint,text:string,source:string>" for s in schemas), schemas


def test_row_local_strategies_do_not_shuffle(spark):
    for strategy in ("single_line", "empty", "multi_line"):
        plan = plan_of(fim(registry.functions(spark, SF_SMALL), strategy=strategy))
        assert "Exchange" not in plan and "Sort" not in plan, plan
