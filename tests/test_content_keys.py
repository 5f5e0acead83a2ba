"""Functions are cut as if alone, whatever keys they share."""

import pytest
from fimloom.operators.strategies import STRATEGIES, fim
from fimloom.plans.process import function_process, random_select
from fimloom.sources.jsonl import write_jsonl

A = "int a(void)\n{\n    a1 = 1;\n}"
B = "int b(int x)\n{\n    if (x) {\n        b1 = x * 2;\n        b2(x);\n    }\n    /* note */\n    y = 2;\n\n    return x;\n}"
SCHEMA = "file_path string, func_index int, func_name string, func_def string"


def cut(spark, rows, strategy):
    out = fim(spark.createDataFrame(rows, SCHEMA), strategy=strategy).collect()
    return sorted((r.file_path, r.func_index, r.func_name, r.prefix, r.middle, r.suffix, r.flag) for r in out)


@pytest.mark.parametrize("strategy", [s for s in STRATEGIES])
def test_two_functions_under_one_key(spark, strategy):
    a, b = ("/t/a.c", 0, "a", A), ("/t/a.c", 0, "b", B)
    alone = sorted(cut(spark, [a], strategy) + cut(spark, [b], strategy))
    assert cut(spark, [a, b], strategy) == alone


def test_golden_rows_under_one_key(spark):
    got = {r[2]: r for r in cut(spark, [("/t/a.c", 0, "a", A), ("/t/a.c", 0, "b", B)], "expression")}
    assert got["a"][3:] == ("int a(void)\n{\n    ", "a1 = 1;", "\n}", "EXPRESSION_STATEMENT")
    assert got["b"][4] in ("b1 = x * 2;", "b2(x);", "y = 2;") and got["b"][3] + got["b"][4] + got["b"][5] == B


@pytest.mark.parametrize("strategy", ["expression", "if", "single_line", None])
def test_equal_functions_keep_their_count(spark, strategy):
    row = ("/t/a.c", 3, "b", B)
    got = cut(spark, [row, row, row], strategy)
    assert len(got) == 3 and set(got) == set(cut(spark, [row], strategy))


@pytest.mark.parametrize("strategy", ["expression", "comment", "empty", None])
def test_null_and_given_indexes_mix(spark, strategy):
    rows = [("/t/a.c", None, "a", A), ("/t/a.c", None, "b", B), ("/t/a.c", 0, "b", B)]
    alone = sorted((r for x in rows for r in fim(spark.createDataFrame([x], SCHEMA), strategy=strategy).collect()), key=str)
    together = sorted(fim(spark.createDataFrame(rows, SCHEMA), strategy=strategy).collect(), key=str)
    assert together == alone


def test_rows_in_the_reference_format(spark, tmp_path):
    """No func_index in the input: sampling and cutting work, and nothing shuffles to number rows."""
    df = spark.createDataFrame([(f"/t/{i % 3}.c", None, "f", B.replace("2", str(i))) for i in range(40)] + [(None, None, "a", A)] * 2, SCHEMA)
    write_jsonl(df.drop("func_index"), f"{tmp_path}/in")
    out = function_process(spark, f"{tmp_path}/in", 30).collect()
    assert len(out) == 30 and all(r.func_index is None for r in out)
    assert function_process(spark, f"{tmp_path}/in", None).count() == 42


@pytest.mark.parametrize("n", [0, 1, 7, 20, 39, 40])
def test_samples_with_ties_are_exact(spark, n):
    df = spark.createDataFrame([("/t/a.c", i // 8, "a", A) for i in range(40)], SCHEMA)          # groups of equal rows
    assert random_select(df, n).count() == n
