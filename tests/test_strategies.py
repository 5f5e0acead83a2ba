"""Golden rows for the strategies (T1-T10) and their fallbacks, with one candidate per function so the
drawn choice is forced; plus invariants over the rendered corpus."""

from conftest import funcs_df

from fimloom.operators import lines as L
from fimloom.operators.strategies import fim
from pyspark.sql import functions as F


def run(spark, texts, strategy):
    return {r.func_index: r for r in fim(funcs_df(spark, texts), strategy=strategy).collect()}


def test_single_line_first_line_quirk(spark):
    # the only eligible line also occurs in the signature: the search starts at 0 and finds it there
    text = "int f(int a) {int a\n}"
    d = L.with_line_pick(funcs_df(spark, [text]).withColumn("key", F.lit("k")), "func_def", "key", 42)
    lp = d.collect()[0].lp
    assert lp.p == 6 and lp.line_end == 11 and 6 <= lp.snip < 11
    r = run(spark, [text], "single_line")[0]
    assert r.flag == "RANDOM_SINGLE_LINE" and r.prefix + r.middle + r.suffix == text
    assert r.middle and "int a"[::-1].startswith(r.middle[::-1])


def test_body_lines_strings_and_continuations(spark):
    text = 'int f(void)\n{\n    s = "a\nb";\n    x = 1 + \\\n        2;\n    ;\n\n}'
    d = funcs_df(spark, [text]).select(L.body_lines(F.col("func_def")).alias("b")).collect()[0].b
    assert [(r.line, r.start) for r in d] == [
        ('s = "a\nb";', text.index("    s =")),
        ("x = 1 + \\\n        2;", text.index("    x =")),
    ]


def test_no_eligible_line_is_useless(spark):
    r = run(spark, ["int f(void)\n{\n    ;\n}"], "single_line")[0]
    assert (r.prefix, r.middle, r.suffix, r.flag) == ("", "", "", "USELESS")


def test_multi_line_needs_five_nonblank_lines(spark):
    four = "int f(void)\n{\n\n    x = 1;\n}"
    five = "int f(void)\n{\n    x = 1;\n\n    y = 2;\n}"
    out = run(spark, [four, five], "multi_line")
    assert out[0].flag == "USELESS"
    r = out[1]
    assert r.flag == "RANDOM_MULTI_LINE"
    # blank lines vanish; the span never starts at line 0
    lines = [ln for ln in five.splitlines() if ln.strip()]
    assert (r.prefix + r.middle + r.suffix).replace("\n", "") == "".join(lines)
    assert r.prefix.startswith("int f(void)\n")


def test_comment_block_variants(spark):
    a = "int f(void)\n{\n    /* c */\n    x = 1;\n    y = 2;\n\n    return 0;\n}"
    b = "int f(void)\n{\n    /* c */\n    x = 1;\n    \n    return 0;\n}"
    c = "int f(void)\n{\n    /* c */\n    x = 1;\n}"
    d = "int f(void)\n{\n    x = 1; /* c */ y = 2;\n\n}"
    out = run(spark, [a, b, c, d], "comment")
    ra = out[0]
    assert (ra.prefix, ra.middle, ra.suffix) == (a[:a.index("*/") + 2] + "\n    ", "x = 1;\n    y = 2;",
                                                 "\n\n    return 0;\n}")
    rb = out[1]        # a whitespace-only line is not a break: the block runs on to the end
    assert rb.middle == "" and rb.suffix == "\n    x = 1;\n    \n    return 0;\n}"
    rc = out[2]        # no empty line: middle is empty and the suffix carries everything
    assert rc.middle == "" and rc.suffix == "\n    x = 1;\n}"
    rd = out[3]        # the one char after the comment is dropped
    assert rd.prefix == d[:d.index("*/") + 2] + "\n" and rd.middle == "y = 2;" and rd.suffix == "\n\n}"
    assert {r.flag for r in out.values()} == {"COMMENT_BLOCK"}


def test_if_block_cuts(spark):
    small = "int f(int x)\n{\n    if (x) {\n        y = 1;\n    }\n}"
    empty = "int f(int x)\n{\n    if (x) {}\n}"
    out = run(spark, [small, empty], "if")
    r = out[0]
    blk = "{\n        y = 1;\n    }"
    i = small.index(blk)
    assert r.flag == "IF_BLOCK" and r.prefix + r.middle + r.suffix == small
    # C1 (whole block) or C2 (inside the braces, trailing blank kept in the middle)
    assert (r.prefix, r.middle) in [(small[:i], blk), (small[:i + 10], "y = 1;\n    ")]
    e = out[1]
    assert e.middle == "{}" and e.flag == "IF_BLOCK"      # empty block: C2 falls back to C1


def test_if_repick_and_long(spark):
    inner = "if (y) {\n            z = 1;\n        }"
    big = ("int f(int x)\n{\n    if (x) {\n        a = 1;\n        b = 2;\n        c = 3;\n        " + inner +
           "\n    }\n}")
    long_ = "int f(int x)\n{\n    if (x) {\n" + "        a++;\n" * 22 + "    }\n}"
    out = run(spark, [big, long_], "if")
    r = out[0]           # a pick over 5 lines is replaced by a block nested in it
    assert r.flag == "IF_BLOCK" and "z = 1;" in r.middle and "a = 1;" not in r.middle
    r = out[1]
    assert r.flag == "IF_BLOCK_LONG" and r.prefix + r.middle + r.suffix == long_
    assert 2 <= (r.prefix[r.prefix.rindex("{"):] + r.middle).count("\n") <= 9


def test_switch_and_loop(spark):
    sw = "int f(int x)\n{\n    switch (x) {\n    case 1: {\n        y = 1;\n    }\n    case 2:\n        y = 2;\n    }\n}"
    lp = "int f(int x)\n{\n    do {\n        x--;\n    } while (x);\n    while (x) {\n        x--;\n    }\n}"
    assert run(spark, [sw], "switch")[0].flag == "SWITCH_CASE"
    r = run(spark, [lp], "loop")[0]
    assert r.flag == "LOOP_BLOCK" and "x--;" in r.middle and r.prefix.endswith(("while (x) ", "while (x) {\n        "))


def test_fallbacks(spark):
    no_blocks = "int f(int x)\n{\n    a = 1;\n    b = 2;\n    c = 3;\n    return a;\n}"
    tiny = "int f(void) { return 0; }"
    for strategy in ("if", "loop", "switch", "comment"):
        out = run(spark, [no_blocks, tiny], strategy)
        assert out[0].flag == "RANDOM_MULTI_LINE"
        assert out[1].flag == "USELESS"
    out = run(spark, ["int f(void)\n{\n    return 0;\n}"], "binary")
    assert out[0].flag == "RANDOM_SINGLE_LINE"


def test_short_function_and_empty(spark):
    text = "int f(int a)\n{\n    return a;\n}"
    r = run(spark, [text], "short")[0]
    assert (r.prefix, r.middle, r.suffix, r.flag) == ("int f(int a)\n", "{\n    return a;\n}", "", "SHORT_FUNCTION")
    r = run(spark, [text], "empty")[0]
    assert r.flag == "EMPTY" and r.middle == ""
    assert r.prefix in (text[:text.index("a;") + 2], text[:text.index("a;") + 2] + "\n    ")
    assert r.suffix == text[text.index("a;") + 2:]


def test_loop_all_long_falls_to_long_variant(spark):
    body = "        x++;\n" * 21
    text = "int f(void)\n{\n    while (a) {\n" + body + "    }\n    for (;;) {\n" + body + "    }\n}"
    r = run(spark, [text], "loop")[0]
    assert r.flag == "LOOP_BLOCK_LONG" and r.prefix + r.middle + r.suffix == text


def test_long_case_block(spark):
    text = "int f(int x)\n{\n    switch (x) {\n    case 1: {\n" + "        x++;\n" * 22 + "    }\n    }\n}"
    r = run(spark, [text], "switch")[0]
    assert r.flag == "SWITCH_CASE_LONG" and r.prefix + r.middle + r.suffix == text
    assert r.prefix.endswith(("case 1: ", "case 1: {\n        "))


def test_comment_at_end_of_function(spark):
    text = "int f(void)\n{\n    x = 1;\n} // tail"
    r = run(spark, [text], "comment")[0]
    assert (r.prefix, r.middle, r.suffix, r.flag) == (text + "\n", "", "\n", "COMMENT_BLOCK")


def test_multi_line_exactly_five(spark):
    text = "int f(void)\n{\n    a();\n    b();\n}"
    r = run(spark, [text], "multi_line")[0]
    lines = text.splitlines()
    assert r.flag == "RANDOM_MULTI_LINE"
    # start line 1 or 2, two or more lines, prefix/middle/suffix rebuild the non-blank lines
    assert r.prefix.split("\n")[0] == lines[0]
    assert (r.prefix + r.middle + r.suffix).split("\n")[:5] == lines


def test_random_select_exact(spark):
    from fimloom.plans.process import random_select
    import pytest
    texts = [f"int f{i}(void) {{ return {i}; }}" for i in range(50)]
    df = funcs_df(spark, texts)
    a = random_select(df, 17).collect()
    b = random_select(df.repartition(7), 17).collect()
    assert len(a) == 17 and sorted(r.func_index for r in a) == sorted(r.func_index for r in b)
    assert random_select(df, 50).count() == 50 and random_select(df, 0).count() == 0
    with pytest.raises(ValueError):
        random_select(df, 51)
