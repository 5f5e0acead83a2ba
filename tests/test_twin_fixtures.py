"""Both engines on hand-written function texts (malformed ones included): the node sets of the Spark
operators equal those of their DuckDB twins."""

import duckdb
import pytest

from conftest import funcs_df
from fimloom import oracle as O
from fimloom.operators import nodes as N

TEXTS = [
    'int f(int a)\n{\n    if (1 == g(s, \\"T%u\\", &n))\n    {\n        y = 1;\n    }\n    x = a + 1;\n}',
    "int g(T *p)\n{\n    p = (void *)&a;\n    q = (int)-x * 3;\n    n = (a) - b << 2;\n    return c ? d : e + 1;\n}",
    "void h(void)\n{\n    switch (k) {\n    case 1: { a(); }\n    case 2: b(); { c(); }\n    default: break;\n    }\n"
    "lbl: { d(); }\n    do { e(); } while (f && g || !h);\n    for (i = 0; i < n; i++) { j += i % 3; }\n}",
    "int k(void) {\n    int z = ({ int t = 1; t + 2; });\n    return z;\n}",
    "int m(void)\n{\n    /* } { */ if (a) { b = \"}\"; } else if (c) { d = '{'; } else { e = 1 + 2 * 3; }\n}",
]
FK = ["file_path", "func_index"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("CREATE TABLE ftab (file_path VARCHAR, func_index INTEGER, func_name VARCHAR, func_def VARCHAR)")
    con.executemany("INSERT INTO ftab VALUES (?, ?, NULL, ?)", [("/t/a.c", i, t) for i, t in enumerate(TEXTS)])
    return con


def chain(*ctes):
    return "WITH " + ",\n".join(ctes)


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_expression_statements_twin(spark, duck):
    sql = chain(O.tokens_cte("t", "ftab", FK, "func_def"), O.structure_cte("s", "t", FK), O.statements_cte("st", "s", FK),
                O.exprstmt_cte("e", "st", FK)) + "\nSELECT file_path, func_index, st, en FROM e"
    assert rows(N.nodes_expression_statement(funcs_df(spark, TEXTS)), FK + ["st", "en"]) == sorted(duck.sql(sql).fetchall())


def test_binary_expressions_twin(spark, duck):
    sql = chain(O.tokens_cte("t", "ftab", FK, "func_def"), O.structure_cte("s", "t", FK), O.statements_cte("st", "s", FK),
                O.binary_cte("b", "st", FK)) + "\nSELECT file_path, func_index, st, en, op FROM b"
    assert rows(N.nodes_binary_expression(funcs_df(spark, TEXTS)), FK + ["st", "en", "op"]) == sorted(duck.sql(sql).fetchall())


def test_blocks_twin(spark, duck):
    sql = chain(O.tokens_cte("t", "ftab", FK, "func_def"), O.structure_cte("s", "t", FK), O.blocks_cte("b", "s", FK)) + \
        "\nSELECT file_path, func_index, st, en, kind FROM b"
    from fimloom.operators.nodes import function_blocks
    got = rows(function_blocks(funcs_df(spark, TEXTS)), FK + ["st", "en", "kind"])
    assert got == sorted(duck.sql(sql).fetchall())


FILES = [
    ("/p/e.c", '#ifdef __cplusplus\nextern "C" {\n#endif\nint a(void) { return 1; }\nstatic int b(int x)\n{\n'
               '    return x;\n}\n#ifdef __cplusplus\n}\n#endif\n}\nint c(void) { return 3; }\n'),
    ("/p/f.c", 'char *g(void) { return "}"; }\nstruct s { int a; };\nint h(int a) { if (a) { return (int)-a; } return 0; }\n'),
]


def test_function_extraction_twin(spark):
    from conftest import files_df
    from fimloom.operators.extract import function_table
    con = duckdb.connect()
    con.execute("CREATE TABLE files (file_path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO files VALUES (?, ?)", FILES)
    k = ["file_path"]
    sql = chain(O.tokens_cte("ftok", "files", k), *O.function_spans_ctes()) + \
        f"\nSELECT s.file_path, s.func_index, s.func_name, {O.sl('c.text', 's.st', 's.en')} FROM fspan s JOIN files c USING (file_path)"
    got = rows(function_table(files_df(spark, FILES)), ["file_path", "func_index", "func_name", "func_def"])
    assert got == sorted(duck_rows := con.sql(sql).fetchall()) and len(duck_rows) == 5
