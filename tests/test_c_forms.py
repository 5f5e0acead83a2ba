"""Golden rows, derived by hand, for C forms between a parameter list and its body, names behind qualifiers,
comments on preprocessor lines and continued line comments."""

import duckdb
import pytest

from conftest import files_df, funcs_df
from fimloom import oracle as O
from fimloom.operators import nodes as N
from fimloom.operators.extract import function_table
from fimloom.operators.strategies import fim

# text, [(name, first line of the function)]
FILES = [
    ("int f(void) __attribute__((noreturn)) { a(); }\nint g(void) { }\n", [("f", "int f(void) __attribute__((noreturn)) { a(); }"), ("g", "int g(void) { }")]),
    ("__attribute__((cold)) int f(void) { }\n", [("f", "__attribute__((cold)) int f(void) { }")]),
    ("int m(void) NOTHROW { return 1; }\n", [("m", "int m(void) NOTHROW { return 1; }")]),
    ("int m(void) NOTHROW;\nint n(int a);\nstatic int p(int a) A B { }\n", [("p", "static int p(int a) A B { }")]),
    ("int g(a) int a; { return a; }\n", [("g", "int g(a) int a; { return a; }")]),
    ("int h(a, f)\nchar *a;\nint (*f)();\n{\n return 0;\n}\nint i(void) { }\n", [("h", "int h(a, f)"), ("i", "int i(void) { }")]),
    ("char * const h(void) { }\nchar *volatile const *i(void) { }\nconst int j(void) { }\nint const k(void) { }\n",
     [(None, "char * const h(void) { }"), (None, "char *volatile const *i(void) { }"), ("j", "const int j(void) { }"), ("k", "int const k(void) { }")]),
    ("struct s { int a; };\nunion u { int b; } v;\nenum e { A, B };\nstruct t x = { 1 };\nint y[] = { N(1) };\ntypedef struct __attribute__((packed)) { int c; } w;\n", []),
    ("DECLARE(foo)\nstruct s { int a; };\n", []),
    ("int f(void)\n{\n // path C:\\\n int x; }\n y();\n}\nint g(void) { }\n", [("f", "int f(void)"), ("g", "int g(void) { }")]),
    ("#define A 1 /* open \" quote {\n still { open */\nint p(void) {\n}\n", [("p", "int p(void) {")]),
    ("#define U \"http://x/*\" // note {\nint q(void) { }\n#if 0 // a \\\n { continued\nint r(void) { }\n#endif /* x */\n",
     [("q", "int q(void) { }"), ("r", "int r(void) { }")]),
    # one head per branch, one body: both come out, and all that follows
    ("#if A\nint f(int a) {\n#else\nint f(void) {\n#endif\n return 1;\n}\nint g(void) { }\n",
     [("f", "int f(int a) {"), ("f", "int f(void) {"), ("g", "int g(void) { }")]),
    ("#if A\nint f(int a) {\n#elif B\nint f(long a) {\n#elif C\nint h(void) {\n#else\nint f(void) {\n#endif\n return 1;\n}\n#ifdef D\nint g(void) { }\n#endif\n",
     [("f", "int f(int a) {"), ("f", "int f(long a) {"), ("h", "int h(void) {"), ("f", "int f(void) {"), ("g", "int g(void) { }")]),
    ("int f(int a)\n{\n#ifdef A\n if (a) {\n#else\n if (!a) {\n#endif\n  b();\n }\n}\nint g(void) { }\n", [("f", "int f(int a)"), ("g", "int g(void) { }")]),
    # a group in a branch, and braces that are none
    ("#ifdef A\n#ifdef B\nint f(int a) { // {\n#else /* { */\nint f(void) {\n#endif\n#else\nint h(char *s) { s = \"{\";\n#endif\n}\nint g(void) { }\n",
     [("f", "int f(int a) { // {"), ("f", "int f(void) {"), ("h", "int h(char *s) { s = \"{\";"), ("g", "int g(void) { }")]),
    # balanced groups keep all branches
    ("#ifdef A\nint f(int a) { }\n#else\nint f(void) { }\n#endif\nint g(void) { }\n",
     [("f", "int f(int a) { }"), ("f", "int f(void) { }"), ("g", "int g(void) { }")]),
    ("#else\nint f(void) { }\n#endif\n#if A\nint g(void) { }\n", [("f", "int f(void) { }"), ("g", "int g(void) { }")]),
    # nested definitions, told apart from macro loops
    ("int f(int a)\n{\n int n(int q) { return q; }\n static char *m(void) { }\n LOOP(a) { b(); }\n x: LOOP(a) { b(); }\n else LOOP(a) { }\n}\nint g(void) { }\n",
     [("f", "int f(int a)"), ("n", "int n(int q) { return q; }"), (None, "static char *m(void) { }"), ("g", "int g(void) { }")]),
    # a type's body before the name, and lines between a parameter list and the body
    ("struct s { int a; } mk(void) { }\nenum { A, B } e(void) { }\nstruct t { int a; } *p(void) { }\nstruct u { int a; };\nint g(void) { }\nint v[] = { 1 };\nint h(void) { }\n",
     [("mk", "struct s { int a; } mk(void) { }"), ("e", "enum { A, B } e(void) { }"), (None, "struct t { int a; } *p(void) { }"),
      ("g", "int g(void) { }"), ("h", "int h(void) { }")]),
    ("int f(int a)\n#ifdef A\n#pragma b\n#endif\n{\n}\nDECLARE(x)\n#define C\nint g(void) { }\n#ifdef W\nint h(long a)\n#else\nint h(int a)\n#endif\n{\n}\nint i(void) { }\n",
     [("f", "int f(int a)"), ("g", "int g(void) { }"), ("h", "int h(int a)"), ("i", "int i(void) { }")]),
    ("#define B(x) do { \\\n  /* c } */ x; \\\n } while (0)\nint s(void) { B(1); }\n", [("s", "int s(void) { B(1); }")]),
]


def test_functions(spark):
    rows = function_table(files_df(spark, [(f"/p/{i:02}.c", t) for i, (t, _) in enumerate(FILES)])).collect()
    for i, (_, want) in enumerate(FILES):
        got = [(r.func_name, r.func_def.split("\n")[0]) for r in sorted(rows, key=lambda r: r.func_index) if r.file_path == f"/p/{i:02}.c"]
        assert got == want, FILES[i][0]


def test_bodies_and_loops(spark):
    """N1 in a function cut out of a group, and N8 beside a nested definition."""
    two = "int f(int a) {\n#else\nint f(void) {\n#endif\n return 1;\n}"
    nested = "int f(int a)\n{\n int n(int q) { return q; }\n LOOP(a) { b(); }\n { c(); }\n}"
    rows = N.nodes_function_body(funcs_df(spark, [two, nested])).collect()
    assert {r.func_index: (two, nested)[r.func_index][r.st:r.en] for r in rows} == {0: two[two.index("{"):], 1: nested[nested.index("{"):]}
    loops = N.nodes_compound(funcs_df(spark, [two, nested])).collect()
    assert sorted((r.func_index, r.kind, nested[r.st:r.en]) for r in loops) == [(1, "bare", "{ c(); }"), (1, "macro", "{ b(); }")]


def test_a_continued_line_comment_ends_no_function(spark):
    text = FILES[9][0]
    row = function_table(files_df(spark, [("/p/a.c", text)])).filter("func_index = 0").first()
    assert row.func_def == text[:text.index("int g")].rstrip()


FUNC = "int f(void)\n{\n#ifdef A /* note */\n    a();\n#endif /* A */ // end \\\n more\n#define S \"/* no */\" '\n    /* own */ b(); // tail\n}"


def test_comments_on_directive_lines(spark):
    got = [FUNC[r.st:r.en] for r in N.nodes_comment(funcs_df(spark, [FUNC])).orderBy("st").collect()]
    assert got == ["/* note */", "/* A */", "// end \\\n more", "/* own */", "// tail"]


def test_comment_strategy_takes_a_directive_comment(spark):
    text = "int f(void)\n{\n#ifdef A /* note */\n    a();\n    b();\n\n#endif\n    c();\n}"
    r = fim(funcs_df(spark, [text]), strategy="comment").first()
    assert (r.flag, r.prefix, r.middle) == ("COMMENT_BLOCK", "int f(void)\n{\n#ifdef A /* note */\n    ", "a();\n    b();")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("CREATE TABLE corpus (file_path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO corpus VALUES (?, ?)", [(f"/p/{i:02}.c", t) for i, (t, _) in enumerate(FILES)])
    con.execute("CREATE TABLE one (file_path VARCHAR, func_index INTEGER, func_def VARCHAR)")
    con.execute("INSERT INTO one VALUES ('/t/a.c', 0, ?)", [FUNC])
    return con


def test_twin_agrees(duck):
    """The DuckDB twin against the same hand-derived rows."""
    ctes = O.functions_ctes()
    ctes = ctes[ctes.index("ftok_raw AS"):]
    rows = duck.sql(f"WITH {ctes}\nSELECT file_path, func_name, func_def FROM ftab ORDER BY file_path, func_index").fetchall()
    for i, (_, want) in enumerate(FILES):
        assert [(n, d.split("\n")[0]) for p, n, d in rows if p == f"/p/{i:02}.c"] == want, FILES[i][0]
    fk = ["file_path", "func_index"]
    sql = "WITH " + O.tokens_cte("t", "one", fk, "func_def") + ",\n" + O.comments_cte("c", "t", fk) + "\nSELECT st, en FROM c ORDER BY st"
    assert [FUNC[a:b] for a, b in duck.sql(sql).fetchall()] == ["/* note */", "/* A */", "// end \\\n more", "/* own */", "// tail"]
