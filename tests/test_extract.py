"""Golden rows for function extraction (X1-X3) and block kinds."""

from conftest import files_df, funcs_df

from fimloom.operators import nodes as N
from fimloom.operators.extract import function_table

FILE = """#include <stdio.h>
#define MAX(a, b) { (a) > (b) ? (a) : (b) }
struct point { int x; int y; };
enum color { RED, GREEN };
static int table[] = { 1, 2, 3 };
int proto(int a);
char *proto2(void);

/* leading comment is not part of the function */
int first(int a)
{
    return a + 1;
}

char *second(void) { return "}"; }

static unsigned long third(const char *s, int n) {
    int i;
    for (i = 0; i < n; i++) { s++; }
    return (unsigned long) i;
}
"""


def test_function_table_golden(spark):
    out = function_table(files_df(spark, [("/p/src/sbin/a.c", FILE)])).orderBy("func_index").collect()
    assert [r.func_name for r in out] == ["first", None, "third"]
    assert out[0].func_def == "int first(int a)\n{\n    return a + 1;\n}"
    assert out[1].func_def == 'char *second(void) { return "}"; }'
    assert out[2].func_def.startswith("static unsigned long third(const char *s, int n) {")
    assert out[2].func_def.endswith("return (unsigned long) i;\n}")
    assert [r.func_index for r in out] == [0, 1, 2]


def test_no_functions_in_prototypes_or_type_bodies(spark):
    text = "int f(void);\nstruct s { int a; };\nint g[] = {1, 2};\n"
    assert function_table(files_df(spark, [("/p/b.c", text)])).count() == 0


CONSTRUCTS = """int f(int x)
{
    if (x) { a(); } else { b(); }
    if (x) a(); else { c(); }
    if (x) y(); else if (z) { d(); }
    while (x) { x--; }
    for (;;) { break; }
    do { x++; } while (x < 3);
    LIST_EACH(n, h) { n++; }
    { int tmp = 0; }
    switch (x) {
    case 1: { one(); break; }
    case 2: two(); break;
    default: { three(); }
    }
    label: { x = 2; }
    return x;
}"""


def _spans(rows, text):
    return sorted(text[r.st:r.en] for r in rows)


def test_block_kinds(spark):
    f = funcs_df(spark, [CONSTRUCTS])
    ifelse = N.nodes_if_else_block(f).collect()
    assert sorted(r.kind for r in ifelse) == ["else", "if", "if"]
    assert _spans(ifelse, CONSTRUCTS) == ["{ a(); }", "{ b(); }", "{ d(); }"]
    cases = N.nodes_case_block(f).collect()
    assert _spans(cases, CONSTRUCTS) == ["{ one(); break; }", "{ three(); }"]
    loops = N.nodes_compound(f).collect()
    assert sorted((r.kind, CONSTRUCTS[r.st:r.en]) for r in loops) == sorted([
        ("while", "{ x--; }"), ("for", "{ break; }"), ("macro", "{ n++; }"),
        ("bare", "{ int tmp = 0; }"), ("bare", "{ x = 2; }")])
    body = N.nodes_function_body(f).collect()[0]
    assert CONSTRUCTS[body.st:body.en].startswith("{\n    if (x)")


def test_hidden_braces_not_counted(spark):
    text = ('int f(void)\n{\n    char c = \'{\';\n    puts("} {");\n    /* } */\n    // {\n'
            '#define X {\n    if (c) { c = 0; }\n}')
    f = funcs_df(spark, [text])
    ifs = N.nodes_if_else_block(f).collect()
    assert _spans(ifs, text) == ["{ c = 0; }"]
    body = N.nodes_function_body(f).collect()[0]
    assert (body.st, body.en) == (text.index("{\n"), len(text))


def test_offsets_are_code_points(spark):
    text = "int f(void)\n{\n    // \U0001F600\U0001F600 é\n    if (x) { y(); }\n}"
    ifs = N.nodes_if_else_block(funcs_df(spark, [text])).collect()
    assert _spans(ifs, text) == ["{ y(); }"]


def test_extern_c_and_stray_brace(spark):
    text = ('#ifdef __cplusplus\nextern "C" {\n#endif\nint a(void) { return 1; }\nstatic int b(int x)\n{\n'
            '    return x;\n}\n#ifdef __cplusplus\n}\n#endif\n}\nint c(void) { return 3; }\n')
    out = function_table(files_df(spark, [("/p/e.c", text)])).orderBy("func_index").collect()
    assert [r.func_name for r in out] == ["a", "b", "c"]
    assert out[0].func_def == "int a(void) { return 1; }"
    assert out[1].func_def == "static int b(int x)\n{\n    return x;\n}"
    assert out[2].func_def == "int c(void) { return 3; }"
