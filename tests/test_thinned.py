"""The blanking of statements before the search of function definitions."""

import random

from conftest import files_df
from fimloom.operators import extract, tokens


def test_thinned_files_have_the_same_functions(spark, monkeypatch):
    """What is blanked before the search of definitions holds none of them: random texts of tokens, alone and in forms."""
    rng = random.Random(11)
    parts = ["{", "}", "{", "}", "(", ")", "(x)", ";", ";", "f", "int", "if", "else", "do", "while (a)", "switch (x)", "case 1:", ":", "struct", "=",
             "*", "const", "x = f(a, (b));", "\n#define A {\n", "\n#if A\n", "\n#else\n", "\n#endif\n", "/* { */", "// }\n", '"{;"', "'}'",
             'extern "C" {', 'myextern "C" {', "{ a; b; }", "int g(int a) { return a; }", "M(a) {", "__attribute__((x))", "\\", "'", '"', "({ a; })",
             "int o(a) int a; {", "if (x) { y; }", "else { z; }", "else if (q) {"]
    files = files_df(spark, [(f"/r/{i}.c", " ".join(rng.choice(parts) for _ in range(rng.choice([5, 12, 40])))) for i in range(4000)])
    files = extract.by_key(files, ["file_path"])
    thin = {tuple(r) for r in extract.function_spans(files).collect()}
    monkeypatch.setattr(extract, "thinned", lambda text: text)
    assert thin == {tuple(r) for r in extract.function_spans(files).collect()} and len(thin) > 500


def test_statements_are_thinned(spark):
    """Statements and blocks in a body leave no token but its braces; a nested definition and what follows stay."""
    body = "int f(int a)\n{\n  int b = a; /* { */\n  if (a) { b = g((a + 1) * 2); } else { while (b) { b--; } }\n  switch (a) { case 1: { b = 2; } }\n}\n"
    nested = "int f(int a) { a = 1; int n(int q) { return q; } return a; }"
    rows = files_df(spark, [("a", body), ("b", nested)]).select("file_path", "text", tokens.thinned("text").alias("thin")).collect()
    thin = {r["file_path"]: r["thin"] for r in rows}
    assert thin["a"].split() == "int f(int a) { }".split() and thin["b"].split() == "int f(int a) { int n(int q) { } return a; }".split()
    assert all(len(r["thin"]) == len(r["text"]) for r in rows)
