"""Large files are cut into runs of whole tokens: the same rows, and no token array of the whole file."""

from conftest import files_df

from fimloom.operators import tokens as T
from fimloom.operators.extract import function_table

UNIT = 'int f@(int a)\n{\n  /* note } */ // x \\\n more\n  char *s = "q \\" {";\n#define A@ 1 /* c\n { */\n  return a + @;\n}\n'


def test_runs_give_the_same_tokens(spark, monkeypatch):
    text = "".join(UNIT.replace("@", str(n)) for n in range(150)) + "   \n"
    df = files_df(spark, [("/p/a.c", text), ("/p/b.c", ""), ("/p/c.c", "int g(void) { }")])
    whole = sorted(tuple(r) for r in T.tokenize(df, ["file_path"], "text").collect())
    for run in (1, 7, 256):
        monkeypatch.setattr(T, "LARGE_TEXT", 50)
        monkeypatch.setattr(T, "RUN_TOKENS", run)
        assert sorted(tuple(r) for r in T.tokenize(df, ["file_path"], "text").collect()) == whole


def test_a_file_of_some_megabytes(spark):
    """Long tokens and many functions (some 6 MB, over LARGE_TEXT; smaller than real giants, to keep the test short)."""
    n = 20000
    text = "".join(UNIT.replace("@", str(i)) for i in range(n)) + "/* " + "x" * 3_000_000 + " */\n" + UNIT.replace("@", str(n))
    assert len(text) > 4 * T.LARGE_TEXT
    out = function_table(files_df(spark, [("/p/big.c", text)])).select("func_index", "func_name", "func_def").collect()
    assert len(out) == n + 1
    for r in out:
        assert r.func_name == f"f{r.func_index}" and r.func_def == UNIT.replace("@", str(r.func_index)).rstrip()
