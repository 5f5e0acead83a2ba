"""The rendered corpus holds the whole text of every document."""

from conftest import SF_SMALL

from fimloom.plans import registry
from fimloom.sources.corpus import N_TEMPLATES, render_c_files


def test_every_line_reaches_a_function(spark):
    funcs = {}
    for r in registry.functions_lazy(spark, SF_SMALL).collect():
        funcs.setdefault(r.file_path, []).append(r.func_def)
    paths = {r.doc_id: r.file_path for r in registry.c_files(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(paths) == len(docs)
    for d in docs:
        body = max(funcs[paths[d.doc_id]], key=len)
        for line in d.text.split("\n"):
            in_comment = line.replace("*/", "* /")
            in_string = line.replace("\\", "\\\\").replace('"', '\\"')
            assert in_comment in body or in_string in body


def test_awkward_lines_stay_whole(spark):
    lines = ['a */ b', 'say "x" \\ y \\', "it's { } ; //", "/* open", "**/", "\u65e5\u672c \u00b2 123", "\\", '"', "tab\there", "", "# if 0"]
    rows = [(i, "\n".join(lines), "s") for i in range(N_TEMPLATES)] + [(99, None, "s")]
    files = render_c_files(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    funcs = registry.function_table(files).collect()
    forms = (3, 2, 1, 1, 2)                                 # functions of FORMS
    assert len(funcs) == sum(3 + forms[r[0] % 5] for r in rows)
    for i in range(N_TEMPLATES):
        body = next(r.func_def for r in funcs if r.func_name == f"doc_{i}" or (r.func_index == 0 and r.file_path.endswith(tuple(f"doc_{i}{x}" for x in (".c", ".h", ".C")))))
        assert body.rstrip().endswith("return x;\n}")
        for line in lines:
            assert line.replace("*/", "* /") in body or line.replace("\\", "\\\\").replace('"', '\\"') in body
