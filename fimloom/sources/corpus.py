"""A C corpus derived from the ``documents`` table.

The driver tables hold no C source, so every registered query first renders one C file per
document.  Each line of a document becomes one statement chosen by ``(doc_id + line_no) % 16`` that
holds the line's whole text: ``{c}`` in a comment (``*/`` is split), ``{s}`` in a string (``\\`` and
``"`` are escaped); ``{k}`` is the line's length.  The same templates are rendered by the DuckDB
oracle (``fimloom.oracle``), so the whole corpus grows with the documents table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

I = "    "
II = "        "

# Statement templates, indexed by (doc_id + line_no) % 16.
STATEMENTS = [
    I + "// {c} .\n",
    I + "/* {c} } */\n" + I + "x = {k};\n\n",
    I + 'x += y * size("{s}") + {k};\n',
    I + "if (x > {k})\n" + I + "{\n" + II + 'puts("{s} }");\n' + I + "}\n",
    I + "if (x < {k}) {\n" + (II + "x = x + 1;\n") * 22 + I + "} else {\n" + II + 'y = size("{s}");\n' + I + "}\n",
    I + "for (j = 0; j < {k}; j++)\n" + I + "{\n" + II + "if (j == 2) { c = '}'; } /* {c} */\n" + I + "}\n",
    I + "while (x > {k}) {\n" + II + "x = x - 1;\n" + I + "} /* {c} */\n",
    I + "switch (x % 3) {\n" + I + "case 0: {\n" + II + 'y = size("{s}");\n' + II + "break;\n" + I + "}\n"
    + I + "case 1:\n" + II + "y = 1;\n" + II + "break;\n" + I + "default: {\n" + II + "y = 2;\n" + I + "}\n" + I + "}\n",
    I + "LIST_FOR_EACH(node, head) {\n" + II + 'y += size("{s}");\n' + I + "}\n\n",
    I + "do {\n" + II + "x--; // {c} .\n" + I + "} while (x > {k});\n",
    I + 'x = (x + size("{s}")) * (y - {k});\n\n',
    I + "if (!x) { /* {c} */ }\n",
    I + "while (y < {k}) {\n" + (II + "y = y * 2 + 1;\n") * 21 + II + 'puts("{s}");\n' + I + "}\n",
    I + "switch (y) {\n" + I + "case {k}: {\n" + (II + "y = y - 1;\n") * 20 + II + 'puts("{s}");\n' + I + "}\n" + I + "}\n",
    I + "if (x == {k}) {\n" + II + "x = 0;\n" + I + "} else if (y != {k} && x >= 2) {\n" + II + "y = x << 1;\n"
    + I + "} else {\n" + II + 'z = -x + ~size("{s}");\n' + I + "}\n",
    I + "int arr[3] = {1, 2, {k}};\n" + I + 's = "{s} \\" }";\n' + I + "CALL_MACRO(a, \\\n" + I + "           b);\n",
]

N_TEMPLATES = len(STATEMENTS)

# Directory by doc_id % 7, extension by doc_id % 11, return type by doc_id % 3.
DIRS = ["resource", "webplugin", "src/sbin", "resource_x", "src", "src", "src"]
RET_TYPES = ["char *", "static int ", "int "]


FILE_HEAD = "#include <stdio.h>\n{r}doc_{id}(int x, int y);\n\n/* doc {id} */\n{r}doc_{id}(int x, int y)\n{\n" \
            + I + "int j = 0, c = 0, z = 0;\n" + I + "char *s = 0;\n"
FILE_TAIL = I + "return x;\n}\n\nint helper_{id}(int a)\n{\n" + I + "char *s = (char *)&a;\n" \
            + I + "if (a > {m}) {\n" + II + "return a - 1;\n" + I + "}\n" \
            + I + "return (int)s[0] * 2 + -a;\n}\n\nstatic int tail_{id}(int v) { return v + {id}; }\n"

# What follows at a file's end, by doc_id % 5: a function with two heads, a nested one beside a macro loop,
# one that returns a type with a body, preprocessor lines before a body, and one function in two branches.
FORMS = [
    "\n#if LEVEL > {m}\nint cond_{id}(int a) {\n#else\nint cond_{id}(void) {\n" + I + "int a = 0;\n#endif\n" + I + "return a + {id};\n}\n"
    + "\nint after_{id}(int a) { return a; }\n",
    "\nint outer_{id}(int a)\n{\n" + I + "int nested_{id}(int q) { return q * 2; }\n" + I + "LIST_FOR_EACH(node, head) {\n" + II
    + "a += nested_{id}(a);\n" + I + "}\n" + I + "return a;\n}\n",
    "\nstruct pair_{id} { int a; int b; } make_{id}(void)\n{\n" + I + "struct pair_{id} p = {1, {m}};\n" + I + "return p;\n}\n",
    "\nint split_{id}(int a)\n#ifdef TRACE /* {m} */\n#pragma trace\n#endif\n{\n" + I + "return a ? -a : {id};\n}\n",
    "\n#ifdef WIDE\nlong either_{id}(void) { return 1; }\n#else\nint either_{id}(void) { return 0; }\n#endif\n",
]


def split_template(t: str) -> list[tuple[str, str]]:
    """Template -> [(kind, text)] with kind 'lit' or a placeholder name."""
    out = []
    for part in re.split(r"(\{c\}|\{s\}|\{k\}|\{id\}|\{r\}|\{m\})", t):
        if not part:
            continue
        if part in ("{c}", "{s}", "{k}", "{id}", "{r}", "{m}"):
            out.append(("ph", part[1:-1]))
        else:
            out.append(("lit", part))
    return out


def _render(t: str, values: dict[str, Column]) -> Column:
    pieces = [F.lit(x) if kind == "lit" else values[x] for kind, x in split_template(t)]
    return F.concat(*pieces)


def render_c_files(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, source, ...) -> (file_path, doc_id, text) with one C file per document."""
    d = F.col("doc_id")
    did = d.cast("string")

    def stmt(line: Column, i: Column) -> Column:
        c = F.replace(line, F.lit("*/"), F.lit("* /"))
        s = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        k = F.length(line).cast("string")
        t = F.pmod(d + i, F.lit(N_TEMPLATES))
        expr = None
        for n, tpl in enumerate(STATEMENTS):
            r = _render(tpl, {"c": c, "s": s, "k": k})
            expr = F.when(t == n, r) if expr is None else expr.when(t == n, r)
        return expr

    ret = F.element_at(F.array(*[F.lit(r) for r in RET_TYPES]), (F.pmod(d, F.lit(3)) + 1).cast("int"))
    vals = {"id": did, "r": ret, "m": F.pmod(d, F.lit(100)).cast("string")}
    body = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), stmt), "")
    forms = F.element_at(F.array(*[_render(t, vals) for t in FORMS]), (F.pmod(d, F.lit(len(FORMS))) + 1).cast("int"))
    text = F.concat(_render(FILE_HEAD, vals), body, _render(FILE_TAIL, vals), forms)
    dir_ = F.element_at(F.array(*[F.lit(x) for x in DIRS]), (F.pmod(d, F.lit(7)) + 1).cast("int"))
    ext = F.when(F.pmod(d, F.lit(11)) == 0, ".h").when(F.pmod(d, F.lit(11)) == 1, ".C").otherwise(".c")
    path = F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), dir_, F.lit("/doc_"), did, ext)
    return documents.select(path.alias("file_path"), d.alias("doc_id"), text.alias("text"))


def render_paths(documents: DataFrame) -> DataFrame:
    """Only the file paths of the rendered corpus (no text): a manifest for the path operators."""
    d = F.col("doc_id")
    dir_ = F.element_at(F.array(*[F.lit(x) for x in DIRS]), (F.pmod(d, F.lit(7)) + 1).cast("int"))
    ext = F.when(F.pmod(d, F.lit(11)) == 0, ".h").when(F.pmod(d, F.lit(11)) == 1, ".C").otherwise(".c")
    path = F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), dir_, F.lit("/doc_"), d.cast("string"), ext)
    return documents.select(path.alias("file_path"), d.alias("doc_id"))


def load_documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")


def corpus(spark, sf_dir: str) -> DataFrame:
    return render_c_files(load_documents(spark, sf_dir))
