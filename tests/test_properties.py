"""Property tests: body-line segmentation against its rule, token coverage, brace matching."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import files_df, funcs_df
from fimloom.operators import lines as L
from fimloom.operators.tokens import blocks, structure, tokenize

ALPHABET = st.sampled_from(list('ab {}"\\\n;x\t'))


def body_lines_rule(s: str):
    """The C6 rule, restated for the test: walk the body between the first '{' and the last '}';
    a newline ends a line unless inside a string; a backslash takes the next char literally; a quote
    toggles the string state.  Lines are stripped and kept when longer than one char; a line's start is
    the index after the newline that ended the previous line, and 0 for the first line."""
    lo = s.find("{") + 1
    hi = s.rfind("}")
    out, cur, start, in_str, i = [], [], 0, False, lo
    while i < hi:
        ch = s[i]
        if ch == "\\":
            cur.append(s[i:i + 2] if i + 1 < hi else ch)
            i += 2
            continue
        if ch == '"':
            in_str = not in_str
        if ch == "\n" and not in_str:
            out.append(("".join(cur).strip(), start))
            cur, start = [], i + 1
        else:
            cur.append(ch)
        i += 1
    if cur:
        out.append(("".join(cur).strip(), start))
    return [(ln, st_) for ln, st_ in out if len(ln) > 1]


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ALPHABET, min_size=0, max_size=40), min_size=1, max_size=8))
def test_body_lines_rule(spark, bodies):
    texts = ["f(" + str(i) + ") {" + b + "}" for i, b in enumerate(bodies)]
    rows = funcs_df(spark, texts).select("func_index", L.body_lines(F.col("func_def")).alias("b")).collect()
    for r in rows:
        t = texts[r.func_index]
        assert [(x.line, x.start) for x in r.b] == body_lines_rule(t), repr(t)


C_ALPHABET = st.sampled_from(list("ab1 (){}[];,+-*/%<>=!&|^~?:.#'\"\\\n\t") + ["/*", "*/", "//", "é", "\U0001F600"])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(C_ALPHABET, max_size=60).map("".join), min_size=1, max_size=6))
def test_tokens_cover_text(spark, texts):
    df = files_df(spark, [(f"/f{i}.c", t) for i, t in enumerate(texts)])
    toks = tokenize(df, ["file_path"], "text").collect()
    by = {}
    for r in toks:
        by.setdefault(r.file_path, []).append(r)
    for i, t in enumerate(texts):
        rows = sorted(by.get(f"/f{i}.c", []), key=lambda r: r.pos)
        assert all(t[r.st:r.en] == r.tok for r in rows)
        # tokens are disjoint, in order, and only blanks lie between them
        gaps, prev = [], 0
        for r in rows:
            assert r.st >= prev
            gaps.append(t[prev:r.st])
            prev = r.en
        gaps.append(t[prev:])
        assert all(ch in " \t\n\x0b\x0c\r" for g in gaps for ch in g)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.recursive(st.just(["x;"]), lambda kids: st.lists(kids, min_size=1, max_size=3).map(
    lambda ks: ["{"] + [t for k in ks for t in k] + ["}"]), max_leaves=12))
def test_brace_matching_against_stack(spark, toks):
    text = "void g(void) " + ("{" + " ".join(toks) + "}" if toks[0] != "{" else " ".join(toks))
    df = files_df(spark, [("/b.c", text)])
    got = sorted((r.st, r.en) for r in blocks(structure(tokenize(df, ["file_path"]), ["file_path"]), ["file_path"]).collect())
    stack, pairs = [], []
    for i, ch in enumerate(text):
        if ch == "{":
            stack.append(i)
        elif ch == "}":
            pairs.append((stack.pop(), i + 1))
    assert got == sorted(pairs)
