"""Comments are found without a row for every token between them, at the places where the tokens have them."""

import random

from fimloom.operators import nodes
from fimloom.operators.tokens import comment_tokens, comments, tokenize

PARTS = ["/* a */", "// b\n", "// c \\\n d\n", "\"/* s */\"", "'\"'", "#if X /* p */ // q\n", "#define A \"//\" \\\n b /* e\n */\n", "x = a / b;", "a /= *p;", "/", "*", "\"open\n",
         "'u\n", "\\", "extern \"C\" {", "##", "é\U0001F600", " ", "\n", "/* open", "1.e+5", "}"]


def test_comments_stand_where_the_tokens_have_them(spark):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choices(PARTS, k=draw.randint(1, 12)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4, "id")
    expected = {tuple(r) for r in comments(tokenize(df, ["id"]), ["id"]).collect()}
    assert {tuple(r) for r in comments(comment_tokens(df, ["id"]), ["id"]).collect()} == expected and len(expected) > 3000


def test_code_between_comments_is_one_row(spark, monkeypatch):
    seen, own = [], nodes.comments
    monkeypatch.setattr(nodes, "comments", lambda tokens, keys: (seen.append(tokens), own(tokens, keys))[1])
    text = "int f(int a) { /* n */ return a + 1; " + "x = y + z; " * 50 + "} // e"
    df = spark.createDataFrame([("/p/a.c", 0, text)], "file_path string, func_index int, func_def string")
    assert nodes.nodes_comment(df).count() == 2
    assert seen[0].count() == 2
