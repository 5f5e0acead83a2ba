"""FIM strategies T1-T10 and the weighted mixture (M2, M3), as one DataFrame plan.

Plan shape:

    funcs --draw strategy--> F
    F[row-local strategies] --> one projection, no shuffle
    F[needs syntax] --by_key shuffle (mixture: a table bucketed by key, partitioned by strategy)--> S
    S --> one row per content --tokenize/structure/blocks--> candidate rows
    candidates --groupBy key: min(struct(hash, ...))--> picks        (uniform choice, map-side combined)
    (the if re-pick uses a window over the same candidate rows; no second pass)
    S --left join picks--> one projection computes (prefix, middle, suffix, flag)

Syntax work is keyed by content (a 128-bit hash of path, index and text), so functions that share a
path and index never mix; equal rows share the work and each keeps its row.

A uniform pick among a function's candidates is the candidate with the smallest hash
``draw(key, salt, "st:en")``: no counting, ordering or collecting of the group is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize_bucketed
from ..functions.draws import DEFAULT_SEED, bernoulli, draw, fkey, randint
from ..functions.text import leading_indent, line_count, py_slice, skip_blank_forward, splitlines
from . import lines as L
from .items import binary_expressions, expression_statements
from .tokens import blocks, comment_tokens, comments, structure, tokenize, without_statements

KEYS = ["ck", "key"]           # content key and draw key

# Mixture weights in twentieths (single_line .25, expression .20, binary .05,
# comment .10, if .10, loop .15, switch .05, empty .10), and the short-function gate.
MIXTURE = [("single_line", 5), ("expression", 4), ("binary", 1), ("comment", 2), ("if", 2), ("loop", 3),
           ("switch", 1), ("empty", 2)]
SHORT_MAX_LINES = 20
SHORT_TENTHS = 1
BLOCK_LONG_LINES = 20
IF_NEST_LINES = 5
LOOP_TRIES = 3

LOCAL = ("single_line", "empty", "multi_line")      # cut without syntax
STRATEGIES = ("short", "single_line", "expression", "binary", "comment", "if", "loop", "switch", "empty")
NEEDS_SYNTAX = {"short": "body", "expression": "expr", "binary": "binary", "comment": "comment",
                "if": "ifelse", "loop": "loop", "switch": "case"}

FLAGS = {
    "single_line": "RANDOM_SINGLE_LINE", "expression": "EXPRESSION_STATEMENT", "binary": "BINARY_EXPRESSION",
    "useless": "USELESS", "multi_line": "RANDOM_MULTI_LINE", "empty": "EMPTY", "short": "SHORT_FUNCTION",
    "comment": "COMMENT_BLOCK", "if": "IF_BLOCK", "switch": "SWITCH_CASE", "loop": "LOOP_BLOCK",
}
LONG_FLAGS = {"if": "IF_BLOCK_LONG", "switch": "SWITCH_CASE_LONG", "loop": "LOOP_BLOCK_LONG"}


def drawn_strategy(key: Column, n_lines: Column, seed: int = DEFAULT_SEED) -> Column:
    """M2 + M3: short-function gate, else one of eight by weight."""
    d = F.pmod(draw(key, "strategy", seed), F.lit(20))
    acc, expr = 0, None
    for name, w in MIXTURE:
        acc += w
        expr = F.when(d < acc, name) if expr is None else expr.when(d < acc, name)
    gate = (n_lines <= SHORT_MAX_LINES) & bernoulli(key, "short", SHORT_TENTHS, seed)
    return F.when(gate, F.lit("short")).otherwise(expr)


def with_strategy(funcs: DataFrame, seed: int = DEFAULT_SEED, strategy: str | None = None) -> DataFrame:
    """(file_path, func_index, func_name, func_def) + key, n_lines, strategy."""
    f = funcs.withColumn("key", fkey(func_def="func_def")).withColumn("n_lines", line_count("func_def"))
    s = F.lit(strategy) if strategy else drawn_strategy(F.col("key"), F.col("n_lines"), seed)
    return f.withColumn("strategy", s)


def candidates(f: DataFrame) -> DataFrame:
    """Candidate spans of the type each function's strategy asks for: (KEYS, strategy, ctype, st, en, n_lines).

    ``f`` must be partitioned by KEYS and carry ``strategy``.  Token rows carry only the key columns
    and the (short) strategy; the draw key string is rebuilt after aggregation."""
    keys = KEYS + ["strategy"]
    f = f.filter(F.col("strategy").isin(*NEEDS_SYNTAX)).select(*keys, "func_def").dropDuplicates(keys)
    strat = F.col("strategy")
    of_blocks = strat.isin("short", "if", "loop", "switch")
    f = f.withColumn("func_def", F.when(of_blocks, without_statements("func_def")).otherwise(F.col("func_def")))
    notes = comments(comment_tokens(f.filter(strat == "comment"), keys, "func_def"), keys).select(
        *keys, F.lit("comment").alias("ctype"), "st", "en", F.lit(None).cast("long").alias("n_lines"))
    blk = blocks(structure(tokenize(f.filter(of_blocks), keys, "func_def"), keys, skeleton=True), keys)
    kind = F.col("kind")
    ctype = (
        F.when((strat == "short") & (kind == "function") & (F.col("depth") == 0), "body")
        .when((strat == "if") & ((kind == "if") | ((kind == "else") & (F.col("prev2_tok") == "}"))), "ifelse")
        .when((strat == "switch") & (kind == "case"), "case")
        .when((strat == "loop") & kind.isin("for", "while", "macro", "bare"), "loop")
    )
    blk = blk.select(*keys, ctype.alias("ctype"), "st", "en", "n_lines").filter(F.col("ctype").isNotNull())
    ex = expression_statements(f.filter(strat == "expression"), keys, "func_def").select(
        *keys, F.lit("expr").alias("ctype"), "st", "en", F.lit(None).cast("long").alias("n_lines"))
    bi = binary_expressions(f.filter(strat == "binary"), keys, "func_def").select(
        *keys, F.lit("binary").alias("ctype"), "st", "en", F.lit(None).cast("long").alias("n_lines"))
    return notes.unionByName(blk).unionByName(ex).unionByName(bi)


def _pick(h: Column) -> Column:
    return F.min(F.when(h.isNotNull(), F.struct(h.alias("h"), "st", "en", "n_lines")))


def picks(cands: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Per function: candidate count, one uniform pick, two more loop tries, and the if re-pick.

    The first pick is also spread to every candidate row by a window over the function key, so the
    re-pick among if/else blocks nested inside it (when it spans more than 5 lines) happens in the same
    aggregation: the candidate table is computed once, with no join."""
    key, st, en, strat = F.col("key"), F.col("st"), F.col("en"), F.col("strategy")
    span = F.concat_ws(":", st.cast("string"), en.cast("string"))   # unique per candidate
    h0 = F.when(F.col("ctype") == "body", st).otherwise(draw(key, "node", seed, span))
    h1 = F.when(strat == "loop", draw(key, "try1", seed, span))
    h2 = F.when(strat == "loop", draw(key, "try2", seed, span))
    c = cands.withColumn("_p0", _pick(h0).over(Window.partitionBy(*KEYS)))
    inside = ((F.col("ctype") == "ifelse") & (F.col("_p0.n_lines") > IF_NEST_LINES)
              & (st > F.col("_p0.st")) & (en < F.col("_p0.en")))
    hn = F.when(inside, draw(key, "node2", seed, span))
    return c.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_c"), F.first("_p0").alias("p0"), _pick(h1).alias("p1"), _pick(h2).alias("p2"),
        _pick(hn).alias("pn"))


def _block_choice(strat: Column) -> Column:
    p0, p1, p2, n = F.col("p0"), F.col("p1"), F.col("p2"), F.col("n_c")
    fits = lambda p: p["n_lines"] <= BLOCK_LONG_LINES
    tries = F.least(F.lit(LOOP_TRIES), n)
    loop = (F.when(fits(p0), p0)
            .when((tries >= 2) & fits(p1), p1)
            .when((tries >= 3) & fits(p2), p2)
            .when(tries >= 3, p2).when(tries == 2, p1).otherwise(p0))
    if_ = F.when(p0["n_lines"] <= IF_NEST_LINES, p0).otherwise(F.coalesce(F.col("pn"), p0))
    return F.when(strat == "if", if_).when(strat == "loop", loop).otherwise(p0)


def with_picks(f: DataFrame, pk: DataFrame | None) -> DataFrame:
    """``f`` with the picks of its functions (null columns for strategies that need none)."""
    if pk is None:
        pick = F.lit(None).cast("struct<h:bigint,st:bigint,en:bigint,n_lines:bigint>")
        return f.withColumns({"n_c": F.lit(None).cast("bigint"), **{p: pick for p in ("p0", "p1", "p2", "pn")}})
    # both sides are partitioned by KEYS: a merge join needs no exchange, and the picks table (one row
    # per function, growing with the data) is never broadcast on a size estimate
    return f.join(pk.hint("merge"), KEYS, "left")


def assemble(j: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Cut every function (with its picks): (file_path, func_index, func_name, prefix, middle, suffix, flag).

    Expensive intermediates (body lines, non-blank lines, block lines) are staged columns computed only
    for the rows whose effective strategy needs them."""
    s, key, strat = F.col("func_def"), F.col("key"), F.col("strategy")
    has_c = F.coalesce(F.col("n_c"), F.lit(0)) > 0
    need_lp = strat.isin("single_line", "empty") | (strat.isin("expression", "binary") & ~has_c)
    need_ml = (strat == "multi_line") | (strat.isin("comment", "if", "loop", "switch") & ~has_c)
    j = L.with_line_pick(j, "func_def", "key", seed, need=need_lp, out="lp")
    j = j.withColumn("nbl", F.when(need_ml, L.nonblank_lines(s)))
    j = j.withColumn("blk", _block_choice(strat))
    ml_ok = F.size(F.col("nbl")) >= 5
    to_ml = F.when(ml_ok, "multi_line").otherwise("useless")
    to_sl = F.when(F.col("lp").isNotNull(), "single_line").otherwise("useless")
    eff = (
        F.when(strat.isin("expression", "binary"), F.when(has_c, strat).otherwise(to_sl))
        .when(strat.isin("comment", "if", "loop", "switch"), F.when(has_c, strat).otherwise(to_ml))
        .when(strat == "short", F.when(has_c, strat).otherwise("useless"))
        .when(strat.isin("single_line", "empty"), F.when(F.col("lp").isNotNull(), strat).otherwise("useless"))
        .when(strat == "multi_line", to_ml)
        .otherwise(strat)
    )
    j = j.withColumn("eff", eff)
    e = F.col("eff")
    blk = F.col("blk")
    b_st, b_en = blk["st"], blk["en"]
    is_blk = e.isin("if", "loop", "switch")
    j = j.withColumn("long_", is_blk & (blk["n_lines"] > BLOCK_LONG_LINES))
    long_ = F.col("long_")
    coin = bernoulli(key, "trim", 5, seed)
    # long block: the first n in 3..10 lines of the block
    n = randint(key, "longn", F.lit(3), F.lit(10), seed)
    part_end = b_st + F.length(F.array_join(F.slice(splitlines(py_slice(s, b_st, b_en)), 1, n), "\n"))
    j = j.withColumn("part_end", F.when(long_, part_end))
    j = j.withColumn("inner0", F.when(is_blk, skip_blank_forward(s, b_st + 1)))
    j = j.withColumn("coin", coin)
    inner0, part_end, coin = F.col("inner0"), F.col("part_end"), F.col("coin")
    # (i1, i2) of the three-way cut
    c2_ok = inner0 < b_en - 1
    c3_ok = inner0 < part_end
    blk_i1 = F.when(long_, F.when(~coin & c3_ok, inner0).otherwise(b_st)) \
        .otherwise(F.when(coin & c2_ok, inner0).otherwise(b_st))
    blk_i2 = F.when(long_, part_end).otherwise(F.when(coin & c2_ok, b_en - 1).otherwise(b_en))
    lp = F.col("lp")
    i1 = (F.when(e == "single_line", lp["snip"])
          .when(e.isin("expression", "binary", "short"), F.col("p0.st"))
          .when(is_blk, blk_i1))
    i2 = (F.when(e == "single_line", lp["line_end"])
          .when(e.isin("expression", "binary", "short"), F.col("p0.en"))
          .when(is_blk, blk_i2))
    j = j.withColumn("i1", i1).withColumn("i2", i2)
    i1, i2 = F.col("i1"), F.col("i2")
    # T4
    ml_p, ml_m, ml_s, _ = L.multi_line(F.col("nbl"), key, seed)
    # T10
    em_p, em_m, em_s = L.empty_completion(s, lp, key, seed)
    # T5
    c_en = F.col("p0.en")
    j = j.withColumn("rl", F.when(e == "comment", splitlines(py_slice(s, c_en + 1))))
    rl = F.col("rl")
    pos = F.array_position(rl, "")
    j = j.withColumn("bi", F.when(pos > 0, pos - 1).otherwise(F.lit(0)).cast("int"))
    bi = F.col("bi")
    j = j.withColumn("cm_mid0", F.array_join(F.slice(rl, 1, bi), "\n"))
    cm_mid0 = F.col("cm_mid0")
    cm_s = F.concat(F.lit("\n"), F.array_join(F.slice(rl, bi + 1, F.greatest(F.size(rl), F.lit(1))), "\n"))
    j = j.withColumn("off", F.length(leading_indent(cm_mid0)))
    off = F.col("off")
    cm_p = F.concat(py_slice(s, 0, c_en), F.lit("\n"), py_slice(cm_mid0, 0, off))
    cm_m = py_slice(cm_mid0, off)

    def pick3(cut, ml, em, cm, useless):
        return (F.when(e == "multi_line", ml).when(e == "empty", em).when(e == "comment", cm)
                .when(e == "useless", useless).otherwise(cut))

    prefix = pick3(py_slice(s, 0, i1), ml_p, em_p, cm_p, F.lit(""))
    middle = pick3(py_slice(s, i1, i2), ml_m, em_m, cm_m, F.lit(""))
    suffix = pick3(F.when(e == "short", F.lit("")).otherwise(py_slice(s, i2)), ml_s, em_s, cm_s, F.lit(""))
    flag = F.lit(None).cast("string")
    for k, v in FLAGS.items():
        fl = F.when(long_, LONG_FLAGS[k]).otherwise(v) if k in LONG_FLAGS else F.lit(v)
        flag = F.when(e == k, fl).otherwise(flag)
    return j.select("file_path", "func_index", "func_name", prefix.alias("prefix"), middle.alias("middle"),
                    suffix.alias("suffix"), flag.alias("flag"), F.col("strategy"))


def fim(funcs: DataFrame, seed: int = DEFAULT_SEED, strategy: str | None = None, stage: bool = True) -> DataFrame:
    """M4 core: function rows -> FIM rows (plus the drawn ``strategy`` column, for tests)."""
    from .extract import by_key
    drawn = with_strategy(funcs, seed, strategy)
    if strategy in LOCAL:
        return assemble(with_picks(drawn, None), seed)
    syntax = drawn.filter(F.col("strategy").isin(*NEEDS_SYNTAX)).withColumn("ck", F.unhex(F.md5(F.encode(
        F.concat_ws("\x00", "file_path", F.col("func_index").cast("string"), "func_def"), "UTF-8"))))
    if strategy is None and stage:
        # each branch of the mixture reads only its own strategies' functions: a pruned scan of a table that is
        # bucketed by content, so a text is shuffled once, for the write, and by no branch and no join
        f = materialize_bucketed(syntax, "syntax", KEYS, partition_by="strategy")
    else:
        f = by_key(syntax, KEYS)
    picked = with_picks(f, picks(candidates(f), seed)).drop("ck")
    if strategy is None:
        picked = picked.unionByName(with_picks(drawn.filter(F.col("strategy").isin(*LOCAL)), None))
    return assemble(picked, seed)
