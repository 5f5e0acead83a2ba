"""Conditional compilation: views of a file in which every unbalanced ``#if`` group has one branch.

``#if A / int f(int a) { / #else / int f(void) { / #endif`` opens two braces that one ``}`` closes, so brace
depth means nothing after it.  A file with such a group is read in several views; each keeps one branch of
every unbalanced group and blanks the others with spaces, so places stay as they are.  A view is the
branches to take by level of nesting (the first, where it names none): one view takes first branches only, and there is
one for every other path of branches that leads to a branch, shared by groups side by side.  Groups whose every branch
is balanced keep all branches in every view, as do groups with one branch.  All other files have the one view
that is their text.

The text is cut into pieces, a conditional directive or what lies between two, and only files with an ``#else`` or
``#elif`` are; windows over these few rows stack the groups by level.  Everything is keyed by ``keys`` and
keeps the partitioning of ``by_key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What braces do not count in, and the rest of a directive line (with its comments and strings).
COMMENTS_AND_LITERALS = (r"/\*(?s:.*?)(?:\*/|\z)|//[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+"
                         r'|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?' r"|'[^'\\\n]*+(?:\\(?s:.)[^'\\\n]*+)*+'?")
DIRECTIVE_REST = (r'[^\n\\/"]*+(?:(?://[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?'
                  r'|\\(?s:.)|/)[^\n\\/"]*+)*+')
CONDITIONAL = r"#[ \t]*+(?:if|ifdef|ifndef|elif|elifdef|elifndef|else|endif)(?![A-Za-z0-9_])"
PIECE_RX = (f"{CONDITIONAL}{DIRECTIVE_REST}|(?:{COMMENTS_AND_LITERALS}|(?!{CONDITIONAL})#{DIRECTIVE_REST}"
            r"""|[^/"'#]++|[/"'])++""")
LINKAGE = r'extern[ \t\n\x0b\x0c\r]*+"C"[ \t\n\x0b\x0c\r]*+\{'
UNCOUNTED_RX = f"{LINKAGE}|{COMMENTS_AND_LITERALS}|#{DIRECTIVE_REST}"
ELSE_RX = r"#[ \t]*+el(?:se|if)"


def _net(piece: Column) -> Column:
    """Braces opened less braces closed."""
    code = F.regexp_replace(piece, UNCOUNTED_RX, "")
    return F.length(F.replace(code, F.lit("}"), F.lit(""))) - F.length(F.replace(code, F.lit("{"), F.lit("")))


def paths(directives: Column) -> Column:
    """The views of a file: the branches by level that lead to any branch but a first, and none (all first), from the
    directives of its unbalanced groups (a stack of branch numbers)."""
    def step(state: Column, d: Column) -> Column:
        stack = state["stack"]
        below = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))
        now = F.when(d["kind"] == "if", F.array_append(stack, F.lit(0))).when(d["kind"] == "el", F.array_append(below, d["_at"])).otherwise(below)
        return F.struct(now.alias("stack"), F.when(d["kind"] == "el", F.array_union(state["seen"], F.array(now))).otherwise(state["seen"]).alias("seen"))

    none = F.array().cast("array<int>")
    return F.aggregate(directives, F.struct(none.alias("stack"), F.array(none).alias("seen")), step, lambda state: state["seen"])


def dead_pieces(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, kind, net) per piece -> (keys, views): per view a flag for every piece, whether it is blanked.

    ``kind`` is if, el, endif or empty.  Files without an unbalanced group have no row."""
    seq = Window.partitionBy(*keys).orderBy("i")
    opens, closes = F.when(F.col("kind") == "if", 1).otherwise(0), F.when(F.col("kind") == "endif", 1).otherwise(0)
    p = pieces.withColumn("_level", F.sum(opens - closes).over(seq) + closes).withColumn("_sum", F.sum("net").over(seq))
    p = p.withColumn("_level", F.when(F.col("kind") != "", F.col("_level")))
    # directives of one level, in order: a group is an #if and what follows it up to its #endif
    same = Window.partitionBy(*keys, "_level").orderBy("i")
    p = p.withColumn("_group", F.sum(opens).over(same))
    branch = F.col("kind").isin("if", "el")
    p = p.withColumn("_net", F.when(branch, F.lead("_sum").over(same) - F.col("_sum")))
    group = Window.partitionBy(*keys, "_level", "_group")
    p = p.select("*", F.count(F.when(branch, 1)).over(group).alias("_n"),
                 (F.max(F.abs("_net")).over(group) > 0).alias("_odd"), (F.row_number().over(group.orderBy("i")) - 1).cast("int").alias("_at"))
    p = p.withColumn("_odd", F.col("_level").isNotNull() & (F.col("_group") > 0) & (F.col("_n") > 1) & F.coalesce("_odd", F.lit(False)))
    nested = F.when(F.col("_odd"), opens - closes).otherwise(0)
    p = p.withColumn("_depth", F.sum(nested).over(seq) + F.when(F.col("_odd"), closes).otherwise(0))
    rows = p.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "kind", "_level", "_group", "_odd", "_at", "_depth"))).alias("rows"))
    rows = rows.where(F.exists("rows", lambda r: r["_odd"]))
    views = rows.select(*keys, "rows", F.posexplode(paths(F.filter("rows", lambda r: r["_odd"]))).alias("view", "path"))
    p = views.select(*keys, "view", "path", F.inline("rows"))
    taken = F.coalesce(F.get("path", (F.col("_depth") - 1).cast("int")), F.lit(0))
    p = p.withColumn("_dead", F.when(F.col("_odd") & branch & (F.col("_at") != taken), 1).otherwise(0))
    # a directive ends what the one before it in its group began
    began = F.coalesce(F.lag("_dead").over(Window.partitionBy(*keys, "view", "_level", "_group").orderBy("i")), F.lit(0))
    p = p.withColumn("_step", F.when(F.col("_level").isNotNull(), F.col("_dead") - began).otherwise(0))
    p = p.withColumn("_blank", F.sum("_step").over(Window.partitionBy(*keys, "view").orderBy("i")))
    flags = F.sort_array(F.collect_list(F.struct("i", ((F.col("_blank") > 0) & (F.col("kind") == "")).alias("dead"))))
    views = p.groupBy(*keys, "view").agg(flags.alias("flags")).withColumn("flags", F.col("flags.dead"))
    return views.groupBy(*keys).agg(F.collect_list(F.struct("view", "flags")).alias("views"))


def branch_views(files: DataFrame, keys: list[str], text: str = "text", inside: bool = False) -> DataFrame:
    """(keys, view, text) from (keys, text): one row per view.  ``inside``: the text may begin inside a group, so that
    an ``#else`` without ``#if`` belongs to a group that it begins in."""
    start = F.array(F.lit("#if")) if inside else F.array().cast("array<string>")
    kind = F.regexp_extract("piece", r"^#[ \t]*(if|el|endif)", 1)
    pieces = files.filter(F.col(text).rlike(ELSE_RX)).select(*keys, F.concat(start, F.regexp_extract_all(text, F.lit(PIECE_RX), 0)).alias("_pieces"))
    pieces = pieces.select(*keys, (F.size("_pieces") - 1).alias("_last"), F.posexplode("_pieces").alias("i", "piece"))
    # no branch holds the first or the last piece (they stand before or after all directives): their braces cancel out
    net = F.when((F.col("i") > 0) & (F.col("i") < F.col("_last")), _net(F.col("piece"))).otherwise(0)
    pieces = pieces.select(*keys, "i", F.when(F.col("piece").rlike(f"^{CONDITIONAL}"), kind).otherwise("").alias("kind"), net.alias("net"))
    both = files.select(*keys, F.col(text).alias("_text")).join(dead_pieces(pieces, list(keys)).hint("merge"), list(keys), "left")
    alone = F.array(F.struct(F.lit(0).alias("view"), F.lit(None).cast("array<boolean>").alias("flags")))
    v = both.select(*keys, "_text", F.explode(F.coalesce("views", alone)).alias("_v"))
    flags = F.slice("_v.flags", 2, 1 << 30) if inside else F.col("_v.flags")
    kept = F.zip_with(F.regexp_extract_all("_text", F.lit(PIECE_RX), 0), flags, lambda p, dead: F.when(dead, F.repeat(F.lit(" "), F.length(p))).otherwise(p))
    return v.select(*keys, F.col("_v.view").alias("view"), F.when(F.col("_v.flags").isNull(), F.col("_text")).otherwise(F.array_join(kept, "")).alias(text))
