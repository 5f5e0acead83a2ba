"""Line-based operators (no syntax needed): C6 body lines, C7 line pick, T1, T4, T10.

All of them are row-local Column expressions over the function text ``s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.draws import choice_index, randint, bernoulli
from ..functions.text import leading_indent, nonblank_lines, py_slice, py_strip

# Body-line segmentation.  A segment is either one newline or a maximal run of line
# content; inside "..." a newline does not end the line, and a backslash makes the next char literal.
BODY_LINE_RX = r'(?s)(?:[^"\\\n]++|\\.|\\\z|"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z))++|\n'


def body_start(s: Column) -> Column:
    """Index after the first '{' (0 when there is none)."""
    return F.instr(s, "{")


def body_end(s: Column) -> Column:
    """Index of the last '}' (-1 when there is none)."""
    return F.when(F.instr(s, "}") > 0, F.length(s) - F.instr(F.reverse(s), "}")).otherwise(F.lit(-1))


def body_segments(s: Column) -> Column:
    b0, b1 = body_start(s), body_end(s)
    body = F.when(b1 > b0, py_slice(s, b0, b1)).otherwise(F.lit(""))
    return F.regexp_extract_all(body, F.lit(BODY_LINE_RX), 0)


def body_lines(s: Column) -> Column:
    """array<struct<line, start>> of stripped body lines longer than one char.

    The first line's start is 0 (not the body start), as in the reference."""
    segs = body_segments(s)
    b0 = body_start(s)
    items = F.transform(segs, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    elig = F.filter(items, lambda e: (e["x"] != "\n") & (F.length(py_strip(e["x"])) > 1))

    def start_of(i):
        before = F.aggregate(F.slice(segs, 1, i), F.lit(0), lambda a, x: a + F.length(x))
        return F.when(i == 0, F.lit(0)).otherwise(b0 + before)

    return F.transform(elig, lambda e: F.struct(py_strip(e["x"]).alias("line"), start_of(e["i"]).alias("start")))


def eligible_lines(segs: Column) -> Column:
    """Content segments whose stripped text is longer than one char, with their segment index."""
    items = F.transform(segs, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.filter(items, lambda e: (e["x"] != "\n") & (F.length(py_strip(e["x"])) > 1))


def with_line_pick(df, s: str, key: str, seed: int, need: Column | None = None, out: str = "lp"):
    """C7 as staged columns: adds ``out`` = struct(p, snip, line_end) for a uniformly drawn eligible body
    line (null when there is none, or when ``need`` is false).

    ``p`` is where the stripped line is found from its start; ``snip = p + k - 1`` with k in 1..len.
    Each stage is its own column, referenced more than once downstream, so Catalyst keeps them apart
    and every expensive step runs once per row."""
    sc, kc = F.col(s), F.col(key)
    segs = body_segments(sc)
    df = df.withColumn("_segs", segs if need is None else F.when(need, segs))
    df = df.withColumn("_elig", eligible_lines(F.col("_segs")))
    n = F.coalesce(F.size(F.col("_elig")), F.lit(0))
    df = df.withColumn("_ch", F.when(n > 0, F.get(F.col("_elig"), choice_index(kc, "line", F.greatest(n, F.lit(1)), seed))))
    ch = F.col("_ch")
    m = ch["i"]
    start = F.when(m == 0, F.lit(0)).otherwise(
        body_start(sc) + F.aggregate(F.slice(F.col("_segs"), 1, m), F.lit(0), lambda a, x: a + F.length(x)))
    df = df.withColumn("_line", py_strip(ch["x"])).withColumn("_lstart", start)
    line = F.col("_line")
    p = F.call_function("locate", line, sc, F.col("_lstart") + 1) - 1
    df = df.withColumn("_p", p)
    ln = F.length(line)
    k = randint(kc, "chars", F.lit(1), ln, seed)
    lp = F.when(ch.isNotNull(), F.struct(F.col("_p").alias("p"), (F.col("_p") + k - 1).alias("snip"),
                                         (F.col("_p") + ln).alias("line_end")))
    return df.withColumn(out, lp).drop("_segs", "_elig", "_ch", "_line", "_lstart", "_p")


def single_line(s: Column, pick: Column) -> tuple[Column, Column, Column]:
    """The tail of one line is the middle."""
    snip, end = pick["snip"], pick["line_end"]
    return py_slice(s, 0, snip), py_slice(s, snip, end), py_slice(s, end)


def empty_completion(s: Column, pick: Column, key: Column, seed: int) -> tuple[Column, Column, Column]:
    """Cut at a line end; with p=0.7 the prefix gets a newline plus that line's indent."""
    end = pick["line_end"]
    pre = py_slice(s, 0, end)
    indent = leading_indent(F.substring_index(pre, "\n", -1))
    prefix = F.when(bernoulli(key, "nl", 7, seed), F.concat(pre, F.lit("\n"), indent)).otherwise(pre)
    return prefix, F.lit(""), py_slice(s, end)


def multi_line(lines: Column, key: Column, seed: int) -> tuple[Column, Column, Column, Column]:
    """T4 over the non-blank lines (C9) of a function: 2..6 whole lines; fewer than 5 -> USELESS.

    Returns (prefix, middle, suffix, ok)."""
    n_l = F.size(lines)
    start = randint(key, "start", F.lit(1), n_l - 3, seed)
    n = randint(key, "n", F.lit(2), F.least(F.lit(6), n_l - start), seed)
    end = start + n - 1
    first = F.get(lines, start)
    ind = leading_indent(first)
    prefix = F.concat(F.array_join(F.slice(lines, 1, start), "\n"), F.lit("\n"), ind)
    middle = F.concat(py_slice(first, F.length(ind)), F.lit("\n"),
                      F.array_join(F.slice(lines, start + 2, F.greatest(n - 1, F.lit(0))), "\n"))
    suffix = F.concat(F.lit("\n"), F.array_join(F.slice(lines, end + 2, F.greatest(n_l, F.lit(1))), "\n"))
    return prefix, middle, suffix, n_l >= 5
