"""String scalar helpers (Column expressions, JVM side).

Offsets are 0-based code points, as in Python slicing; Spark's ``substring``/``locate``/``length``
count code points too.  ``py_slice(s, i, j)`` is ``s[i:j]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line breaks of Python's str.splitlines() and the whitespace of str.strip().
LINE_BREAK_RX = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
PY_SPACE_CLASS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP_RX = "^" + PY_SPACE_CLASS + "+|" + PY_SPACE_CLASS + r"+\z"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or(c: int | Column) -> Column:
    return F.lit(c) if isinstance(c, int) else c


def py_slice(s: Column, i: int | Column | None = None, j: int | Column | None = None) -> Column:
    """s[i:j] for 0 <= i, j <= len(s)."""
    if i is None:
        i = 0
    i = lit_or(i)
    if j is None:
        return s.substr(i + 1, F.length(s) + 1)
    return F.when(lit_or(j) > i, s.substr(i + 1, lit_or(j) - i)).otherwise(F.lit(""))


def cut(s: Column, i: Column, j: Column) -> tuple[Column, Column, Column]:
    """(s[:i], s[i:j], s[j:])."""
    return py_slice(s, 0, i), py_slice(s, i, j), py_slice(s, j)


def cut_inner(s: Column, i: Column, j: Column) -> tuple[Column, Column, Column]:
    """Skip the opening brace and the blank after it; end just before the last char (the closing
    brace), so trailing blank stays in the middle.  An empty block falls back to C1 (the reference
    aborts the run there)."""
    i1 = skip_blank_forward(s, i + 1)
    ok = i1 < j - 1
    a = F.when(ok, i1).otherwise(i)
    b = F.when(ok, j - 1).otherwise(j)
    return cut(s, a, b)


def cut_half(s: Column, i: Column, j: Column) -> tuple[Column, Column, Column]:
    """Skip the opening brace and the blank after it; end unchanged (C1 when nothing is left)."""
    i1 = skip_blank_forward(s, i + 1)
    a = F.when(i1 < j, i1).otherwise(i)
    return cut(s, a, j)


def rfind(s: Column, ch: str) -> Column:
    """Python s.rfind(ch) for a one-character ch (-1 when absent)."""
    return F.when(F.instr(s, ch) > 0, F.length(s) - F.instr(F.reverse(s), ch)).otherwise(F.lit(-1))


def skip_blank_forward(s: Column, i: Column) -> Column:
    """First index >= i whose char is not space, tab or newline."""
    return i + F.length(F.regexp_extract(py_slice(s, i), r"^[ \t\n]*", 0))


def splitlines(c: str | Column) -> Column:
    """Python str.splitlines(): no trailing empty item."""
    arr = F.split(col(c), LINE_BREAK_RX, -1)
    return F.when(F.element_at(arr, -1) == "", F.slice(arr, 1, F.size(arr) - 1)).otherwise(arr)


def line_count(c: str | Column) -> Column:
    return F.size(splitlines(c))


def py_strip(c: str | Column) -> Column:
    return F.regexp_replace(col(c), STRIP_RX, "")


def leading_indent(c: str | Column) -> Column:
    """Leading run of spaces and tabs."""
    return F.regexp_extract(col(c), r"^[ \t]*", 0)


def nonblank_lines(c: str | Column) -> Column:
    """Lines that hold a non-whitespace character."""
    return F.filter(splitlines(c), lambda l: py_strip(l) != "")
