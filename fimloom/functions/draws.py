"""Reproducible random draws as Column expressions.

A draw is a hash of (seed, row key, salt[, extra]) so its value does not depend on partitioning,
task retries or input order.  The same expression exists in DuckDB (see ``fimloom.oracle``):
``('0x' || substr(md5(concat_ws('|', seed, key, salt)), 1, 15))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42

# Fixed salts, one per independent decision.
SALTS = (
    "sample", "short", "strategy", "line", "chars", "node", "node2", "start", "n",
    "trim", "longn", "nl", "try0", "try1", "try2",
)


def fkey(file_path: str | Column = "file_path", func_index: str | Column = "func_index",
         func_def: str | Column | None = None) -> Column:
    """Row key of a function: ``file_path#func_index``.

    With ``func_def``, a row without an index (the reference's own format has none) takes the hash of
    its text instead."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    index = col(func_index).cast("string")
    if func_def is not None:
        index = F.coalesce(index, F.md5(F.encode(col(func_def), "UTF-8")))
    return F.concat_ws("#", col(file_path), index)


def draw(key: Column, salt: str, seed: int = DEFAULT_SEED, extra: Column | None = None) -> Column:
    """Non-negative 60-bit integer derived from md5(seed|key|salt[|extra])."""
    parts = [F.lit(str(seed)), key, F.lit(salt)]
    if extra is not None:
        parts.append(extra.cast("string"))
    h = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def randint(key: Column, salt: str, lo: Column | int, hi: Column | int, seed: int = DEFAULT_SEED) -> Column:
    """Inclusive integer in [lo, hi]; lo when hi < lo (no division by zero)."""
    lo_c = F.lit(lo) if isinstance(lo, int) else lo
    hi_c = F.lit(hi) if isinstance(hi, int) else hi
    return lo_c + F.pmod(draw(key, salt, seed), F.greatest(hi_c - lo_c + 1, F.lit(1)))


def bernoulli(key: Column, salt: str, tenths: int, seed: int = DEFAULT_SEED) -> Column:
    """True with probability tenths/10."""
    return F.pmod(draw(key, salt, seed), F.lit(10)) < tenths


def choice_index(key: Column, salt: str, n: Column, seed: int = DEFAULT_SEED) -> Column:
    """0-based uniform index among n (> 0) items."""
    return F.pmod(draw(key, salt, seed), F.greatest(n, F.lit(1)))
