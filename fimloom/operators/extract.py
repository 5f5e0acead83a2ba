"""Function extraction (one file -> many rows): X1 definitions, X2 names, X3 the function table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import py_slice
from .branches import branch_views
from .tokens import LARGE_TEXT, blocks, structure, thinned, tokenize, without_arguments, without_statements

#: Code points of a piece of a large file.
PIECE = 1 << 16


def by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The one shuffle of a per-file / per-function job: hash the whole rows on their key.

    Every later window / aggregate / join on (keys, ...) reuses this partitioning.  The partition count
    is the session's ``spark.sql.shuffle.partitions`` and is kept as is: the work per byte here
    (tokenizing, windows) is high, so AQE's size-based coalescing would starve the stage of tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def file_blocks(files: DataFrame, keys: list[str] = ("file_path",), text: str = "text") -> DataFrame:
    """Every block of whole files, as ``tokens.blocks`` has them (``files`` partitioned by ``keys``, see ``by_key``).

    Statements that hold no block make no token rows; lines and places are those of the text."""
    keys = list(keys)
    bare = files.withColumn(text, without_statements(text))
    return blocks(structure(tokenize(bare, keys, text), keys, skeleton=True, clamp=True), keys)


def function_spans(files: DataFrame, keys: list[str] = ("file_path",), text: str = "text") -> DataFrame:
    """X1 + X2: (keys, func_index, st, en, func_name) for every function definition, nested ones included, in the
    order of their starts.

    ``files`` must be partitioned by ``keys`` (see ``by_key``).  A file with unbalanced ``#if`` groups is read in
    several views; a function that comes out of more than one of them is one row."""
    keys = list(keys)
    by_view = [*keys, "view"]
    views = branch_views(files, keys, text).withColumn(text, without_arguments(thinned(F.col(text))))
    b = blocks(structure(tokenize(views, by_view, text), by_view, skeleton=True, clamp=True), by_view)
    f = b.filter(F.col("kind") == "function").groupBy(*keys, "fstart", "en").agg(F.min(F.struct("view", "name")).alias("_first"))
    w = Window.partitionBy(*keys).orderBy("fstart", "en")
    return f.select(
        *keys,
        (F.row_number().over(w) - 1).alias("func_index"),
        F.col("fstart").alias("st"),
        F.col("en"),
        F.col("_first.name").alias("func_name"),
    )


def function_table(files: DataFrame) -> DataFrame:
    """(file_path, func_index, func_name, func_def) from decoded files (file_path, text)."""
    files = by_key(files.select("file_path", "text"), ["file_path"])
    spans = function_spans(files, ["file_path"], "text")
    # both sides are hash-partitioned on file_path already: a merge join needs no exchange, and the
    # file texts are never broadcast whatever the size estimate says
    # a slice is counted off from the start of its string: a large file is held in pieces, so that its
    # many functions do not each walk the whole file
    text = F.col("text")
    pieces = F.when(F.length(text) > LARGE_TEXT, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), 0)).otherwise(F.array(text))
    j = spans.join(files.select("file_path", pieces.alias("pieces")).hint("merge"), "file_path")
    st, en = F.col("st"), F.col("en")
    first = F.when(F.size("pieces") == 1, F.lit(0)).otherwise(F.floor(st / PIECE))
    last = F.when(F.size("pieces") == 1, F.lit(0)).otherwise(F.floor((en - 1) / PIECE))
    part = F.when(F.size("pieces") == 1, F.get("pieces", F.lit(0))).otherwise(
        F.array_join(F.slice("pieces", (first + 1).cast("int"), (last - first + 1).cast("int")), ""))
    return j.select("file_path", "func_index", "func_name",
                    py_slice(part, st - first * PIECE, en - first * PIECE).alias("func_def"))
