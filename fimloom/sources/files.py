"""Discovery of source files: S1-S7 as Spark listing options and Column predicates.

On a real tree they run on the rows of a walk (``sources.tree``); the same predicates also run on any manifest
of path strings (a column), which is how the registered queries exercise them on paths derived from the driver
tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tree import open_store, read_files, walk_files

# Directories skipped by the collect step.
DEFAULT_SKIP_DIRS = ("grpcplugin", "resource", "webplugin", "verifysuite")


def path_components(path: Column) -> Column:
    return F.split(path, "/", -1)


def in_skipped_dir(path: Column, skip_dirs=DEFAULT_SKIP_DIRS) -> Column:
    """S3: any '/'-component (root prefix and file name included) equals a skipped name."""
    if not skip_dirs:
        return F.lit(False)
    return F.arrays_overlap(path_components(path), F.array(*[F.lit(d) for d in skip_dirs]))


def has_suffix(path: Column, suffixes=(".c",)) -> Column:
    """Case-sensitive suffix test."""
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | path.endswith(s)
    return cond


def regex_match(path: Column, rx: str) -> Column:
    """Python ``re.match``: anchored at the start only."""
    return path.rlike("^(?:" + rx + ")")


def should_skip(path: Column, include_rx: str | None = None, exclude_rx: str | None = None) -> Column:
    """Skip when an include pattern is given and does not match, or an exclude pattern matches."""
    cond = F.lit(False)
    if include_rx is not None:
        cond = cond | ~regex_match(path, include_rx)
    if exclude_rx is not None:
        cond = cond | regex_match(path, exclude_rx)
    return cond


def find_files_depth(paths: DataFrame, root: str, include_rx: str | None = None, exclude_rx: str | None = None,
                     depth: int | None = None, path_col: str = "file_path") -> DataFrame:
    """S6 on a manifest of file paths under ``root`` (one row per file).

    A path survives when every ancestor below ``root`` (directories too) and the file itself pass
    ``should_skip``; a rejected directory prunes its subtree.  With a finite ``depth`` the walk stops
    after ``depth`` levels and the directories reached at that level are returned (once each).
    ``depth=0`` returns the root itself."""
    root = root.rstrip("/")
    if depth == 0:
        return paths.limit(1).select(F.lit(root).alias("path"))
    p = F.col(path_col)
    rel = F.split(F.substring(p, len(root) + 2, 1 << 30), "/", -1)   # components below root
    n = F.size(rel)
    levels = n if depth is None else F.least(n, F.lit(depth))
    prefixes = F.transform(F.sequence(F.lit(1), levels),
                           lambda i: F.concat(F.lit(root + "/"), F.array_join(F.slice(rel, 1, i), "/")))
    keep = F.forall(prefixes, lambda x: ~should_skip(x, include_rx, exclude_rx))
    under = p.startswith(root + "/")
    out = paths.filter(under & keep).select(F.element_at(prefixes, -1).alias("path"))
    return out.distinct() if depth is not None else out


def normalize_path(path: Column) -> Column:
    """Os.path.normpath for '/'-separated paths, then '/' separators.

    Collapses repeated separators and '.', folds 'x/..' pairs; a leading '..' stays on relative paths
    and vanishes at the root, as in POSIX normpath (which keeps exactly two leading slashes).  Of a
    cluster's path (``scheme://authority/path``) only the path is folded; ``file:`` is dropped."""
    p = F.regexp_replace(path, r"^file:", "")
    store = F.regexp_extract(p, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", 0)
    rest = F.substring(p, F.length(store) + 1, F.length(p))
    absolute = rest.startswith("/") | (store != "")
    two = (store == "") & rest.startswith("//") & ~rest.startswith("///")
    parts = F.filter(F.split(rest, "/", -1), lambda x: (x != "") & (x != "."))

    def step(acc, x):
        pop = (x == "..") & (F.size(acc) > 0) & (F.element_at(acc, -1) != "..")
        drop_at_root = (x == "..") & (F.size(acc) == 0) & absolute
        return (F.when(pop, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .when(drop_at_root, acc)
                .otherwise(F.concat(acc, F.array(x))))

    folded = F.aggregate(parts, F.array().cast("array<string>"), step)
    body = F.array_join(folded, "/")
    lead = (F.when((store != "") & (body == ""), store).when(store != "", F.concat(store, F.lit("/")))
            .when(two, "//").when(absolute, "/").otherwise(""))
    out = F.concat(lead, body)
    return F.when(out == "", F.lit(".")).otherwise(out)


def local_path(path: Column) -> Column:
    """A listed file's path without the scheme of the local file system."""
    return F.regexp_replace(path, r"^file:(//)?", "")


def unskipped(files: DataFrame, encoded: Column, skip_dirs=DEFAULT_SKIP_DIRS) -> DataFrame:
    """S3 before any bytes are read: a test on the listing's ``_metadata.file_path`` prunes files.

    That column is URL-encoded (a space is ``%20``), so only skip names made of characters that
    encoding leaves alone take part; the exact test on the decoded path must follow."""
    plain = [d for d in skip_dirs or () if re.fullmatch(r"[A-Za-z0-9._~-]+", d)]
    return files.filter(~in_skipped_dir(encoded, plain)) if plain else files


def read_binary_tree(spark: SparkSession, directory: str, suffixes=(".c",), skip_dirs=DEFAULT_SKIP_DIRS,
                     store: Callable = open_store) -> DataFrame:
    """S1 / S2 / S3 on a real tree: (file_path, content) of every file, once, whatever its name.

    Listing and reading run in tasks (``sources.tree``).  The tests on suffix and directories run on the listing, before
    any bytes are read, and a skipped directory is not listed; empty files have no text and are left out."""
    skipped = in_skipped_dir(F.col("path"), skip_dirs)
    files = walk_files(spark, directory, skipped if skip_dirs else None, store)
    return read_files(files.filter(has_suffix(F.col("path"), suffixes) & (F.col("size") > 0)), store)
