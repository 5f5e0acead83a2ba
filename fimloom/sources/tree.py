"""A directory tree as tables: a breadth-first walk whose directories are listed, and files read, in tasks.

The frontier of a level is a written table of directories.  Tasks list them (one row per entry), the rows are written,
and the directories among them that a predicate does not prune are the next frontier; pruned subtrees are never
listed.  Only the question whether a frontier is empty reaches the driver, once a level.  Every entry has one row,
whatever its name (Spark's own listing leaves out names that begin with ``_`` or ``.``).

Stores: local paths by the operating system; any other scheme through Hadoop's file system where its native client
is installed on the workers (``HADOOP_HOME`` or ``ARROW_LIBHDFS_DIR``), else by Arrow's client for the scheme.  A
function from a path to (Arrow file system, path inside it) may take their place.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, with_worker_path

ENTRIES = "path string, is_dir boolean, size bigint"
#: Entries of a directory in one Arrow batch.
BATCH = 4096
# Schemes of one store under other names.
SAME_STORE = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def open_store(uri: str):
    """(Arrow file system, path inside it) of a path with a scheme."""
    from pyarrow import fs
    scheme, rest = uri.split("://", 1)
    if os.environ.get("ARROW_LIBHDFS_DIR") or os.environ.get("HADOOP_HOME"):
        authority, _, path = rest.partition("/")
        return fs.HadoopFileSystem(f"{scheme}://{authority}", 0), "/" + path
    return fs.FileSystem.from_uri(f"{SAME_STORE.get(scheme, scheme)}://{rest}")


def _is_uri(path: str) -> bool:
    return re.match("[A-Za-z][A-Za-z0-9+.-]*://", path) is not None


def _entries(directory: str, store: Callable, follow_links: bool) -> Iterator[tuple[str, bool, int]]:
    """(path, is directory, size) of what is in a directory.  A link to a directory is no directory unless followed."""
    base = directory.rstrip("/")
    if not _is_uri(directory):
        with os.scandir(directory or "/") as found:
            for e in found:
                is_dir = e.is_dir(follow_symlinks=follow_links)
                if is_dir or e.is_file():
                    yield f"{base}/{e.name}", is_dir, 0 if is_dir else e.stat().st_size
        return
    from pyarrow import fs
    system, inside = store(directory)
    for info in system.get_file_info(fs.FileSelector(inside)):
        yield f"{base}/{info.base_name}", info.type == fs.FileType.Directory, info.size or 0


def _list(paths: DataFrame, store: Callable, follow_links: bool) -> DataFrame:
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        def batch(rows):
            p, d, s = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(p, pa.string()), pa.array(d, pa.bool_()), pa.array(s, pa.int64())], names=["path", "is_dir", "size"])

        rows = []
        for b in batches:
            for directory in b.column("path").to_pylist():
                for row in _entries(directory, store, follow_links):
                    rows.append(row)
                    if len(rows) == BATCH:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    with_worker_path(paths.sparkSession)
    return paths.select("path").mapInArrow(run, ENTRIES)


def plain_root(root: str) -> str:
    """A root as the walk names it: no ``file:`` and no separator at its end."""
    root = re.sub(r"^file:(//)?(?=/)", "", root)
    return root.rstrip("/") if not _is_uri(root) else re.sub(r"(?<=[^:/])/+$", "", root)


def walk_levels(spark: SparkSession, root: str, prune: Column | None = None, depth: int | None = None,
                store: Callable = open_store, follow_links: bool = False) -> list[DataFrame]:
    """One written table (path, is_dir, size) per level below ``root``; entries for which ``prune`` (over ``path``) holds
    are left out with all below them."""
    root = plain_root(root)
    frontier = spark.createDataFrame([(root,)], "path string")
    levels: list[DataFrame] = []
    while depth is None or len(levels) < depth:
        found = _list(frontier, store, follow_links)
        if prune is not None:
            found = found.filter(~prune)
        level = materialize(found, f"walk-{len(levels)}")
        levels.append(level)
        frontier = level.filter("is_dir").repartition(spark.sparkContext.defaultParallelism)
        if level.filter("is_dir").isEmpty():
            break
    return levels


def walk_files(spark: SparkSession, root: str, prune: Column | None = None, store: Callable = open_store) -> DataFrame:
    """Every file below ``root``, once: (path, size).  Links to directories are not followed."""
    levels = walk_levels(spark, root, prune, None, store)
    return reduce(DataFrame.unionByName, levels).filter("NOT is_dir").select("path", "size")


def find_paths(spark: SparkSession, root: str, skip: Column | None = None, depth: int | None = None, store: Callable = open_store) -> DataFrame:
    """S6 on a real tree: files above the depth limit, and what the walk reached at the limit, directories (empty ones
    too) among it; without a limit all files and no directory, but those that are empty when the walk ends at their level.

    An entry that ``skip`` rejects prunes what is below it; the root itself is not tested, and is the result at depth 0."""
    if depth is not None and depth <= 0:
        return spark.createDataFrame([(plain_root(root),)], "path string")
    levels = walk_levels(spark, root, skip, depth, store, follow_links=True)
    out = [x.filter("NOT is_dir").select("path") for x in levels]
    if depth is not None and len(levels) == depth:
        out[-1] = levels[-1].select("path")
    return reduce(DataFrame.unionByName, out)


def read_files(files: DataFrame, store: Callable = open_store) -> DataFrame:
    """(path, size) -> (file_path, content): bytes read in tasks, one file at a time; tasks get files of all sizes."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for path in b.column("path").to_pylist():
                if _is_uri(path):
                    system, inside = store(path)
                    with system.open_input_stream(inside) as f:
                        content = f.read()
                else:
                    with open(path, "rb") as f:
                        content = f.read()
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.large_binary() if len(content) >= 1 << 31 else pa.binary())],
                                                 names=["file_path", "content"])

    with_worker_path(files.sparkSession)
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.select("path").mapInArrow(run, "file_path string, content binary")
