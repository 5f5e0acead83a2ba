"""The walk of a real tree: every entry once, in tasks, on any store."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fimloom.plans.collect import collect_functions
from fimloom.sources import files as S
from fimloom.sources import tree as W
from test_sources import tree, walk  # noqa: F401


def fake_store():
    """``mem://bucket/..`` is a local folder, for a store that neither Spark nor Arrow knows."""
    def store(uri):
        from pyarrow import fs
        bucket, _, inside = uri.removeprefix("mem://").partition("/")
        return fs.SubTreeFileSystem(bucket.replace("%2F", "/"), fs.LocalFileSystem()), inside
    return store


def test_every_file_once(spark, tree):  # noqa: F811
    got = sorted(r.path for r in W.walk_files(spark, tree).collect())
    assert got == sorted(os.path.join(d, f) for d, _, fs in os.walk(tree) for f in fs) and len(got) == len(set(got))
    assert sorted(r.path for r in W.walk_files(spark, f"file://{tree}/").collect()) == got


@pytest.mark.parametrize("depth", [0, 1, 2, 3, None])
def test_paths_equal_a_walker(spark, tree, depth):  # noqa: F811
    os.makedirs(f"{tree}/hollow/deeper", exist_ok=True)
    exclude = r".*/(?:resource|webplugin)$"
    got = [r.path for r in W.find_paths(spark, tree, S.should_skip(F.col("path"), None, exclude), depth).collect()]
    want = [tree] if depth == 0 else walk(tree, None, exclude, depth)
    assert sorted(got) == want
    if depth == 2:
        assert f"{tree}/hollow/deeper" in got               # an empty directory at the limit


def test_pruned_subtrees_are_not_listed(spark, tree):  # noqa: F811
    root = tempfile.mkdtemp(prefix="fimloom-prune-")
    os.makedirs(f"{root}/a/resource")
    open(f"{root}/a/x.c", "w").write("int f(void) { }")
    os.symlink("/nowhere/at/all", f"{root}/a/dangling.c")
    os.symlink(tree, f"{root}/a/resource/loop")
    os.symlink(root, f"{root}/a/loop")                      # a link to a directory above is not followed
    levels = W.walk_levels(spark, root, S.in_skipped_dir(F.col("path")))
    assert sorted(r.path for x in levels for r in x.collect() if not r.is_dir) == [f"{root}/a/x.c"]


def test_a_store_of_an_unknown_scheme(spark, tree):  # noqa: F811
    bucket = f"mem://{tree.replace('/', '%2F')}"
    got = {r.file_path: bytes(r.content) for r in S.read_binary_tree(spark, bucket, store=fake_store()).collect()}
    want = {bucket + r.file_path[len(tree):]: bytes(r.content) for r in S.read_binary_tree(spark, tree).collect()}
    assert got == want and len(got) > 10


def test_arrow_knows_the_other_schemes(monkeypatch):
    from pyarrow import fs
    seen = []
    monkeypatch.delenv("HADOOP_HOME", raising=False)
    monkeypatch.delenv("ARROW_LIBHDFS_DIR", raising=False)

    class Stub:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return None, uri
    monkeypatch.setattr(fs, "FileSystem", Stub)
    for uri in ("s3a://b/x y/_k=v.c", "s3://b/c", "wasbs://c@a/x", "gs://b/d", "hdfs://nn:8020/x"):
        W.open_store(uri)
    assert seen == ["s3://b/x y/_k=v.c", "s3://b/c", "abfss://c@a/x", "gs://b/d", "hdfs://nn:8020/x"]


def test_the_driver_steps_through_no_files(spark, monkeypatch):
    """What reaches the driver while a tree is listed does not grow with its files."""
    from pyspark.sql.classic.dataframe import DataFrame
    calls = []
    for name in ("collect", "toPandas", "toLocalIterator", "take", "first", "isEmpty"):
        own = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *a, _own=own, _name=name, **k: (calls.append(_name), _own(self, *a, **k))[1])
    counts = []
    for n in (3, 300):
        root = tempfile.mkdtemp(prefix="fimloom-many-")
        os.makedirs(f"{root}/_d")
        for i in range(n):
            open(f"{root}/_d/.f{i}.c", "w").write(f"int f{i}(void) {{ }}")
        calls.clear()
        files = S.read_binary_tree(spark, root)
        counts.append((list(calls), files.count()))
    assert counts[0][0] == counts[1][0] and [c[1] for c in counts] == [3, 300]


def test_collect_of_nothing(spark):
    assert collect_functions(spark, tempfile.mkdtemp(prefix="fimloom-none-")).collect() == []
