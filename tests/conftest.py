from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fimloom.session import build_session
    ck = tempfile.mkdtemp(prefix="fimloom-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


def funcs_df(spark, texts, file_path="/t/a.c"):
    """Function rows from raw function texts."""
    rows = [(file_path, i, None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file_path string, func_index int, func_name string, func_def string")


def files_df(spark, texts):
    rows = [(p, t) for p, t in texts]
    return spark.createDataFrame(rows, "file_path string, text string")
