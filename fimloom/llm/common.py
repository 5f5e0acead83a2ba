"""Helpers shared by the operators: worker import path, bounded sub-batches, written tables."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Text handled at once inside a task; an Arrow batch is cut into slices of about this size.
SLICE_BYTES = 4 << 20


def with_worker_path(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed on them."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, have)])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def record_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """``record_slices`` with the column's values."""
    for part in record_slices(batches, column, limit):
        yield part, part.column(column).to_pylist()


def named(name: str) -> str:
    """A column's name as it stands, also with dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(named(c)) for c in df.columns]


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text (null id: null)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))


def crc_mod(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.pmod(id_crc(F.col(doc_id) if isinstance(doc_id, str) else doc_id), F.lit(modulus))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
