"""X4 collect_functions: source tree -> function table (JSON lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import function_table
from ..sources.decode import decode_files
from ..sources.files import DEFAULT_SKIP_DIRS, has_suffix, in_skipped_dir, normalize_path, read_binary_tree
from ..sources.jsonl import write_jsonl


def collect_frame(files: DataFrame) -> DataFrame:
    """Decoded files (file_path, text) -> (file_path, func_index, func_name, func_def); X3 with the
    file path normalised to '/'-separated form (S7), as the reference writes it."""
    files = files.withColumn("file_path", normalize_path(F.col("file_path")))
    return function_table(files)


def select_c_sources(manifest: DataFrame, suffixes=(".c",), skip_dirs=DEFAULT_SKIP_DIRS) -> DataFrame:
    """S1 + S3 on a manifest with a ``file_path`` column."""
    p = F.col("file_path")
    return manifest.filter(has_suffix(p, suffixes) & ~in_skipped_dir(p, skip_dirs))


def collect_functions(spark: SparkSession, project_directory: str, output_path: str | None = None,
                      skip_dirs=DEFAULT_SKIP_DIRS) -> DataFrame:
    """Scan ``.c`` files outside skipped directories, decode, extract every function; write JSONL when a
    path is given.  Returns the function table."""
    files = decode_files(read_binary_tree(spark, project_directory, (".c",), skip_dirs))
    funcs = collect_frame(files)
    if output_path:
        write_jsonl(funcs.select("func_name", "file_path", "func_def", "func_index"), output_path)
    return funcs
