"""Incremental X4: collect functions from C files as they land in a directory (Structured Streaming).

``binaryFile`` is a streaming file source; each micro-batch is decoded and cut into function rows by
the same batch plan as ``plans.collect`` (windows need a bounded input, hence ``foreachBatch``).  Each
batch writes its own folder ``batch=<id>`` in overwrite mode, so a replayed batch (after a failure)
replaces its earlier output instead of duplicating it; the source's offsets live in the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from ..plans.collect import collect_frame
from ..sources.decode import decode_files
from ..sources.files import DEFAULT_SKIP_DIRS, in_skipped_dir, local_path, unskipped
from ..sources.jsonl import write_jsonl


BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


def start_collect_stream(spark: SparkSession, source_dir: str, output_dir: str, checkpoint_location: str,
                         skip_dirs=DEFAULT_SKIP_DIRS, available_now: bool = True) -> StreamingQuery:
    stream = (spark.readStream.format("binaryFile")
              .schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.c")
              .option("recursiveFileLookup", "true")
              .load(source_dir))
    files = unskipped(stream, F.col("_metadata.file_path"), skip_dirs).select(local_path(F.col("path")).alias("file_path"), "content")
    if skip_dirs:
        files = files.filter(~in_skipped_dir(F.col("file_path"), skip_dirs))

    def batch(df: DataFrame, batch_id: int) -> None:
        funcs = collect_frame(decode_files(df))
        write_jsonl(funcs.select("func_name", "file_path", "func_def", "func_index"),
                    f"{output_dir.rstrip('/')}/batch={batch_id}")

    w = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
