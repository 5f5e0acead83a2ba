"""Rendezvous hashing of record keys over weighted shards.

Every shard scores every key: with u = md5(shard, key) as a number in (0, 1), the score is -weight / ln(u)
and the shard of the highest score takes the key.  A further shard changes no score, so it takes rows
only into itself, and shards get keys in proportion to their weights.  All by Spark's own functions.

Slots number a shard's rows without gaps: rows are numbered inside buckets of the shard (a hash of the
whole row's key and content, so a repeated key is split), and a bucket starts where those before it end.
Rows equal in key and content share a bucket; they are split by a written row number modulo ``SALTS``, counted with
partial aggregation, and numbered apart, so no task sorts a hot group.  Only the bounded table of shards x buckets
is summed in one place.

Cases: a null key is a key of its own; a null text has size 1; repeated rows share a bucket and are
numbered in any order among themselves (they are equal); an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Buckets of a shard for slot numbers: rows of a shard / BUCKETS are sorted together.
BUCKETS = 1024
#: Parts of the rows that are equal in key and content.
SALTS = 256


def unit_hash(*parts: Column) -> Column:
    """md5 of the parts as a number in (0, 1), from its first 13 hex digits."""
    digits = F.substring(F.md5(F.encode(F.concat_ws("|", *parts), "UTF-8")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard of a key (a string column; null is a key of its own)."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    key = F.coalesce(key, F.lit("null"))
    scores = [F.struct((F.lit(float(w)) / -F.ln(unit_hash(F.lit(str(s)), key))).alias("score"), F.lit(-s).alias("minus"))
              for s, w in enumerate(weights)]
    return -(F.greatest(*scores) if len(scores) > 1 else scores[0])["minus"]


def shard(docs: DataFrame, weights: list[float], grown: list[float] | None = None, id_col: str = "doc_id",
          text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row per row: id, size, text_crc32, law, shard, slot, grown_shard (under the weights ``grown``)."""
    raw = F.encode(F.coalesce(docs[text_col], F.lit("")), "UTF-8")
    key = docs[id_col].cast("string")
    rows = docs.select(docs[id_col].alias("id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"),
                       F.crc32(raw).alias("text_crc32"), shard_of(key, weights).alias("shard"),
                       (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    rows = rows.withColumn("bucket", F.floor(unit_hash(F.coalesce(F.col("id").cast("string"), F.lit("null")),
                                                       F.col("text_crc32").cast("string")) * buckets).cast("int"))
    rows = written(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))), "shards")
    equal = ["shard", "bucket", "id", "text_crc32", "size", "salt"]
    groups = rows.groupBy(*equal).agg(F.count("*").alias("n"))
    per_bucket = groups.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(F.col("shard").alias("s"), F.col("bucket").alias("b"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # one row per group of equal rows and salt: where it starts in its bucket
    inside = Window.partitionBy("shard", "bucket").orderBy(*equal[2:])
    ahead = groups.withColumn("ahead", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    first = ahead.join(starts, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        *[F.col(c).alias(f"_{c}") for c in equal], (F.col("start") + F.col("ahead")).alias("start"))
    numbered = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*equal).orderBy(F.lit(0))) - 1)
    placed = numbered.join(first, (F.col("id").eqNullSafe(F.col("_id"))) & (F.col("shard") == F.col("_shard")) & (F.col("bucket") == F.col("_bucket"))
                           & (F.col("text_crc32") == F.col("_text_crc32")) & (F.col("size") == F.col("_size")) & (F.col("salt") == F.col("_salt")))
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("rank")).cast("bigint").alias("slot"), "grown_shard")
