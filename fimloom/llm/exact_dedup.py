"""Exact deduplication by a 128-bit content hash, with the bytes compared inside each group.

Rows are counted by hash with partial aggregation, so a group of any size reaches its reducer as one
row per task.  The texts of rows whose hash occurs twice are compared, byte by byte, with the text of
their group's best row; rows that differ (collisions) are grouped by their whole text.  Every join puts
one row per hash against the members and is followed by a write or the result, so Spark's skew join can
split a hot group.

Cases: a null text counts as empty; null ids rank last; of rows that repeat both id and text, the first
row of the table stays; rows equal in every column are copies like any other; an empty table gives no
rows; only id and text are read, under private names, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, written


NUMBER = "llm_row_number__"


def md5_128(text: Column) -> Column:
    return F.md5(text)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 hash128: Callable[[Column], Column] = md5_128, row_number: str | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, row_number.

    ``keep``: the row with the "smallest" or "largest" id of equal texts stays.  ``hash128`` maps the
    text's bytes to the grouping hash; ``row_number`` names a column that numbers the rows, if there is one."""
    if keep == "smallest":
        def best(rows: DataFrame, *keys: str) -> DataFrame:
            return rows.groupBy(*keys).agg(F.count("*").alias("_size"), F.min(F.struct(
                F.col("_id").isNull(), "_id", F.col("_row").alias("_first"))).alias("_best"))
    else:
        def best(rows: DataFrame, *keys: str) -> DataFrame:
            return rows.groupBy(*keys).agg(F.count("*").alias("_size"), F.max(F.struct(
                "_id", (-F.col("_row")).alias("_minus"))).alias("_best"))
    first_row = F.col("_best._first") if keep == "smallest" else -F.col("_best._minus")

    text = F.coalesce(docs[text_col], F.lit(""))
    number = docs[row_number] if row_number else F.monotonically_increasing_id()
    rows = docs.select(number.alias("_row"), docs[id_col].alias("_id"), text.alias("_text"),
                       F.encode(text, "UTF-8").alias("_bytes"))
    rows = rows.withColumn("_hash", hash128(F.col("_bytes")))
    digests = written(rows.select("_row", "_id", "_hash", F.sha2("_bytes", 256).alias("_sha")), "digests")
    groups = written(best(digests, "_hash").select(
        "_hash", "_size", F.col("_best._id").alias("_keep"), first_row.alias("_first")), "groups")

    # the bytes of every member against those of its group's best row
    members = written(rows.select("_id", "_hash", "_text").join(
        groups.where("_size > 1").select("_hash", "_keep"), "_hash"), "members")
    first = written(members.where(F.col("_id").eqNullSafe(F.col("_keep"))).groupBy("_hash").agg(
        F.min("_text").alias("_other")), "first-texts")
    differ = written(members.join(first, "_hash").where("_text != _other").select("_hash", "_text"), "collisions")
    whole = digests.join(groups, "_hash")
    if not differ.isEmpty():
        odd = (differ.select("_hash", F.sha2(F.encode("_text", "UTF-8"), 256).alias("_sha")).distinct())
        regrouped = best(digests.join(odd, ["_hash", "_sha"]), "_hash", "_sha").select(
            "_hash", "_sha", F.col("_size").alias("_n"), F.col("_best._id").alias("_k"), first_row.alias("_f"))
        plain = best(digests.join(odd, ["_hash", "_sha"], "left_anti"), "_hash").select(
            "_hash", F.col("_size").alias("_pn"), F.col("_best._id").alias("_pk"), first_row.alias("_pf"))
        whole = (whole.join(plain, "_hash", "left").join(regrouped, ["_hash", "_sha"], "left")
                 .withColumn("_keep", F.when(F.col("_n").isNull(), F.col("_pk")).otherwise(F.col("_k")))
                 .withColumn("_size", F.coalesce("_n", "_pn")).withColumn("_first", F.coalesce("_f", "_pf")))
    return whole.select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                        (F.col("_row") == F.col("_first")).alias("kept"), F.col("_sha").alias("text_sha256"),
                        F.col("_row").alias("row_number"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    numbered = written(docs.select(F.monotonically_increasing_id().alias(NUMBER), *columns_of(docs)), "numbered")
    stay = exact_groups(numbered, id_col, text_col, keep, row_number=NUMBER).where("kept")
    return numbered.join(stay.select(F.col("row_number").alias(NUMBER)), NUMBER, "left_semi").select(*columns_of(docs))
