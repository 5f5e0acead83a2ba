"""Merkle manifest of a dataset: a content-addressed DAG and proofs by descent from its root.

Leaves are digests of whole rows.  Per group (a language, say) they ascend by their order column; every
``FAN`` consecutive nodes become one node, whose digest is that of its children's digests, until one is
left, the group's subroot.  Subroots in order of their groups make the root the same way.

The manifest stores records digest -> children, one per different digest, level by level.  A request for
a leaf is its rank in its group; the digits of the rank in base FAN lead from the root down: each step
looks the node up by its digest, goes on with the child that the digit names and keeps the children left
and right of it.  The segments, reversed, are the proof from the leaf up.  Requests that still share
their digits descend as one (their number shrinks by FAN a level towards the root, so no digest near the
root is a hot key), and part only at the last step, which joins the up to FAN leaves of a lowest node.

Ranks come from a range partitioning: a row's place in its sorted partition plus the rows of its group in
earlier partitions.  Only one row per partition and group is summed, and a third of all rows may be one
group, or equal: equal rows are told apart by the order they were read in.  Every table is written once.

Cases: a null field is ``-`` in its leaf; null groups and null order values come first; rows that tie in
the order column follow their digests, and equal rows are leaves of their own; an empty text has a length
of 0; texts of any length are hashed whole; an empty table has no root and no proofs; only the named
columns are read, under private names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, written

#: Children of a node.
FAN = 8
#: Bits of a row's place inside its partition in monotonically_increasing_id().
PLACE_BITS = 33


def sha256(*parts: Column) -> Column:
    """Lowercase hex sha256 of strings or digests (as hex text), concatenated."""
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value (integers in decimal)."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*fields: Column) -> Column:
    return sha256(*map(field_text, fields))


@dataclass
class Manifest:
    """``leaves``: one row per row (its digest, group, rank, carried columns); ``roots``: one row per group with
    its subroot; ``stores`` and ``top_stores``: records digest -> children of the groups' trees and of the tree
    of subroots, lowest level first."""

    leaves: DataFrame
    roots: DataFrame
    root: str | None = None
    stores: list[DataFrame] = field(default_factory=list)
    top_stores: list[DataFrame] = field(default_factory=list)


def ranked(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, inside the group, by ``order``) and ``n`` (rows of the group).

    ``rows`` should be a written table: it is read twice, and its row numbers must not change."""
    rows = rows.withColumn("_group", F.col(group) if group else F.lit(0))
    rows = rows.withColumn("_read", F.monotonically_increasing_id())
    keys = ["_group", *order, "_read"]
    placed = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    by_part = placed.groupBy("_group", part).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy("_group").orderBy("_part")
    starts = by_part.select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), "_first",
                            (F.sum("_n").over(of_group) - F.col("_n")).alias("_before"),
                            F.sum("_n").over(Window.partitionBy("_group")).alias("n"))
    out = placed.withColumn("_part", part).join(starts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    out = out.withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before"))
    return out.drop("_group", "_read", "_place", "_part", "_g", "_p", "_first", "_before")


def tree(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(one row per group with its top digest, the levels' tables) of nodes (grp, idx, n, digest).

    A level's table holds (grp, idx, n, digest, children) of every group with several nodes below it."""
    levels, tops = [], [nodes.where("n = 1").select("grp", "digest", F.lit(0).alias("height"))]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = nodes.where("n > 1").groupBy("grp", F.floor(F.col("idx") / FAN).alias("idx"), F.ceil(F.col("n") / FAN).alias("n")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))          # FAN nodes at most
        up = up.select("grp", "idx", "n", F.col("run.digest").alias("children"))
        nodes = written(up.withColumn("digest", sha256(F.array_join("children", ""))), f"{name}-level-{len(levels) + 1}")
        levels.append(nodes)
        most = -(-most // FAN)
        tops.append(nodes.where("n = 1").select("grp", "digest", F.lit(len(levels)).alias("height")))
    return reduce(DataFrame.unionByName, tops), levels


def store(level: DataFrame) -> DataFrame:
    """Records digest -> children: equal subtrees have one."""
    return level.groupBy("digest").agg(F.first("children").alias("children"))


def build(docs: DataFrame, leaf: Column, group: Column, order: Column, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of the rows of ``docs``; ``carry`` names further columns that ``leaves`` keeps."""
    rows = written(docs.select(leaf.alias("digest"), group.alias("grp"), order.alias("ord"),
                               *[c.alias(name) for name, c in (carry or {}).items()]), "leaves")
    leaves = written(ranked(rows, "grp", ["ord", "digest"]), "ranked-leaves")
    subroots, levels = tree(leaves.select("grp", F.col("rank").alias("idx"), "n", "digest"), "groups")
    subroots = written(subroots, "subroots")
    roots = written(ranked(subroots, None, ["grp"]).withColumnRenamed("n", "groups"), "ranked-subroots")
    top, top_levels = tree(roots.select(F.lit(0).alias("grp"), F.col("rank").alias("idx"), F.col("groups").alias("n"), "digest"), "top")
    first = top.first()
    return Manifest(leaves, roots, first["digest"] if first else None, [written(store(x), "store") for x in levels],
                    [written(store(x), "top-store") for x in top_levels])


def digit(children: Column, at: Column) -> Column:
    """The unselected children, left and right of the one named by the digit ``at``."""
    at = at.cast("int")
    return F.struct(F.array_join(F.slice(children, 1, at), "").alias("left"),
                    F.array_join(F.slice(children, at + 2, FAN), "").alias("right"))


def step(frontier: DataFrame, records: DataFrame, wanted: DataFrame | None, name: str) -> DataFrame:
    """One step down: each node of the frontier (grp, subroot, idx, digest, segments) becomes its requested children."""
    found = frontier.withColumnRenamed("digest", "parent").join(records.withColumnRenamed("digest", "parent"), "parent")
    down = found.select("grp", "subroot", "idx", "segments", "children", F.posexplode("children").alias("at", "digest"))
    down = down.select("grp", "subroot", (F.col("idx") * FAN + F.col("at")).alias("idx"), "digest",
                       F.array_append("segments", digit(F.col("children"), F.col("at"))).alias("segments"))
    if wanted is not None:
        w = wanted.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"))
        down = down.join(w, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("idx") == F.col("_i")), "left_semi")
    return written(down, name)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (rows with grp, rank; default: all) with subroot and ``proof``, from the leaf up:
    an array of (left, right), the digests beside the path at each level, concatenated."""
    leaves, roots = manifest.leaves, manifest.roots
    no_segments = F.array().cast("array<struct<left:string,right:string>>")
    wanted: list[DataFrame] = []                   # per level from the lowest nodes up: requested (grp, idx)
    if requests is not None:
        asked = written(requests.select(F.col("grp").alias("_g"), F.col("rank").cast("long").alias("_r")).distinct(), "requests")
        leaves = leaves.join(asked, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("rank") == F.col("_r")), "left_semi")
        roots = roots.join(asked.select("_g").distinct(), F.col("grp").eqNullSafe(F.col("_g")), "left_semi")
        below = asked.select(F.col("_g").alias("grp"), F.col("_r").alias("idx"))
        for _ in manifest.stores:
            below = written(below.select("grp", F.floor(F.col("idx") / FAN).alias("idx")).distinct(), "wanted")
            wanted.append(below)
    subroot = roots.select("grp", F.col("digest").alias("subroot"), "height", F.col("rank").alias("top_rank"))
    if manifest.top_stores:                        # the tree of subroots: its leaves are the groups
        frontier = written(roots.limit(1).select(F.lit(0).alias("grp"), F.lit(None).cast("string").alias("subroot"), F.lit(0).cast("long").alias("idx"),
                                         F.lit(manifest.root).alias("digest"), no_segments.alias("segments")), "top-root")
        for k in range(len(manifest.top_stores) - 1, -1, -1):
            rank = (F.floor(F.col("rank") / FAN ** k) if k else F.col("rank")).alias("idx")
            frontier = step(frontier, manifest.top_stores[k], roots.select(F.lit(0).alias("grp"), rank).distinct(), "top-frontier")
        subroot = subroot.join(frontier.select(F.col("idx").alias("top_rank"), "segments"), "top_rank")
    else:
        subroot = subroot.withColumn("segments", no_segments)
    subroot = written(subroot, "subroot-paths")

    frontier = None
    for height in range(len(manifest.stores), 0, -1):      # nodes of this height, down to the lowest
        begin = subroot.where(F.col("height") == height).select(
            "grp", "subroot", F.lit(0).cast("long").alias("idx"), F.col("subroot").alias("digest"), "segments")
        frontier = begin if frontier is None else frontier.unionByName(begin)
        if height > 1:
            frontier = step(frontier, manifest.stores[height - 1], wanted[height - 2] if wanted else None, "frontier")
    names = [c for c in leaves.columns if c not in ("grp", "rank", "n", "digest")]
    at_leaf = leaves.select("grp", "rank", "n", "digest", *[named(c) for c in names])
    tops = subroot.select(F.col("grp").alias("_g"), "subroot", F.col("segments").alias("above"))
    lone = at_leaf.where("n = 1").join(tops, F.col("grp").eqNullSafe(F.col("_g"))).withColumn("proof", F.reverse("above")).drop("_g", "above")
    if frontier is None:
        return lone
    lowest = frontier.join(manifest.stores[0], "digest").select(F.col("grp").alias("_g"), "subroot", F.col("idx").alias("_block"), "segments", "children")
    several = at_leaf.where("n > 1").join(lowest, F.col("grp").eqNullSafe(F.col("_g")) & (F.floor(F.col("rank") / FAN) == F.col("_block")))
    proof = F.reverse(F.array_append("segments", digit(F.col("children"), F.col("rank") % FAN)))
    return lone.unionByName(several.withColumn("proof", proof).select(*[named(c) for c in lone.columns]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, beside: sha256(beside["left"], digest, beside["right"]))


def proof_digest(proof: Column) -> Column:
    return sha256(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def verify(docs: DataFrame, fields: list[str], tampered: Callable[[Column], Column], group_col: str, order_col: str, text_col: str = "text") -> DataFrame:
    """One row per row: its order value, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``tampered`` gives the text that is checked, from the text; the proofs are those of the original rows."""
    def leaf(text: Column) -> Column:
        return leaf_digest(*[text if c == text_col else docs[named(c)] for c in fields])

    text = docs[named(text_col)]
    manifest = build(docs, leaf(text), docs[named(group_col)], docs[named(order_col)], {"checked": leaf(tampered(text))})
    folded = prove(manifest).withColumn("folded_root", fold(F.col("checked"), F.col("proof")))
    return folded.select(F.col("ord").alias(order_col), F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"),
                         proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))
