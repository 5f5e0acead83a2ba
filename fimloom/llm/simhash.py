"""SimHash near-duplicates with pivot distance tables.

Every different fingerprint gets its Hamming distances to 65 reference fingerprints (pivots): zero,
and for each block of 16 bits the Walsh patterns of that block.  By the triangle inequality two
fingerprints within b bits differ by at most b in every coordinate, which discards pairs; and as at most
b of b + 2 blocks hold the differing bits, the coordinates of at least two whole blocks are equal, which
gives the joins their keys (all pairs of blocks, so nothing is lost).  Pairs that survive the maximum
coordinate difference are verified by their bit distance.

A key that more than ``pair_limit`` fingerprints share is not paired out.  Its fingerprints take each
fingerprint within b / 2 bits of them as a pivot of their own: two that share such a pivot are within b
bits (the upper side of the triangle inequality), and every two within b bits share one, so a star per
pivot holds all links; such a pivot has at most 65 members.  Links are joined to components by
alternating large and small stars over written tables.

Cases: a null text is empty and has fingerprint zero, linked like any other; rows that repeat an id
are members of their own; a null id is a member but names a component only if all ids there are null;
texts are read whole; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, text_slices, with_worker_path, written

NUMBER = "llm_row_number__"
BLOCK = 16
#: Fingerprints under one key up to which they are paired; keys with more go by shared pivots.
PAIR_LIMIT = 64


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """64-bit SimHash of a text's word shingles (ASCII lower case, ASCII white space, XXH64 with seed 42)."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    ends = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], 42) for a, b in zip(starts, ends)])
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 18):
        bits = np.unpackbits(np.frombuffer(hashes[i:i + (1 << 18)], dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, and fingerprint as a signed long."""
    with_worker_path(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            prints = np.array([fingerprint(t, words_per_shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints)], names=[id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"{id_col} {kind}, fingerprint bigint")


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivots(block_bits: int = BLOCK) -> list[list[int]]:
    """For each block of bits, its Walsh patterns and the full block: their distances tell the block's bits."""
    rows = [sum(((r & i).bit_count() & 1) << i for i in range(block_bits)) for r in range(1, block_bits)]
    rows.append((1 << block_bits) - 1)
    return [[m << at for m in rows] for at in range(0, 64, block_bits)]


def pivot_table(prints: DataFrame) -> DataFrame:
    """Adds ``zero`` (distance to fingerprint zero) and ``near0`` .. (distances to the pivots of each block)."""
    def distance(pivot: int) -> Column:
        return F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(pivot)))).cast("tinyint")

    return prints.select("fp", distance(0).alias("zero"),
                         *[F.array(*[distance(p) for p in block]).alias(f"near{b}") for b, block in enumerate(pivots())])


def links(prints: DataFrame, max_bits: int = 2, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints (column fp, all different) within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a != b")
    blocks = [f"near{b}" for b in range(64 // BLOCK)]
    table = pivot_table(prints)
    # within a block, a coordinate less the distance to zero depends on the block's bits alone
    code = {c: F.xxhash64(F.transform(F.col(c), lambda d: d - F.col("zero"))) for c in blocks}
    table = table.withColumns({f"code_{c}": x for c, x in code.items()})
    keys = [F.xxhash64(F.lit(i), f"code_{x}", f"code_{y}") for i, (x, y) in enumerate(itertools.combinations(blocks, 2))]
    keyed = written(table.select("fp", F.concat(F.array("zero"), *blocks).alias("coords"), F.explode(F.array(*keys)).alias("key")), "pivots")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, "key"), "shared-keys")

    few = shared.where(F.col("n") <= pair_limit)
    x = few.select("key", F.col("fp").alias("a"), F.col("coords").alias("ca"))
    y = few.select("key", F.col("fp").alias("b"), F.col("coords").alias("cb"))
    apart = F.array_max(F.zip_with("ca", "cb", lambda p, q: F.abs(p - q)))
    pairs = (x.join(y, "key").where("a < b").where(apart <= max_bits)
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))

    many = shared.where(F.col("n") > pair_limit).select("fp").distinct()
    if max_bits == 2:       # all fingerprints within one bit
        own = F.array(F.lit(0).cast("bigint"), *[F.lit(signed(1 << i)) for i in range(64)])
        moved = many.select("fp", F.explode(F.transform(own, lambda m: F.col("fp").bitwiseXOR(m))).alias("pivot"))
        near = Window.partitionBy("pivot")
    else:                   # halfway: one bit left open
        open_bit = F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(signed(~(1 << i) & (2 ** 64 - 1))).alias("mask")) for i in range(64)])
        moved = many.select("fp", F.explode(F.transform(
            open_bit, lambda m: F.struct(m["bit"].alias("bit"), F.col("fp").bitwiseAND(m["mask"]).alias("rest")))).alias("pivot"))
        near = Window.partitionBy("pivot")
    stars = moved.select(F.col("fp").alias("b"), F.min("fp").over(near).alias("a")).where("a < b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Large and small stars in turn, each round a written table, until nothing changes."""
    def star(e: DataFrame, larger: bool) -> DataFrame:
        if larger:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if larger:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return moved.where("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(edges.where("a != b").distinct(), "links")
    seen = state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = written(star(star(now, True), False), "stars")
        after = state(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, pair_limit: int = PAIR_LIMIT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = written(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    different = written(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("least")), "different")
    roots = components(links(different.select("fp"), max_bits, pair_limit))
    placed = different.join(roots, different["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = written(placed.join(names, "root").select("fp", "component_id"), "components")
    return (prints.join(of, prints["fingerprint"] == of["fp"])
            .select(id_col, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with their columns.

    Of rows that share that id the one with the smallest row number stays; without any id, the first row."""
    numbered = written(docs.select(F.monotonically_increasing_id().alias(NUMBER), *columns_of(docs)), "numbered")
    by_row = near_duplicates(numbered.select(NUMBER, text_col), words_per_shingle, max_bits, id_col=NUMBER, text_col=text_col)
    ids = numbered.select(NUMBER, F.col(id_col).alias("id")).join(by_row.select(NUMBER, "component_id"), NUMBER)
    stay = ids.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", NUMBER))[NUMBER].alias(NUMBER))
    return numbered.join(stay.select(NUMBER), NUMBER, "left_semi").select(*columns_of(docs))
