"""Packing of documents into training sequences, balanced by attention cost.

A document of n tokens costs n + n * n / quadratic_at (linear work plus attention).  Blocks of a whole
sequence are cut off where the document is tokenised.  What remains of each document is dealt to
groups of about ``group_tokens`` tokens by a hash of its row; inside a group the rests go in
descending cost to the cheapest sequence that has room, and those that fit nowhere whole are cut over
the room that is left.  A group opens no more sequences than its tokens need, so it pads less than
one sequence.

Cases: a null text is empty (its end id alone); a null id is carried; repeated rows and ids are packed
as documents of their own; very long texts become many whole sequences; ties are broken by the row's
number; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ENCODED_AT_ONCE, Bpe
from .common import text_slices, with_worker_path, written

#: Tokens of a group: what one task packs at once (8 MB of ids).
GROUP_TOKENS = 1 << 21
# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class LibraryIds(Bpe):
    """ids by a tokenizer library, with a worker's cache of the parts between spaces in front."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        self.library = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=self.vocab, special_tokens={})

    def encode_spaced(self, parts: list[str]) -> list[bytes]:
        ids = self.library.encode_ordinary
        return [array("I", ids(" " + c)).tobytes() for c in parts]


_LOADED: dict[str, LibraryIds] = {}


def load(path: str) -> LibraryIds:
    if path not in _LOADED:
        _LOADED[path] = LibraryIds(path)
    return _LOADED[path]


def tokenized_blocks(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """Blocks of ``capacity`` tokens and the rest of every document.

    doc_id, row_id, start, length, doc_tokens, ids_crc32, ids: a whole block has its crc32, a rest its ids."""
    with_worker_path(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = load(vocabulary), array("I", [end_id]).tobytes()
        width = 4 * capacity
        for part, texts in text_slices(batches, limit=ENCODED_AT_ONCE):
            of, start, length, total, crc, rest = [], [], [], [], [], []
            for i, ids in enumerate(bpe.encode(texts)):
                ids += end
                for at in range(0, len(ids), width):
                    piece = ids[at:at + width]
                    whole = len(piece) == width
                    of.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    total.append(len(ids) // 4)
                    crc.append(zlib.crc32(piece) if whole else None)
                    rest.append(None if whole else piece)
            at = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(at), part.column("row_id").take(at), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(crc, pa.int64()), pa.array(rest, pa.binary())],
                names=["doc_id", "row_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), "text").mapInArrow(
        run, f"doc_id {kind}, row_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, ids binary")


def balance(lengths: np.ndarray, capacity: int, quadratic_at: int) -> list[tuple[int, int, int, int, int]]:
    """(item, start in it, length, sequence, offset) of each piece; ``lengths`` are in descending order."""
    n = -(-int(lengths.sum()) // capacity)
    fill, cost = np.zeros(n, dtype=np.int64), np.zeros(n)
    pieces, later = [], []
    for i, length in enumerate(lengths.tolist()):
        s = int(np.argmin(np.where(fill + length <= capacity, cost, np.inf)))
        if fill[s] + length > capacity:
            later.append((i, length))
            continue
        pieces.append((i, 0, length, s, int(fill[s])))
        fill[s] += length
        cost[s] += length + length * length / quadratic_at
    room = iter(np.argsort(fill, kind="stable").tolist())
    s = next(room, None)
    for i, length in later:
        start = 0
        while start < length:
            while fill[s] == capacity:
                s = next(room)
            take = min(length - start, capacity - int(fill[s]))
            pieces.append((i, start, take, s, int(fill[s])))
            fill[s] += take
            start += take
    return pieces


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 0, quadratic_at: int = 1024,
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_cost."""
    blocks = written(tokenized_blocks(docs, vocabulary, capacity, end_id), "blocks")
    rests = blocks.where("ids is not null")
    tokens = rests.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // group_tokens))
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, piece_cost double"

    def pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_id"], ascending=[False, True], ignore_index=True)
        ids = rows["ids"].tolist()
        of, at, n, s, offset = (np.array(x, dtype=np.int64) for x in zip(*balance(rows["length"].to_numpy(), capacity, quadratic_at)))
        return pd.DataFrame({
            "doc_id": rows["doc_id"].iloc[of].array, "start": rows["start"].to_numpy()[of] + at, "length": n,
            "ids_crc32": np.array([zlib.crc32(ids[i][4 * a:4 * (a + k)]) for i, a, k in zip(of, at, n)], dtype=np.int64),
            "doc_tokens": rows["doc_tokens"].to_numpy()[of],
            "sequence_id": 2 * ((int(key[0]) << 32) + s), "offset": offset, "piece_cost": n + n * n / quadratic_at})

    packed = (rests.withColumn("doc_id", F.col("doc_id").cast("string"))       # pandas has no null in whole numbers
              .withColumn("group", F.pmod(F.xxhash64("row_id"), F.lit(groups)))
              .groupBy("group").applyInPandas(pack_group, f"doc_id string, {columns}")
              .withColumn("doc_id", F.col("doc_id").cast(kind)))
    n = F.col("length")
    whole = blocks.where("ids is null").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),     # even ids are those of the groups
        F.lit(0).cast("bigint").alias("offset"), (n + n * n / quadratic_at).alias("piece_cost"))
    return whole.unionByName(packed)
