"""Periodic runs of words: block convolution at dyadic scales.

A run is a stretch of a text's words with smallest period q and a length of at least max(LEAST, FOLDS q)
that no neighbouring word extends.  For a scale B = 1, 2, 4 .. the words of a slice of texts are cut into
blocks of B.  The sum of squared differences of a block and of the words at every distance d from B to
2B - 1 after it is a cross-correlation, computed for all blocks together by an exact number-theoretic
transform (integers modulo a prime, as matrix products of whole numbers below 2^53); it is zero where the
block occurs again.  A run with a period in [B, 2B) holds a whole block that occurs again at that distance,
as it is at least four periods long, so no run is missed.  A zero seeds an extension by exact comparison of
words to both sides, which also rules out sums that only vanish modulo the prime.

A seed that lies wholly in a known run of a period q <= B belongs to no other run of a larger smallest period
(two periods would overlap by more than their sum, which makes them one), so such seeds are passed
over, and of neighbouring blocks at one distance the first is extended.

Cases: null and empty texts have no words and no runs, and collapse to the empty text; null ids and repeated
rows are rows of their own; texts are processed whole, and a slice holds one text at least, so memory
follows the longest text; an empty table gives no rows; other columns are not read, under any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, text_slices, with_worker_path

#: Least words of a run, and least periods.
LEAST, FOLDS = 6, 4
#: 3 * 2^18 + 1 and a generator of its units: transforms of up to 2^18 points, and products of two residues
#: summed over 2^11 terms stay below 2^53 (one of them in [-PRIME, 2 PRIME)), so float64 matrix products are exact.
PRIME, GENERATOR = 786433, 10
#: Points of the largest transform.
LARGEST = 1 << 18
#: Points of a transform done as one matrix product; larger ones are split.
MATRIX = 512
#: Words whose blocks are transformed together.
CHUNK = 1 << 15

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def residues(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2^53 modulo PRIME, in place; the quotient may be off by one, so in [-PRIME, 2 PRIME)."""
    quotient = x * (1.0 / PRIME)
    np.floor(quotient, out=quotient)
    quotient *= PRIME
    x -= quotient
    return x


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(n: int, inverse: bool) -> np.ndarray:
    """The n powers of a root of unity of order n."""
    if (n, inverse) not in _POWERS:
        w = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        if inverse:
            w = pow(w, PRIME - 2, PRIME)
        out = np.ones(n, np.int64)
        done = 1
        while done < n:
            more = min(done, n - done)
            out[done:done + more] = out[:more] * pow(w, done, PRIME) % PRIME
            done += more
        _POWERS[n, inverse] = out
    return _POWERS[n, inverse]


_MATRICES: dict[tuple[int, bool], np.ndarray] = {}


def matrix(n: int, inverse: bool) -> np.ndarray:
    if (n, inverse) not in _MATRICES:
        i = np.arange(n)
        _MATRICES[n, inverse] = powers(n, inverse)[np.outer(i, i) % n].astype(np.float64)
    return _MATRICES[n, inverse]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of every row (residues; a power of two long), without the inverse's 1/n."""
    rows, n = x.shape
    if n <= MATRIX:
        return residues(x @ matrix(n, inverse))
    # n = a * b: transforms of a points down the columns, twiddles, transforms of b points along the rows
    a = 1 << (n.bit_length() // 2)
    b = n // a
    y = transform(np.ascontiguousarray(x.reshape(rows, a, b).transpose(0, 2, 1)).reshape(-1, a), inverse).reshape(rows, b, a)
    twiddle = powers(n, inverse)[np.outer(np.arange(b), np.arange(a)) % n].astype(np.float64)
    y = residues(y * twiddle).transpose(0, 2, 1)
    z = transform(np.ascontiguousarray(y).reshape(-1, b), inverse).reshape(rows, a, b)
    return np.ascontiguousarray(z.transpose(0, 2, 1)).reshape(rows, n)


def zero_mismatches(codes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance): blocks whose squared differences from the words ``distance`` later sum to zero
    modulo PRIME, for every distance from ``block`` to 2 * ``block`` - 1."""
    size = 2 * block
    if size > LARGEST:
        return _by_halves(codes, block)
    blocks = -(-len(codes) // block)
    values = np.zeros((blocks + 2) * block)
    values[:len(codes)] = codes % PRIME
    sums = np.concatenate(([0.0], np.cumsum(residues(values * values)), np.zeros(block)))    # whole, far below 2^53
    squares = (sums[block:] - sums[:-block])[:len(values)].reshape(-1, block)     # of the block of words from each place on
    values = values.reshape(-1, block)
    small = size <= MATRIX
    ahead, back = (matrix(size, False)[:block], np.ascontiguousarray(matrix(size, True)[:, :block])) if small else (None, None)
    flip = np.ones(size)
    flip[1::2] = -1.0
    scale = 2.0 * pow(size, PRIME - 2, PRIME)
    starts, distances = [], []
    per_chunk = max(1, CHUNK // block)
    for first in range(0, blocks, per_chunk):
        last = min(blocks, first + per_chunk)
        part = values[first:last + 2]
        # of every block, padded to two
        spectrum = residues(part @ ahead) if small else transform(np.pad(part, ((0, 0), (0, block))))
        follow = spectrum[2:] * flip                      # of the two blocks after it
        follow += spectrum[1:-1]
        # times the block's spectrum at the opposite frequency
        follow[:, 0] *= spectrum[:-2, 0]
        follow[:, 1:] *= spectrum[:-2, :0:-1]
        residues(follow)
        inner = residues(follow @ back) if small else transform(follow, inverse=True)[:, :block]
        inner *= -scale
        inner += squares[first:last, :1]
        inner += squares[first + 1:last + 1]
        k, d = np.nonzero(inner == np.rint(inner * (1.0 / PRIME)) * PRIME)
        starts.append((first + k) * block)
        distances.append(d + block)
    return np.concatenate(starts), np.concatenate(distances)


def _by_halves(codes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Beyond the prime's transforms: the mismatches of a block are the sum of those of its parts, each with
    windows of its own."""
    unit = LARGEST // 4
    starts, distances = [], []
    padded = np.concatenate((codes, np.full(3 * block, -1, np.int64)))
    for at in range(0, len(codes), block):
        total = np.zeros(block, np.int64)
        for p in range(at, at + block, unit):
            for q in range(0, block, unit):               # distances block + q .. block + q + unit - 1
                total[q:q + unit] += _mismatch(padded[p:p + unit], padded[p + block + q:p + block + q + 2 * unit])
        d = np.nonzero(total % PRIME == 0)[0]
        starts.append(np.full(len(d), at))
        distances.append(d + block)
    return np.concatenate(starts), np.concatenate(distances)


def _mismatch(part: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Squared differences (modulo PRIME) of ``part`` and each of its first len(part) places in ``window`` of twice its length."""
    n = len(part)
    x, y = part % PRIME, np.zeros(2 * n, np.int64)
    y[:len(window)] = window % PRIME
    wide = np.zeros((2, 2 * n))
    wide[0, :n], wide[1] = x, y
    spectrum = transform(wide)
    product = residues(spectrum[:1, (-np.arange(2 * n)) % (2 * n)] * spectrum[1:])
    inner = transform(product, inverse=True)[0, :n].astype(np.int64) * pow(2 * n, PRIME - 2, PRIME) % PRIME
    sums = np.concatenate(([0], np.cumsum(y * y % PRIME)))
    return (int((x * x % PRIME).sum()) + sums[n:2 * n] - sums[:n] - 2 * inner) % PRIME


def equal_ahead(codes: np.ndarray, left: np.ndarray, right: np.ndarray, way: int) -> np.ndarray:
    """How many words agree from ``left`` and ``right`` on, forwards (way 1) or backwards (-1).

    Separate texts end in different codes below zero, so no comparison runs from one text into another."""
    out = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    width, n = 16, len(codes)
    while len(active):
        width = max(1, min(width, (1 << 22) // len(active)))
        reach = way * np.arange(width)[None, :]
        a = left[active, None] + way * out[active, None] + reach
        b = right[active, None] + way * out[active, None] + reach
        inside = (a >= 0) & (b >= 0) & (a < n) & (b < n)
        same = inside & (codes[np.clip(a, 0, n - 1)] == codes[np.clip(b, 0, n - 1)])
        differ = ~same
        run = np.where(differ.any(1), differ.argmax(1), width)
        out[active] += run
        active = active[run == width]
        width *= 2
    return out


def runs_of(codes: np.ndarray, longest: int) -> np.ndarray:
    """All runs in ``codes`` as rows (start, end, period), ``longest`` words a text at most."""
    n = len(codes)
    reach = np.zeros(n + 1, np.int64)                     # furthest end of a known run that holds the word
    found = [np.zeros((0, 3), np.int64)]
    block = 1
    while FOLDS * block <= longest:
        at, d = zero_mismatches(codes, block)
        inside = at + d + block <= n
        at, d = at[inside], d[inside]
        new = (reach[at] < at + d + block) & (codes[at] >= 0)
        at, d = at[new], d[new]
        if len(at):
            order = np.lexsort((at, d))
            at, d = at[order], d[order]
            head = np.ones(len(at), bool)
            head[1:] = (d[1:] != d[:-1]) | (at[1:] != at[:-1] + block)
            at, d = at[head], d[head]
            ahead = equal_ahead(codes, at, at + d, 1)
            true = ahead >= block                         # else the sum only vanished modulo the prime
            at, d, ahead = at[true], d[true], ahead[true]
            begin = at - equal_ahead(codes, at - 1, at + d - 1, -1)
            end = at + ahead + d
            enough = end - begin >= np.maximum(LEAST, FOLDS * d)
            rows = np.unique(np.stack([begin[enough], end[enough], d[enough]], 1), axis=0)
            found.append(rows)
            for b, e, _ in rows:
                np.maximum(reach[b:e], e, out=reach[b:e])
        block *= 2
    return np.concatenate(found)


def coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """(codes with a separator of its own after every text, first place of every text, words of every text)."""
    words = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = pa.array([w for ws in words for w in ws], pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)))
    codes = np.empty(firsts[-1], np.int64)
    ends = firsts[1:] - 1
    codes[ends] = -1 - np.arange(len(texts))
    mask = np.ones(len(codes), bool)
    mask[ends] = False
    codes[mask] = flat
    return codes, firsts, words


def find_runs(texts: list[str | None]) -> tuple[list[np.ndarray], list[list[bytes]]]:
    """(runs (start, end, period) of every text by start, then period; words of every text)."""
    codes, firsts, words = coded(texts)
    sizes = np.diff(firsts) - 1
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    # texts of like length together, so that none goes through scales beyond its own
    scale = np.where(sizes >= LEAST, np.maximum(0, np.log2(np.maximum(sizes, 1) / FOLDS)).astype(int), -1)
    for s in np.unique(scale[scale >= 0]):
        some = np.nonzero(scale == s)[0]
        part = np.concatenate([codes[firsts[i]:firsts[i + 1]] for i in some])
        begins = np.concatenate(([0], np.cumsum(sizes[some] + 1)))
        found = runs_of(part, int(sizes[some].max()))
        if len(found):
            owner = np.searchsorted(begins, found[:, 0], "right") - 1
            found[:, :2] -= begins[owner, None]
            order = np.lexsort((found[:, 2], found[:, 0], owner))
            for i, rows in zip(*_grouped(owner[order], found[order])):
                out[some[i]] = rows
    return out, words


def _grouped(owner: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    cut = np.nonzero(np.diff(owner))[0] + 1
    return [int(o[0]) for o in np.split(owner, cut)], np.split(rows, cut)


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words that are in no run after its first period, joined by one space."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 1], -1)
        words = [w for w, depth in zip(words, np.cumsum(edge).tolist()) if not depth]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, text: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``text`` may be any column over ``docs``; default: its text column."""
    with_worker_path(docs.sparkSession)
    source = docs.select(docs[named(id_col)].alias("llm_id__"), (docs[named(text_col)] if text is None else text).alias("llm_text__"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "llm_text__"):
            runs, words = find_runs(texts)
            flat = np.concatenate(runs)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32()),
                pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])],
                                           fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays(
                [part.column("llm_id__"), pa.array([len(w) for w in words], pa.int64()), lists,
                 pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.string())],
                names=["llm_id__", "n_words", "runs", "collapsed"])

    schema = f"llm_id__ {dict(source.dtypes)['llm_id__']}, n_words bigint, runs {RUNS}, collapsed string"
    return source.mapInArrow(run, schema).withColumnRenamed("llm_id__", id_col)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period (ties: smallest start, then period); null if there is none."""
    def better(a: Column, b: Column) -> Column:           # runs come by start, then period
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def run_lines(runs: Column) -> Column:
    """``start,length,period`` of every run, each with a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                             r["period"].cast("string"), F.lit("\n"))), "")


def with_planted_period(text: Column, crc: Column) -> Column:
    """The text's words, joined by one space, made periodic from a place on that ``crc`` names (g = crc / 10: from
    word g % n with the period 1 + (n - g % n) / (3 + g % 8)); a text without words stays."""
    g = F.floor(crc / 10)

    def planted(w: Column) -> Column:                     # the words are split once
        n = F.size(w)
        a, p = g % n, 1 + F.floor((n - g % n) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, at(i))), " "))

    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+", -1), "")
    return F.coalesce(F.element_at(F.transform(F.array(words), planted), 1), text)
