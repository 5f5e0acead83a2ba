"""Hidden Markov language model: Baum-Welch in Spark, exact likelihood by the scaled forward recursion.

Tokens are the words of a text (cut at ASCII white space, A-Z in lower case) and one end.  Counts of all
training words come from Spark.  The ``symbols`` most frequent words, the end and the classes of the
other words (by length) are the model's symbols; a word that is no symbol is emitted as its class times
its smoothed share of the class, (c + 0.5) / (N + 0.5 * (V + 1)) with the counts of that class, so the
model is a probability of the text itself.

Baum-Welch starts from the counts of neighbouring symbols of all training texts: an EM over pairs of
symbols, on the driver, whose states differ from the first.  Then every task runs forward and backward
over its training texts, and Spark sums the likelihood and the expected counts of the tasks by (kind,
state, symbol), until a round raises the log likelihood by less than ``TOLERANCE`` of it.  Training reads
all texts whole, in windows of ``window`` tokens that each begin anew; scoring never cuts a text.  Words
are cut, numbered and looked up slice by slice in Arrow and numpy.  The tables that a task needs (the
``head`` most frequent words, the most frequent of the longer ones, and the parameters) are bounded by
parameters; counts of all other words are joined, one row per document and word.

Cases: a null text is empty (its end alone); a null id counts as held in; repeated rows are each scored
(and each trained on); texts and words of any length are whole; without any training row N and V are
0 and the model is uniform; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, named, record_slices, text_slices, with_worker_path, written

STATES, SYMBOLS, WINDOW = 6, 2048, 1024
#: Training ends when a round raises the log likelihood by less than this share of it; the start, when PAIR_STEPS
#: steps raise the mean ln probability of a pair by less than PAIR_GAIN.
TOLERANCE, PAIR_STEPS, PAIR_GAIN = 1e-4, 5, 1e-5
#: Most frequent words (at most) whose counts every task holds, and the longest of them in bytes; the same for longer ones.
HEAD, HEAD_BYTES = 200_000, 40
LONG_HEAD, LONG_BYTES = 1_000, 4096
#: Classes of words that are no symbol: by length in bytes, the last for all longer ones.
CLASSES = 16
#: Tokens of one forward pass, and of one block of its steps when nothing but the likelihood is kept.
PASS_TOKENS, BLOCK_TOKENS = 1_200_000, 400_000
#: Bytes of text, and of symbols, that a task works on at once.
SLICE, ID_SLICE = 8 << 20, 1 << 20


def word_class(word: bytes) -> int:
    return min(len(word), CLASSES) - 1


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of every text; each word as its place among the different ones; the different ones (binary).

    The empty string may be among the different ones; no word is it.  Texts are lowered first: that gives an array of its own,
    as the wider offsets that the cast gives to part of an array do not begin with its bytes."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()).fill_null(""))
    lengths = pc.list_value_length(lists).to_numpy()
    numbered = lists.flatten().dictionary_encode()
    different, codes = numbered.dictionary.cast(pa.large_binary()), numbered.indices.to_numpy()
    empty = pc.index(different, pa.scalar(b"", pa.large_binary())).as_py()
    if empty < 0:
        return lengths, codes, different
    there = codes != empty
    return np.bincount(np.repeat(np.arange(len(lengths)), lengths)[there], minlength=len(lengths)), codes[there], different


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (binary), c: how often every word stands in the texts."""
    with_worker_path(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in record_slices(batches, "text", SLICE):
            _, codes, different = words_of(part.column("text"))
            n = np.bincount(codes, minlength=len(different))
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([different.take(pa.array(there)).cast(pa.binary()), pa.array(n[there], pa.int64())],
                                             names=["word", "n"])

    parts = docs.select(docs[text_col].alias("text")).mapInArrow(run, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words whose count reaches a bound: the smallest one (to twelve binary digits) that at most ``most`` words reach.

    Only the number of words by bound goes to the driver, some 100,000 at most, and no task reads other tasks' words."""
    binary = counts.select("c", F.greatest(F.floor(F.log2("c")) - 11, F.lit(0)).cast("int").alias("cut"))
    sizes = binary.groupBy(F.expr("shiftleft(shiftright(c, cut), cut)").alias("bound")).agg(F.count("*").alias("n")).collect()
    reached, least = 0, None
    for bound, n in sorted(map(tuple, sizes), reverse=True):
        reached += n
        if reached > most:
            break
        least = bound
    return counts.where(F.col("c") >= least if least is not None else F.lit(False)).select("word", "c")


class Parameters:
    """Vocabulary of the model and its probabilities; what is broadcast to the tasks."""

    def __init__(self, head: list[tuple[bytes, int]], tokens: int, distinct: int, ends: int, class_tokens: np.ndarray,
                 class_words: np.ndarray, states: int, symbols: int):
        self.words = pa.array([w for w, _ in head], pa.large_binary())
        self.counts = np.array([c for _, c in head], dtype=np.int64)
        self.symbol = {w: i for i, (w, _) in enumerate(head[:symbols])}
        self.end = len(self.symbol)
        self.first_class = self.end + 1
        self.size = self.first_class + CLASSES
        self.tokens, self.distinct, self.ends = tokens, distinct, ends
        self.class_tokens, self.class_words = class_tokens, class_words
        share = np.zeros(self.size)
        share[:self.end] = [c for _, c in head[:symbols]]
        share[self.end] = ends
        share[self.first_class:] = class_tokens
        share = (share + 0.5) / (share + 0.5).sum()
        # the states start as the words' shares, each disturbed by a fixed pattern
        rng = np.random.default_rng(20240601)
        self.emit = share * rng.uniform(0.5, 1.5, (states, self.size))
        self.emit /= self.emit.sum(axis=1, keepdims=True)
        self.move = rng.uniform(0.5, 1.5, (states, states))
        self.move /= self.move.sum(axis=1, keepdims=True)
        self.start = np.full(states, 1 / states)

    def places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of every word its place in the head (-1: none) and its symbol."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        of_class = self.first_class + np.minimum(pc.binary_length(words).to_numpy(), CLASSES) - 1
        return at, np.where((at >= 0) & (at < self.end), at, of_class)

    def base(self, c: np.ndarray | int) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def in_class(self) -> np.ndarray:
        """log10 share of every word of the head among the words of its class that are no symbols; 0 for symbols."""
        k = np.minimum(pc.binary_length(self.words).to_numpy(), CLASSES) - 1
        out = np.log10((self.counts + 0.5) / (self.class_tokens[k] + 0.5 * (self.class_words[k] + 1)))
        out[:self.end] = 0
        return out


def with_ends(symbols: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each with its end; where every text begins, and the end of the last."""
    return np.insert(symbols, np.cumsum(n), end), np.concatenate([[0], np.cumsum(n + 1)])


def forward(p: Parameters, rows: list[np.ndarray], keep: bool = False):
    """ln likelihood of each row of symbols; with ``keep`` also the expected counts of all rows.

    Time steps run over all rows still alive at once (rows in descending order of length); unless ``keep``, a
    block of steps at a time, so that a long row needs little more memory than its symbols."""
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    lengths = np.array([len(rows[i]) for i in order])
    steps = int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")       # rows longer than t
    at = np.concatenate([[0], np.cumsum(alive)])
    flat = np.empty(int(lengths.sum()), dtype=rows[0].dtype)
    for j, i in enumerate(order):
        flat[at[:len(rows[i])] + j] = rows[i]
    states = p.emit.shape[0]
    alphas = np.empty((states, len(flat))) if keep else None
    move = np.ascontiguousarray(p.move.T)
    alpha = np.tile(p.start[:, None], len(rows))
    logs = np.zeros(len(rows))
    cuts = [0, steps] if keep else np.unique(np.append(np.searchsorted(at, np.arange(0, len(flat), BLOCK_TOKENS)), steps)).tolist()
    for begin, stop in itertools.pairwise(cuts):
        first, last = int(at[begin]), int(at[stop])
        emit = np.take(p.emit, flat[first:last], axis=1)                     # state x token
        scales = np.empty(last - first)
        ends = (at[begin:stop + 1] - first).tolist()
        for t in range(stop - begin):
            a, b = ends[t], ends[t + 1]
            alpha = (move @ alpha[:, :b - a] if begin + t else alpha) * emit[:, a:b]
            scale = alpha.sum(axis=0, out=scales[a:b])
            alpha /= scale
            if keep:
                alphas[:, a:b] = alpha
        row = np.arange(first, last) - np.repeat(at[begin:stop], alive[begin:stop])
        logs += np.bincount(row, weights=np.log(scales), minlength=len(rows))
    back = np.empty(len(rows))
    back[order] = logs
    if not keep:
        return back
    moves = np.zeros((states, states))
    gammas = alphas                                                           # overwritten from the last step on
    emit /= scales
    beta = np.ones((states, int(alive[-1])))
    for t in range(steps - 1, -1, -1):
        a, b = ends[t], ends[t + 1]
        n = b - a
        if beta.shape[1] < n:
            beta = np.concatenate([beta, np.ones((states, n - beta.shape[1]))], axis=1)
        if t:
            seen = beta * emit[:, a:b]
            moves += alphas[:, ends[t - 1]:ends[t - 1] + n] @ seen.T
            gammas[:, a:b] *= beta
            beta = p.move @ seen
        else:
            gammas[:, :b] *= beta
    counts = np.stack([np.bincount(flat, weights=g, minlength=p.size) for g in gammas])
    return back, gammas[:, :ends[1]].sum(axis=1), moves * p.move, counts


def passes(rows: list[np.ndarray]) -> Iterator[list[int]]:
    """Numbers of the rows of each pass: like lengths together, about PASS_TOKENS tokens."""
    part, size = [], 0
    for i in sorted(range(len(rows)), key=lambda i: -len(rows[i])):
        if part and size + len(rows[i]) > PASS_TOKENS:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(rows[i])
    if part:
        yield part


def encoded(docs: DataFrame, shared, text_col: str = "text") -> DataFrame:
    """ids (binary): the symbols of every text and its end, as numbers of ``symbol_type``."""
    with_worker_path(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        kind = np.dtype(symbol_type(p))
        for part in record_slices(batches, "text", SLICE):
            n, codes, different = words_of(part.column("text"))
            ids, at = with_ends(p.places(different)[1].astype(kind)[codes], n, p.end)
            offsets = (at * kind.itemsize).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([column], names=["ids"])

    return docs.select(docs[text_col].alias("text")).mapInArrow(run, "ids binary")


def symbol_type(p: Parameters) -> str:
    return "<u2" if p.size <= 1 << 16 else "<u4"


def neighbours(ids: DataFrame, p: Parameters) -> np.ndarray:
    """How often symbol j follows symbol i in the texts."""
    size, end, kind = p.size, p.end, symbol_type(p)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size * size, dtype=np.int64)
        for _, texts in text_slices(batches, "ids", ID_SLICE):
            flat = np.frombuffer(b"".join(texts), dtype=kind).astype(np.int64)
            pairs = flat[:-1] * size + flat[1:]
            seen += np.bincount(pairs[flat[:-1] != end], minlength=size * size)
        pair = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(seen[pair])], names=["pair", "n"])

    sums = ids.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()    # bounded: symbols²
    out = np.zeros(size * size, dtype=np.float32)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out.reshape(size, size)


def start_from(p: Parameters, pairs: np.ndarray) -> None:
    """Emissions and moves that EM over pairs of neighbours gives; its states differ from the first, so it meets no plateau."""
    total = float(pairs.sum())
    if not total:
        return
    states = len(p.move)
    rng = np.random.default_rng(1)
    share = (pairs.sum(axis=0) + pairs.sum(axis=1) + 0.5).astype(np.float32)
    emit = share * rng.gamma(0.3, size=(states, p.size)).astype(np.float32) + 1e-9 * share
    emit /= emit.sum(axis=1, keepdims=True)
    both = rng.uniform(0.5, 1.5, (states, states)).astype(np.float32)
    both /= both.sum()
    before = -np.inf
    for step in itertools.count():
        model = np.maximum(emit.T @ (both @ emit), 1e-30)
        if step % PAIR_STEPS == 0:
            now = float((pairs * np.log(model)).sum(dtype=np.float64)) / total
            if now - before < PAIR_GAIN:
                break
            before = now
        ratio = np.divide(pairs, model, out=model)
        right = ratio @ emit.T
        new = emit * (both @ right.T + (both.T @ emit) @ ratio) + np.float32(0.01)
        both = both * (emit @ right) + np.float32(0.01)
        emit, both = new / new.sum(axis=1, keepdims=True), both / both.sum()
    p.emit = emit.astype(np.float64)
    p.emit /= p.emit.sum(axis=1, keepdims=True)
    p.move = both.astype(np.float64)
    p.move /= p.move.sum(axis=1, keepdims=True)


def expected(ids: DataFrame, shared, window: int) -> DataFrame:
    """kind (start, move, emit, ln likelihood), state, symbol, value: expected counts of all texts, summed over tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        states, number = p.emit.shape[0], symbol_type(p)
        starts, moves, counts, logs = np.zeros(states), np.zeros((states, states)), np.zeros(p.emit.shape), 0.0
        rows, size = [], 0
        for _, texts in itertools.chain(text_slices(batches, "ids", ID_SLICE), [(None, None)]):
            for t in texts or []:
                one = np.frombuffer(t, dtype=number)
                rows += [one[i:i + window] for i in range(0, len(one), window)]
                size += len(one)
            if texts and size < PASS_TOKENS // 2:             # wide passes: a step costs the same for few rows
                continue
            for part in passes(rows):
                found, s, m, c = forward(p, [rows[i] for i in part], keep=True)
                logs += found.sum()
                starts += s
                moves += m
                counts += c
            rows, size = [], 0
        state, sym = np.nonzero(counts)
        i, j = np.nonzero(moves)
        kind = np.concatenate([np.zeros(states, int), np.ones(len(i), int), np.full(len(state), 2), [3]])
        yield pa.RecordBatch.from_arrays([
            pa.array(kind.astype(np.int32)), pa.array(np.concatenate([np.arange(states), i, state, [0]]).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(states, int), j, sym, [0]]).astype(np.int32)),
            pa.array(np.concatenate([starts, moves[i, j], counts[state, sym], [logs]]))], names=["kind", "state", "symbol", "value"])

    parts = ids.mapInArrow(run, "kind int, state int, symbol int, value double")
    return parts.groupBy("kind", "state", "symbol").agg(F.sum("value").alias("value"))


def reestimate(p: Parameters, sums: pa.Table) -> float:
    """The parameters that the expected counts give, smoothed a little so that no symbol is impossible.

    Returns the ln likelihood under the parameters before."""
    kind, state, symbol, value = (sums[c].to_numpy() for c in ("kind", "state", "symbol", "value"))
    start, move, emit = (np.zeros(x.shape) for x in (p.start, p.move, p.emit))
    start[state[kind == 0]] = value[kind == 0]
    move[state[kind == 1], symbol[kind == 1]] = value[kind == 1]
    emit[state[kind == 2], symbol[kind == 2]] = value[kind == 2]
    for now, new in (("start", start + 0.01), ("move", move + 0.01), ("emit", emit + 0.01)):
        setattr(p, now, new / new.sum(axis=-1, keepdims=True))
    return float(value[kind == 3].sum())


def train(docs: DataFrame, counts: DataFrame, states: int = STATES, symbols: int = SYMBOLS, rounds: int | None = None,
          head: int = HEAD, window: int = WINDOW, text_col: str = "text") -> Parameters:
    """Parameters from all texts of ``docs``, whose words ``counts`` (word, c) has; ``rounds`` None: until they settle."""
    ends = docs.count()
    total = counts.agg(F.sum("c"), F.count("*")).first()
    longer = F.length("word") > HEAD_BYTES
    top = frequent(counts.where(~longer), head).unionAll(
        frequent(counts.where(longer & (F.length("word") <= LONG_BYTES)), LONG_HEAD)).toArrow()      # bounded
    head_words = sorted(zip([bytes(w) for w in top["word"].to_pylist()], top["c"].to_pylist()), key=lambda x: (-x[1], x[0]))
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy(F.least(F.length("word"), F.lit(CLASSES)).alias("n")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        class_tokens[r["n"] - 1], class_words[r["n"] - 1] = r["c"], r["v"]
    for w, c in head_words[:symbols]:
        class_tokens[word_class(w)] -= c
        class_words[word_class(w)] -= 1
    p = Parameters(head_words, (total[0] or 0) + ends, total[1] + (ends > 0), ends, class_tokens, class_words, states, symbols)
    if not ends:
        return p
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(p)
    ids = written(encoded(docs, shared, text_col), "symbols")
    shared.unpersist()
    start_from(p, neighbours(ids, p))
    before = -np.inf
    for done in itertools.count():
        if done == rounds:
            break
        shared = spark.sparkContext.broadcast(p)
        now = reestimate(p, expected(ids, shared, window).toArrow())         # bounded: states x symbols
        shared.unpersist()
        if rounds is None and now - before < TOLERANCE * -now:
            break
        before = now
    return p


def score(docs: DataFrame, p: Parameters, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """id, the columns ``carry``, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    with_worker_path(spark)
    shared = spark.sparkContext.broadcast(p)
    carry = carry or []
    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"),
                         *[docs[named(c)].alias(f"carried_{i}") for i, c in enumerate(carry)], docs[text_col].alias("text"))
    kept = source.columns[:-1]
    schema = ", ".join([*[f"{c} {t}" for c, t in source.dtypes[:-1]], "n_tokens bigint, known bigint, base double, model double, "
                        "rare array<binary>, times array<int>"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        base, inner, end = p.base(p.counts), p.in_class(), p.base(p.ends)
        for part in record_slices(batches, "text", SLICE):
            n, codes, different = words_of(part.column("text"))
            at, symbol = p.places(different)
            in_head = at >= 0
            row = np.repeat(np.arange(len(n)), n)

            def summed(of_head: np.ndarray) -> np.ndarray:
                values = np.zeros(len(at))
                values[in_head] = of_head[at[in_head]]
                return np.bincount(row, weights=values[codes], minlength=len(n))

            ids, starts = with_ends(symbol[codes], n, p.end)
            rows = np.split(ids, starts[1:-1])
            likelihood = np.zeros(len(rows))
            for some in passes(rows):
                likelihood[some] = forward(p, [rows[i] for i in some])
            tail = ~in_head[codes]
            pairs, times = np.unique(row[tail] * len(at) + codes[tail], return_counts=True)      # text and word
            offsets = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * len(at)), pa.int32())
            rare = different.take(pa.array(pairs % max(1, len(at)))).cast(pa.binary())
            known = np.bincount(row, weights=in_head[codes], minlength=len(n)).astype(np.int64) + (p.ends > 0)
            yield pa.RecordBatch.from_arrays([
                *[part.column(c) for c in kept], pa.array(n + 1, pa.int64()), pa.array(known, pa.int64()),
                pa.array(summed(base) + end), pa.array(likelihood / np.log(10) + summed(inner)),
                pa.ListArray.from_arrays(offsets, rare), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                names=[*kept, "n_tokens", "known", "base", "model", "rare", "times"])

    scored = written(source.mapInArrow(run, schema), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", "x.rare", "x.times")
    c = F.coalesce("c", F.lit(0))
    k = F.least(F.length("rare"), F.lit(CLASSES))
    within = F.element_at(F.array(*[F.lit(float(p.class_tokens[i] + 0.5 * (p.class_words[i] + 1))) for i in range(CLASSES)]), k)
    found = tail.join(counts, tail["rare"] == counts["word"], "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(p.tokens + 0.5 * (p.distinct + 1)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / within)).alias("more_model"))
    zero = F.lit(0)
    return scored.drop("rare", "times").join(found, "row", "left").select(
        F.col("id").alias(id_col), *[F.col(f"carried_{i}").alias(x) for i, x in enumerate(carry)], "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).cast("bigint").alias("n_known"),
        F.lit(p.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score"))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents outside the held-out fifth (crc32 of the id modulo 5 is 1)."""
    return docs.where(F.coalesce(crc_mod(docs[id_col], 5) != 1, F.lit(True)))
