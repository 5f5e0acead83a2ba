"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams (one to three bytes of the UTF-8 text, ASCII lower case) are hashed to ``bins`` bins.
Training counts bins per language in Spark; the log-probability matrix (bins x languages, bounded by
``bins`` and ``max_languages``: with more languages training is refused) is broadcast, and numpy scores whole batches by gathering its rows.

Cases: a null text and one without a letter are "und" with score 0; null languages are not learned and
rows with a null id are scored as held in; repeated rows are each scored; without any training row all
are "und"; texts are scored whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, named, text_slices, with_worker_path

BINS = 1 << 16
ORDERS = (1, 2, 3)
#: Bound of the training sample (characters over all languages) and of the languages (of the matrix: more are an error).
TRAIN_CHARS, MAX_LANGUAGES = 50_000_000, 256
#: Bytes scored at once: a longer text is summed up by chunks.
CHUNK = 1 << 20
UNKNOWN = "und"
# Odd 32-bit multipliers, one per n-gram length.
MIX = (2654435761, 2246822519, 3266489917)


def has_letter(text: str | None) -> bool:
    return bool(text) and (text.isalpha() or any(map(str.isalpha, text)))


def grams(raw: np.ndarray, starts: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Bins of the 1-, 2- and 3-grams at each byte; those that run into the next text have the bin ``bins``."""
    shift = np.uint32(32 - (bins.bit_length() - 1))
    code, out = raw.astype(np.uint32), []
    for n, mix in zip(ORDERS, MIX):
        if n > 1:
            code = code[:-1] << np.uint32(8) | raw[n - 1:]
        found = (code * np.uint32(mix) ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(MIX[0]) >> shift
        for k in range(1, n):
            at = starts[1:] - k
            found[at[(at >= 0) & (at < len(found))]] = bins
        out.append(found)
    return out


def summed(raw: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``table`` (the last is zero) over the n-grams of each text, by chunks of bytes."""
    out = np.zeros((len(starts), table.shape[1]))
    reach = max(ORDERS) - 1
    for low in range(0, len(raw), CHUNK):
        high = min(len(raw), low + CHUNK)
        near = starts[(starts > low) & (starts <= high + reach)] - low
        total = np.zeros((high - low, table.shape[1]), dtype=np.float32)
        for g in grams(raw[low:high + reach], np.concatenate([[0], near]), len(table) - 1):
            g = g[:high - low]
            total[:len(g)] += table[g]
        first = np.searchsorted(starts, low, "right") - 1
        cuts = np.concatenate([[0], near[near < high - low]])
        out[first:first + len(cuts)] += np.add.reduceat(total, cuts, axis=0, dtype=np.float64)
    return out


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes of all texts, each between blanks, and where each begins."""
    raw = [b" " + (t or "").encode().lower() + b"  " for t in texts]
    starts = np.cumsum([0, *map(len, raw[:-1])])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), starts


def train(docs: DataFrame, lang: Column, text_col: str = "text", bins: int = BINS, train_chars: int = TRAIN_CHARS,
          max_languages: int = MAX_LANGUAGES, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probability matrix (bins x languages) from a sample bounded by ``train_chars``."""
    with_worker_path(docs.sparkSession)
    rows = docs.select(lang.alias("lang"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("place")).where("lang is not null and text is not null")
    totals = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows")).orderBy(
        F.desc("rows"), "lang").limit(max_languages + 1).collect()
    if len(totals) > max_languages:
        raise ValueError(f"more than {max_languages} languages: the matrix is bounded, raise max_languages to learn them")
    langs = sorted(r["lang"] for r in totals if r["n"])
    if not langs:
        return [], np.zeros((bins, 0), dtype=np.float32)
    # each language gives an equal share of the characters; rows are chosen by a hash of their text and place, so
    # that a text which occurs often comes into the sample in its proportion
    share = {r["lang"]: min(1.0, train_chars / len(langs) / max(1, r["n"])) for r in totals}
    part = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang"))
    sample = rows.where(F.col("lang").isin(langs)).where(F.pmod(F.xxhash64("text", "place"), F.lit(1 << 20)) < part * (1 << 20))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(langs), bins + 1), dtype=np.int64)
        at = {x: i for i, x in enumerate(langs)}
        for part_, texts in text_slices(batches):
            of = part_.column("lang").to_pylist()
            for x in set(of):
                for g in grams(*joined([t for t, y in zip(texts, of) if y == x]), bins):
                    seen[at[x]] += np.bincount(g, minlength=bins + 1)
        i, b = np.nonzero(seen[:, :bins])
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(b, pa.int32()), pa.array(seen[i, b], pa.int64())],
                                             names=["language", "bin", "n"])

    counts = np.full((bins, len(langs)), smoothing)
    found = sample.mapInArrow(count, "language int, bin int, n bigint").groupBy("language", "bin").agg(
        F.sum("n").alias("n")).toArrow()                # bounded: bins x languages
    counts[found["bin"].to_numpy(), found["language"].to_numpy()] += found["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", carry: list[str] | None = None,
            names: tuple[str, str] = ("lang_pred", "score"), keep_text: bool = False) -> DataFrame:
    """The columns ``carry`` (and the text, if kept) with the predicted language and its score under ``names``.

    The score is the posterior of the predicted language, with the evidence of a text's mean n-gram times
    four, so that long texts do not all score 1."""
    spark = docs.sparkSession
    with_worker_path(spark)
    langs, matrix = model
    shared = spark.sparkContext.broadcast(np.concatenate([matrix, np.zeros((1, len(langs)), dtype=np.float32)]))
    carry = carry or []
    # private names: the input's own may clash
    source = docs.select(*[docs[named(c)].alias(f"llm_c{i}__") for i, c in enumerate(carry)], docs[text_col].alias("llm_text__"))
    columns = source.columns if keep_text else source.columns[:-1]
    schema = ", ".join([*[f"{c} {t}" for c, t in source.dtypes[:len(columns)]], "llm_pred__ string, llm_score__ double"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part, texts in text_slices(batches, "llm_text__", 1 << 20):
            best, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
            if langs:
                raw, starts = joined(texts)
                sums = summed(raw, starts, table)
                mean = sums / np.diff(np.append(starts, len(raw)))[:, None]
                best = sums.argmax(axis=1)
                score = 1 / np.exp(4 * (mean - mean.max(axis=1, keepdims=True))).sum(axis=1)
            known = [bool(langs) and has_letter(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                *[part.column(c) for c in columns],
                pa.array([langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)], pa.string()),
                pa.array([s if k else 0.0 for s, k in zip(score.tolist(), known)], pa.float64()),
            ], names=[*columns, "llm_pred__", "llm_score__"])

    out = source.mapInArrow(run, schema)
    back = [*[out[f"llm_c{i}__"].alias(c) for i, c in enumerate(carry)], *([out["llm_text__"].alias(text_col)] if keep_text else [])]
    return out.select(*back, out["llm_pred__"].alias(names[0]), out["llm_score__"].alias(names[1]))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents outside the held-out quarter (crc32 of the id modulo 4 is 2)."""
    return docs.where(F.coalesce(crc_mod(docs[id_col], 4) != 2, F.lit(True)))
