"""Quality rules with risk-controlled thresholds.

Each document gets measures of its text (higher: worse).  Labelled documents are the holdout: for each
stratum and measure the cutoffs of a grid are tested from the highest down with the exact binomial
distribution.  A cutoff is valid if, were the share of good documents above it larger than the
measure's risk, seeing so few would have a probability of at most delta divided by the number of strata
and measures (Bonferroni); a fixed sequence that ends at its first failure needs no more correction for
the cutoffs.  The lowest valid cutoff is used, and without one the measure rejects nothing.  As the
risk is split over the measures, a stratum loses more than ``risk`` of its good documents with a
probability of at most delta.

Cases: a null text has no words; an empty text, a null id and repeated rows are judged like any other row;
documents whose label is null or that repeat an id with labels count once per joined label; a stratum
without cutoffs of its own (few labels or none, a null one, or one named as POOLED) rejects nothing, since
the pooled cutoffs bound only the loss over all strata together: they hold for rows without any strata;
an empty table gives no rows and no labels reject nothing; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, text_slices, with_worker_path, written

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: Measures that the thresholds act on, as columns of ``measured``.
MEASURES = ("symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "exclaim_rate")
#: Cutoffs of every measure: k / GRID for k = 0 .. GRID.
GRID = 200
POOLED = "*"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters",
          "n_exclaims")


def measure(text: str | None) -> tuple[int, ...]:
    """COUNTS of a text; words are cut at ASCII white space."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            count, reach = Counter(windows), 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeated += i + 3 - max(reach, i)
                    reach = i + 3
    ascii_only = text.isascii()
    capitals = len(raw) - len(raw.translate(None, UPPER)) if ascii_only else sum(map(str.isupper, text))
    small = len(raw) - len(raw.translate(None, LOWER)) if ascii_only else sum(map(str.isalpha, text)) - capitals
    return (n, len(text) - (len(raw) - len(raw.translate(None, WHITE.encode()))), len(raw) - len(raw.translate(None, SYMBOLS.encode())),
            len(lines) - len(set(lines)), repeated, len(lines), capitals, capitals + small,
            raw.count(b"!"))


UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None,
             carry: list[str] | None = None) -> DataFrame:
    """The id, stratum (string), COUNTS and MEASURES of every row, and the columns ``carry`` as carried_0, carried_1 .."""
    with_worker_path(docs.sparkSession)
    source = docs.select(docs[id_col].alias("llm_id__"), (F.lit(None) if stratum is None else stratum).cast("string").alias("stratum"),
                         *[docs[named(c)].alias(f"carried_{i}") for i, c in enumerate(carry or [])], docs[text_col].alias("llm_text__"))
    names = [c for c in source.columns if c != "llm_text__"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "llm_text__"):
            columns = list(zip(*map(measure, texts)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *[pa.array(c, pa.int64()) for c in columns]],
                                             names=[*names, *COUNTS])

    schema = ", ".join([*[f"{c} {t}" for c, t in source.dtypes if c != "llm_text__"], *[f"{c} bigint" for c in COUNTS]])

    def rate(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.least(F.lit(1.0), F.col(a) / F.col(b))).otherwise(F.lit(0.0))

    return source.mapInArrow(run, schema).withColumns({
        "symbol_rate": rate("n_symbols", "n_words"), "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"), "capital_rate": rate("n_capitals", "n_letters"),
        "exclaim_rate": rate("n_exclaims", "n_words")}).withColumnRenamed("llm_id__", id_col)


def at_most(k: int, n: int, p: float) -> float:
    """Exact probability of at most k of n at rate p."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def most_allowed(n: int, risk: float, level: float) -> int:
    """The largest k for which k of n good documents above a cutoff still prove its risk; -1 if none does."""
    k = -1
    while k + 1 < n and at_most(k + 1, n, risk) <= level:
        k += 1
    return k


def thresholds(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", risk: float = 0.02,
               delta: float = 0.05, least_labels: int = 200) -> dict[str, dict[str, float]]:
    """{stratum: {measure: cutoff}}; rows above a cutoff are rejected.  Strata without an entry reject nothing.

    POOLED alone is for rows without strata; if there are strata but none has ``least_labels``, it is empty.
    Only counts of good documents by stratum, measure and cutoff come to the driver, of strata with
    ``least_labels`` good labels."""
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("good_id"))
    holdout = written(rows.join(good, rows[id_col] == good["good_id"]).select("stratum", *MEASURES), "holdout")
    sizes = (holdout.where(F.col("stratum") != POOLED).groupBy("stratum").count().where(F.col("count") >= least_labels)
             .select("stratum"))
    own = sorted(r["stratum"] for r in sizes.collect())
    # a value lies above the cutoffs 0 .. step - 1
    steps = holdout.select(F.lit(POOLED).alias("stratum"), *MEASURES).unionByName(
        holdout.join(F.broadcast(sizes), "stratum", "left_semi").select("stratum", *MEASURES))
    steps = steps.select("stratum", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.ceil(F.col(m) * GRID).cast("int").alias("step")) for m in MEASURES])).alias("x"))
    counts: dict[tuple[str, str], Counter] = {}
    for r in steps.groupBy("stratum", "x.measure", "x.step").count().collect():
        counts.setdefault((r["stratum"], r["measure"]), Counter())[r["step"]] += r["count"]
    tests = (len(own) + 1) * len(MEASURES)
    out: dict[str, dict[str, float]] = {s: {} for s in (POOLED, *own)}
    for (s, m), by_step in sorted(counts.items()):
        n = sum(by_step.values())
        allowed = most_allowed(n, risk / len(MEASURES), delta / tests)
        above, best = 0, None
        for step in range(GRID, -1, -1):           # above: good documents over cutoff step / GRID
            above += by_step[step + 1] if step < GRID else 0
            if above > allowed:
                break
            best = step
        if best is not None:
            out[s][m] = best / GRID
    if out[POOLED] and not own and rows.where("stratum is not null").limit(1).count():
        out[POOLED] = {}                           # proves nothing for any one of the strata
    return out


def judged(rows: DataFrame, cutoffs: dict[str, dict[str, float]]) -> DataFrame:
    """Adds base_failed, risk_failed and kept.  POOLED judges the rows only if no stratum has an entry."""
    failed = F.lit(False)
    own = sorted(s for s in cutoffs if s != POOLED)
    for m in MEASURES:
        cuts = [(s, round(cutoffs[s][m] * GRID)) for s in own if m in cutoffs[s]]
        if cuts:
            cut = F.try_element_at(F.create_map(*[F.lit(x) for pair in cuts for x in pair]), F.col("stratum"))
        elif not own and m in cutoffs.get(POOLED, {}):
            cut = F.lit(round(cutoffs[POOLED][m] * GRID))
        else:
            continue
        failed = failed | F.coalesce(F.ceil(F.col(m) * GRID) > cut, F.lit(False))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", base).withColumn("risk_failed", failed).withColumn(
        "kept", ~(F.col("base_failed") | F.col("risk_failed")))


def kept_documents(docs: DataFrame, cutoffs: dict[str, dict[str, float]], stratum: Column | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, in one pass without a join."""
    rows = judged(measured(docs, id_col, text_col, stratum, carry=docs.columns), cutoffs).where("kept")
    return rows.select(*[F.col(f"carried_{i}").alias(c) for i, c in enumerate(docs.columns)])
