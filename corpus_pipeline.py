"""A corpus pipeline over ``documents``: five stages, each one operator of ``fimloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fimloom.llm import exact_dedup, langid, packing, quality, queries, simhash
from fimloom.llm.common import columns_of, documents, written

#: A document whose language is less certain than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised language (operator 6); null or letterless texts and doubtful ones go."""
    model = langid.train(langid.training_rows(docs), F.col("lang"))
    judged = langid.predict(docs, model, carry=[c for c in docs.columns if c != "text"], names=("llm_pred__", "llm_score__"), keep_text=True)
    return judged.where((F.col("llm_pred__") != langid.UNKNOWN) & (F.col("llm_score__") >= LEAST_LANGUAGE_SCORE)).select(*columns_of(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the risk-controlled thresholds (operator 10)."""
    rows = quality.measured(docs, stratum=docs["lang"])
    cutoffs = quality.thresholds(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_documents(docs, cutoffs, stratum=docs["lang"])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the row with the smallest id (operator 3)."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each SimHash component one document, that with the smallest id (operator 4)."""
    return simhash.drop_near_copies(docs, words_per_shingle=3, max_bits=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 1,024 tokens (operator 2)."""
    return packing.pack(docs, queries.vocabulary())


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("packing", pack),
]

#: Trained models, SimHash over XXH64 and tokenization are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
